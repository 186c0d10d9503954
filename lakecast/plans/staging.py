"""One scan of a batch: it is written once to a staging folder, and all that a load has to know is observed meanwhile."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.operators.quality import Rule, flagged, suite_measures
from lakecast.sources.tables import delete_folder

#: Column with the name of the file that a row comes from; see ``with_file``.
FILE = "_source_file"


def with_file(df: DataFrame) -> DataFrame:
    """A file-based batch with its files' names, which a load observes and does not store."""
    return df.withColumn(FILE, F.col("_metadata.file_path"))


@dataclass
class Staged:
    """A batch in a staging folder; ``measures`` is what was observed on the way there."""

    rows: DataFrame
    path: str
    measures: dict = field(default_factory=dict)

    @property
    def count(self) -> int:
        return self.measures.get("rows") or 0

    @property
    def files(self) -> list[str]:
        return sorted(self.measures.get("files") or [])

    @property
    def name(self) -> str:
        """A name that the same rows always get, in whatever order they come."""
        return f"{int(self.measures.get('digest') or 0) % (1 << 64):016x}-{self.count}"

    def discard(self) -> None:
        delete_folder(self.rows.sparkSession, self.path)


def hashable(field: T.StructField) -> Column:
    """The column, or its text if it holds a map, for which Spark has no hash."""
    column = F.col(f"`{field.name}`")
    return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column


def stage(batch: DataFrame, rules: Sequence[Rule], beside: str, time: str, partition: str, fmt: str = "parquet") -> Staged:
    """Write ``batch`` once, beside the table it is meant for, and observe it.

    Observed: rows, each value rule's counts, the first time, the partitions, the files, and a digest of all rows. The
    metrics are taken in the tasks that write, so a task that is run again counts once. Rows go to these by partition, as a
    writing task sorts all its rows by partition and a split of a file may hold more than its memory should; a hot partition
    is split as far as its rows come from several tasks.
    """
    kept = [f for f in batch.schema.fields if f.name not in (FILE, partition)]
    measures = {
        "rows": F.count(F.lit(1)),
        "digest": F.sum(F.xxhash64(*(hashable(f) for f in kept)).cast("decimal(38,0)")),
        "first": F.min(time).cast("string"),
        "parts": F.collect_set(partition),
        **suite_measures(batch, rules),
    }
    if FILE in batch.columns:
        measures["files"] = F.collect_set(FILE)
    folder, _, name = beside.rstrip("/").rpartition("/")
    path = f"{folder}/_{name}-staged-{uuid.uuid4().hex}"
    watch = Observation()
    rows = flagged(batch, rules).hint("rebalance", partition).observe(watch, *(c.alias(n) for n, c in measures.items()))
    rows = rows.select(*(f"`{c}`" for c in batch.columns if c != FILE))
    rows.write.format(fmt).partitionBy(partition).save(path)
    written = batch.sparkSession.read.schema(rows.schema).format(fmt).load(path)
    return Staged(written.select(*(f"`{c}`" for c in rows.columns)), path, dict(watch.get))

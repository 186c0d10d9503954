"""Which columns the files of a batch really have, read from their footers by tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs
import pyarrow.orc
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files whose footers a task reads.
PER_TASK = 64


def footer_columns(name: str) -> list[str] | None:
    """Top-level columns of a Parquet or ORC file by its URI; None if its store is only open to Spark."""
    try:
        fs, path = pyarrow.fs.FileSystem.from_uri(name)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    path = unquote(path)
    with fs.open_input_file(path) as file:
        if path.endswith(".orc"):
            return pyarrow.orc.ORCFile(file).schema.names
        return pyarrow.parquet.ParquetFile(file).schema_arrow.names


def file_columns_of(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """``file, columns`` of each file: one job, whose tasks read a few footers each and no rows.

    ``columns`` is null where Arrow has no access to the store.
    """
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, -(-len(files) // PER_TASK)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer_columns(f) for f in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["file", "columns"])

    return listed.mapInArrow(read, "file string, columns array<string>")


def _columns_by_hadoop(spark: SparkSession, files: Iterable[str]) -> list[set[str]]:
    """For stores that Arrow cannot open: Parquet footers through Hadoop's file system, a few at a time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def read(name: str) -> set[str]:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return {f.getName() for f in reader.getFooter().getFileMetaData().getSchema().getFields()}
        finally:
            reader.close()

    with ThreadPool(8) as pool:
        return pool.map(read, files)


def columns_missing_in(spark: SparkSession, files: Sequence[str], columns: Sequence[str]) -> dict[str, int]:
    """How many of the files lack a column, for each of ``columns`` that any lacks. No files, no gaps."""
    if not files or not columns:
        return {}
    known = file_columns_of(spark, files)
    # What is collected is a count for each column, and the names of files that Arrow could not open.
    gone = F.array_except(F.array(*(F.lit(c) for c in columns)), "columns")
    closed = F.col("columns").isNull()
    gaps = known.select(F.when(closed, F.col("file")).alias("file"), F.explode(F.when(closed, F.array(F.lit(None))).otherwise(gone)).alias("column"))
    rows = gaps.groupBy("file", "column").count().collect()
    found: dict[str, int] = {r["column"]: r["count"] for r in rows if r["file"] is None}
    for present in _columns_by_hadoop(spark, [r["file"] for r in rows if r["file"] is not None]):
        for column in set(columns) - present:
            found[column] = found.get(column, 0) + 1
    return found

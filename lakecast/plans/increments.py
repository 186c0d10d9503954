"""Grouped series and feature rows that follow an increment: only what it touches is computed anew."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakecast.operators.aggregates import group_series
from lakecast.plans.curating import MONTH, month_of
from lakecast.plans.features import model_table
from lakecast.plans.staging import FILE, hashable
from lakecast.series import SeriesSpec
from lakecast.session import broadcast_if_small, cut_lineage
from lakecast.sources.tables import delete_folder, scan_table, table_exists

_PRINT, _LOAD = "file_print", "load_id"


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def add_partial_groups(
    facts: DataFrame, root: str, time: Column, name: str, keys: Sequence[str], sums: Mapping[str, str | Column]
) -> DataFrame:
    """Add the sums of new files to the group table below ``root``; returns the (time, keys) that the facts touch.

    ``facts`` carry their files' names (``staging.with_file``). Each file leaves partial sums of its own, in one scan with a
    fingerprint of its rows, and a file whose fingerprint was loaded before, under whatever name, adds nothing: late,
    repeated and interrupted loads all give the sums of the distinct files. Sums of a load count once its files are
    listed, which is the last step. What is returned covers known files too, so that a run that died in between can be
    finished by running it again.
    """
    spark = facts.sparkSession
    row = [hashable(f) for f in facts.schema.fields if f.name != FILE]
    # 40 bits each, so that sums of millions of rows stay whole.
    prints = {f"_print_{i}": F.shiftrightunsigned(F.xxhash64(F.lit(i), *row), 24).cast("decimal(20,0)") for i in (1, 2)}
    partial = cut_lineage(group_series(facts, time.alias(name), [*keys, FILE], {**sums, **prints, "_rows": F.lit(1)}))
    digest = F.concat_ws("-", *(F.sum(c).cast("string") for c in (*prints, "_rows")))
    files = partial.groupBy(FILE).agg(digest.alias(_PRINT))
    files = files.groupBy(_PRINT).agg(F.min(FILE).alias(FILE))
    listed = f"{root.rstrip('/')}/files"
    if table_exists(spark, listed):
        files = files.join(scan_table(spark, listed).select(_PRINT), _PRINT, "left_anti")
    files = cut_lineage(files.withColumn(_LOAD, F.lit(uuid.uuid4().hex)))
    if not files.isEmpty():
        new = partial.join(broadcast_if_small(files), FILE).select(name, *keys, *sums, _PRINT, _LOAD)
        new.withColumn(MONTH, month_of(name)).hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(f"{root.rstrip('/')}/sums")
        files.select(_PRINT, _LOAD).coalesce(1).write.mode("append").parquet(listed)
    return partial.select(name, *keys).distinct()


def merged_groups(spark: SparkSession, root: str, name: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The group table: the listed files' partial sums added up."""
    files = scan_table(spark, f"{root.rstrip('/')}/files")
    partial = spark.read.parquet(f"{root.rstrip('/')}/sums")
    rows = partial.join(broadcast_if_small(files), [_PRINT, _LOAD], "left_semi")
    return rows.groupBy(name, *keys).agg(*(F.sum(c).cast("bigint").alias(c) for c in sums))


def update_model_table(series: DataFrame, changed: DataFrame, path: str, spec: SeriesSpec, split_rows: int | None = None) -> int:
    """Bring the model table at ``path`` (by month) up to date with ``series``, of which ``changed`` (keys, time) is new or different.

    For each changed series only the rows from its first change on are computed, from these and the rows that lags and averages
    look back to: ``n_lags`` for the first row that an average counts, and the longest average before that. A series
    with null values, where rows without full lags drop out in between, is taken whole. Months without
    such rows are neither read nor written. Running it again changes nothing. Returns the number of rows computed.
    """
    spark, keys = series.sparkSession, list(spec.keys)
    first = cut_lineage(changed.groupBy(*keys).agg(F.min(spec.time).alias("_first")))
    if first.isEmpty():
        return 0
    touched = broadcast_if_small(first)
    halo = spec.n_lags + max(k for _, k in spec.windows)
    rows = series.alias("s").join(touched.alias("c"), _same("s", "c", keys)).select("s.*", "_first")
    back = Window.partitionBy(*keys, F.col(spec.time) < F.col("_first")).orderBy(F.col(spec.time).desc())
    gaps = F.max(F.col(spec.value).isNull()).over(Window.partitionBy(*keys))
    near = rows.withColumns({"_back": F.row_number().over(back), "_gaps": gaps})
    near = near.where((F.col(spec.time) >= F.col("_first")) | (F.col("_back") <= halo) | F.col("_gaps"))
    delta = model_table(near.select(*series.columns), spec, split_rows=split_rows)
    delta = delta.alias("s").join(touched.alias("c"), _same("s", "c", keys)).where(F.col(f"s.{spec.time}") >= F.col("c._first")).select("s.*")
    delta = cut_lineage(delta.withColumn(MONTH, month_of(spec.time)))
    result = delta
    if table_exists(spark, path):
        start = first.select(F.date_format(F.min("_first").cast("timestamp"), "yyyy-MM")).first()[0]
        stored = spark.read.schema(delta.schema).parquet(path).where(F.col(MONTH) >= start)
        met = stored.alias("s").join(touched.alias("c"), _same("s", "c", keys), "left")
        gone = F.coalesce(F.col(f"s.{spec.time}") >= F.col("c._first"), F.lit(False))
        marked = cut_lineage(met.select("s.*", gone.alias("_gone")))
        # Months that lose or gain rows are written anew with the rows that stay.
        months = delta.select(MONTH).union(marked.where("_gone").select(MONTH)).distinct()
        stay = marked.where("NOT _gone").drop("_gone").join(broadcast_if_small(months), MONTH, "left_semi")
        result = cut_lineage(stay.unionByName(delta))
        for (month,) in months.join(result.select(MONTH), MONTH, "left_anti").collect():
            delete_folder(spark, f"{path.rstrip('/')}/{MONTH}={month}")
    result.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return delta.count()

"""Landed files: JSON and CSV scans, Parquet scans, and a lake laid out by year and month."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.functions.temporal import day_bounds, month_label
from lakecast.sources.footers import columns_missing_in


def scan_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_time_column(df: DataFrame, time: str, fmt: str | None = None) -> DataFrame:
    """ISO text (or ``fmt``) to timestamp in place; nothing to do when it is one already."""
    if not isinstance(df.schema[time].dataType, T.StringType):
        return df
    parsed = F.to_timestamp(time, fmt) if fmt else F.to_timestamp(time)
    return df.withColumn(time, parsed)


def bounded_fetch(
    df: DataFrame, time: str, start: str, end: str, limit: int | None = None
) -> DataFrame:
    """Rows of the days ``start`` to ``end`` (MM/dd/yyyy, both included), at most ``limit``.

    ``limit`` mirrors a source-side row cap; leave it off to get everything, since a
    limit ends in one task.
    """
    kind = df.schema[time].dataType
    low, high = (bound.cast(kind) for bound in day_bounds(F.lit(start), F.lit(end)))
    rows = df.where((F.col(time) >= low) & (F.col(time) < high))
    return rows if limit is None else rows.limit(limit)


def json_to_parquet(df: DataFrame, time: str, path: str, mode: str = "overwrite") -> None:
    parse_time_column(df, time).write.mode(mode).parquet(path)


def scan_parquet(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """Directory or glob scan; columns a file lacks become null.

    Under a given ``schema`` no footer is read ahead; without one the files' schemas are merged.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


@contextmanager
def nanos_as_long(spark: SparkSession):
    """Lets Parquet files with nanosecond times be read, as epoch nanoseconds."""
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def common_columns(spark: SparkSession, path: str, fmt: str = "parquet") -> list[str]:
    """Columns that every file below ``path`` has, and partition columns.

    Tasks read the footers, all in one job; pass the files of a
    batch. A column that one of them lacks would read as null there.
    """
    with nanos_as_long(spark):
        merged = scan_parquet(spark, path) if fmt == "parquet" else spark.read.format(fmt).load(path)
    files = merged.inputFiles()
    gaps = columns_missing_in(spark, files, merged.columns)
    return [c for c in merged.columns if gaps.get(c, len(files)) == len(files)]


def scan_code_csv(
    spark: SparkSession, path: str, label: str, index: str, code_type: str = "int"
) -> DataFrame:
    """Code table from CSV with header: label text and integer index, in any column order."""
    rows = spark.read.option("header", "true").csv(path)
    return rows.select(F.col(index).try_cast(code_type).alias(index), F.col(label))


def reference_values(
    spark: SparkSession, path: str, columns: list[str]
) -> DataFrame:
    """Allowed values from CSV, kept as text, for membership rules."""
    return spark.read.option("header", "true").csv(path).select(*columns)


def with_month(df: DataFrame, time: str) -> DataFrame:
    return df.withColumns({"year": F.year(time), "month": F.month(time)})


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Even output files: adaptive execution splits a hot partition and merges tiny ones."""
    return df.hint("rebalance", *columns)


def write_months(df: DataFrame, time: str, root: str) -> bool:
    """Replace the months ``df`` holds below ``root``; other months stay. False if no rows."""
    if df.isEmpty():
        return False
    rows = _spread(with_month(df, time), ["year", "month"])
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(root)
    )
    return True


def append_months(df: DataFrame, time: str, root: str) -> bool:
    """Add rows to their month partitions; a month that does not exist is created.

    Columns are matched by name at read time (``scan_months``), so files may differ.
    """
    if df.isEmpty():
        return False
    rows = _spread(with_month(df, time), ["year", "month"])
    rows.write.mode("append").partitionBy("year", "month").parquet(root)
    return True


def scan_months(spark: SparkSession, root: str) -> DataFrame:
    return scan_parquet(spark, root)


def list_months(spark: SparkSession, root: str) -> DataFrame:
    """Months present, from the directory listing alone: no data file is opened.

    Columns ``month_label`` (MM-yyyy) and ``month_start``; empty if ``root`` does not exist.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(f"{root.rstrip('/')}/year=*/month=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    labels = []
    for status in fs.globStatus(pattern) or []:
        path = status.getPath()
        year = path.getParent().getName().split("=", 1)[1]
        month = path.getName().split("=", 1)[1]
        if year.isdigit() and month.isdigit():
            labels.append((int(year), int(month)))
    found = spark.createDataFrame(labels, "y int, m int")
    start = F.make_date("y", "m", F.lit(1))
    return found.select(month_label(start).alias("month_label"), start.alias("month_start"))


def newest_month(months: DataFrame, start: str = "month_start") -> DataFrame:
    """The latest month by date, never by its text label."""
    return months.agg(F.max(start).alias(start)).where(F.col(start).isNotNull())


def list_files(df: DataFrame, suffix: str = ".parquet") -> DataFrame:
    """Names of the files behind a file-based DataFrame that end in ``suffix``."""
    name = F.col("_metadata.file_name")
    return df.select(name.alias("file_name")).where(name.endswith(suffix)).distinct()


def preview(df: DataFrame, n: int = 20, order_by: list[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; give an order to make them the same rows every time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)

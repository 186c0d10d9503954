"""Session defaults and the helpers that cut lineage or check a side before broadcasting it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


# Feature rows are wide. HotSpot never compiles methods above 8000 bytes of bytecode, so a
# generated method beyond that runs interpreted, several times slower; with this limit
# Spark falls back to smaller pieces of generated code instead.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_settings(spark: SparkSession) -> None:
    """The settings above, for a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)


def build_session(
    app_name: str = "lakecast", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with UTC, adaptive execution and checkpoint clean-up; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Without that setting it is a folder below the warehouse, which executors share as well.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and starts a short plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _width(column, kind: T.DataType):
    """Bytes of a value; nested values count with all they hold."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = F.octet_length(column)
    elif isinstance(kind, T.ArrayType):
        inner = F.transform(column, lambda x: _width(x, kind.elementType))
        size = F.aggregate(inner, F.lit(8).cast("long"), lambda total, x: total + x)
    elif isinstance(kind, T.MapType):
        size = _width(F.map_keys(column), T.ArrayType(kind.keyType)) + _width(F.map_values(column), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = sum((_width(column[f.name], f.dataType) for f in kind.fields), F.lit(8).cast("long"))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size, F.lit(0)).cast("long")


def is_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Few enough rows and bytes to broadcast?

    The count stops at ``max_rows + 1`` rows, so probing a big input stays cheap. Pass
    materialised inputs (files, tables, checkpoints): a lazy input is evaluated for the probe.
    """
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    rows, size = (
        df.limit(max_rows + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast hint if a count allows it; otherwise Spark chooses the join."""
    return F.broadcast(df) if is_small(df) else df

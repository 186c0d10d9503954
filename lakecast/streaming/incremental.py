"""Run a batch load on whatever files have arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakecast.plans.staging import with_file


def run_incremental_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    load: Callable[[DataFrame], object],
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    name_files: bool = False,
) -> int:
    """Feed new files below ``source`` to ``load``, then stop. Returns the number of batches.

    The stream's own checkpoint remembers the files done. ``load`` should be idempotent,
    as the insert-only merge and the keyed append are: a batch that was interrupted is
    given to it again. Late rows need no watermark, they are merged like any others. With
    ``name_files`` a batch has its files' names (``staging.FILE``), so that a load can look at the new files alone.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    done: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        load(batch)
        done.append(batch_id)

    arriving = reader.load(source)
    query = (
        (with_file(arriving) if name_files else arriving)
        .writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)

"""Validated and curated tables: gated full loads, insert-only merges, keyed appends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.operators.joins import anti_new_rows, missing_rows
from lakecast.operators.projections import (
    cast_measures,
    cast_to_schema,
    derive_year,
    normalise_time,
    since_high_water,
)
from lakecast.operators.quality import Rule, isolate, judge_measured, missing_columns, schema_gate
from lakecast.plans.staging import FILE, Staged, stage, with_file
from lakecast.session import cut_lineage
from lakecast.sources.files import nanos_as_long, scan_parquet
from lakecast.sources.footers import columns_missing_in
from lakecast.sources.tables import (
    latest_in_partitions,
    publish_folder,
    scan_table,
    table_exists,
    write_partitioned,
    write_quarantine,
)

ON_FAIL = ("quarantine_batch", "split")


def normalise(
    df: DataFrame, time: str, measures: Sequence[str], as_text: bool = False
) -> DataFrame:
    """Raw rows to validated types: nanoseconds to time, text measures to float or null."""
    timed = normalise_time(df, time, as_text) if isinstance(df.schema[time].dataType, T.LongType) else df
    return cast_measures(timed, measures)


def merge_insert_only(
    batch: DataFrame,
    path: str,
    time: str,
    partition: str = "year",
    columns: Sequence[str] | None = None,
    dedupe: bool = False,
    fmt: str = "parquet",
    extent: tuple[str | None, list] | None = None,
    **options: str,
) -> None:
    """Append the batch rows that equal no stored row on all columns; a re-run adds nothing.

    The stored side is cut to the batch's partitions and to times from the batch's first
    on, so the cost follows the batch and not the table. ``extent`` gives that first time, as text, and
    the partitions where they are known; otherwise the batch is read for them.
    """
    spark = batch.sparkSession
    wanted = list(columns or [c for c in batch.columns if c != partition])
    first, parts = extent or batch.agg(
        F.min(time).cast("string"), F.collect_set(partition)
    ).first()
    target = scan_table(spark, path, fmt, **options)
    stored = target.where(F.col(partition).isin(parts) | F.col(partition).isNull())
    if first is not None:
        kind = target.schema[time].dataType
        stored = stored.where((F.col(time) >= F.lit(first).cast(kind)) | F.col(time).isNull())
    new = missing_rows(batch, stored, [*wanted, partition], dedupe)
    write_partitioned(new, path, partition, mode="append", fmt=fmt, spread=True)


@dataclass(frozen=True)
class LoadReport:
    """``status`` is loaded, merged, quarantined, split or up_to_date; ``summary`` the suite's result."""

    status: str
    summary: DataFrame | None = None


def quarantine(
    df: DataFrame,
    rules: Sequence[Rule],
    schema: T.StructType,
    good_path: str,
    bad_path: str,
    null_policy: str = "bad",
    batch: str | None = None,
) -> DataFrame:
    """Write good rows (cast to ``schema``) and bad rows to their paths; returns the good ones.

    A named ``batch`` replaces what an earlier run of it left there.
    """
    good, bad = isolate(df, rules, null_policy)
    good = cast_to_schema(good, schema)
    write_quarantine(good, bad, good_path, bad_path, batch)
    return good


def load_validated(
    batch: DataFrame,
    path: str,
    rules: Sequence[Rule],
    time: str,
    good_path: str,
    bad_path: str,
    columns: Sequence[str] | None = None,
    on_fail: str = "quarantine_batch",
    null_policy: str = "bad",
    partition: str = "year",
    dedupe: bool = False,
    since_latest: bool = False,
    fmt: str = "parquet",
) -> LoadReport:
    """Validate a batch and bring it into the table at ``path``.

    The batch is scanned once: it is written to a staging folder, and its rows, rule counts and extent are observed
    meanwhile. No table yet: full load, for which the folder is renamed. Otherwise all rows of the batch are
    merged insert-only, late ones and those without a time like any others; choose the batch by files. If a rule fails, the
    whole batch goes to quarantine and the table stays as it is; with ``on_fail="split"``
    the good rows are still loaded. ``since_latest`` looks only at rows from the table's latest
    time on, for input that is known to come in order. Where the batch has its files' names (``staging.with_file``), a column
    that one of them lacks fails the existence rules, and nothing is published.
    """
    if on_fail not in ON_FAIL:
        raise ValueError(f"on_fail must be one of {ON_FAIL}")
    spark = batch.sparkSession
    columns = list(columns if columns is not None else batch.columns)
    schema_gate(columns, rules)
    exists = table_exists(spark, path, fmt)
    rows = batch
    if exists and since_latest:
        high_water = latest_in_partitions(spark, path, time, partition, fmt)
        rows = since_high_water(batch, time, high_water)
    staged = stage(derive_year(rows, time, partition), rules, path, time, partition, fmt)
    try:
        if exists and not staged.count:
            return LoadReport("up_to_date")
        gaps = columns_missing_in(spark, staged.files, [c for c in columns if c not in (FILE, partition)])
        if absent := missing_columns([c for c in columns if c not in gaps], rules):
            raise ValueError(f"required columns are missing: {', '.join(f'{c} (in {gaps[c]} files)' for c in absent)}")
        return _judged(staged, rows, path, rules, time, good_path, bad_path, columns, on_fail, null_policy, partition, dedupe, fmt, exists)
    finally:
        staged.discard()


def _judged(
    staged: Staged, rows: DataFrame, path: str, rules: Sequence[Rule], time: str, good_path: str, bad_path: str, columns: Sequence[str],
    on_fail: str, null_policy: str, partition: str, dedupe: bool, fmt: str, exists: bool,
) -> LoadReport:
    """Publishes, merges or quarantines a staged batch."""
    summary, passed = judge_measured(staged.rows, rules, staged.measures, columns)
    accepted = staged.rows
    if not passed:
        # A summary that samples the staged rows has to outlive them.
        summary = cut_lineage(summary)
        own = [f for f in rows.schema.fields if f.name != FILE]
        good = quarantine(
            staged.rows.select(*(f"`{f.name}`" for f in own)), rules, T.StructType(own), good_path, bad_path, null_policy, staged.name
        )
        if on_fail == "quarantine_batch":
            return LoadReport("quarantined", summary)
        accepted = derive_year(good, time, partition)
    if exists:
        extent = (staged.measures.get("first"), staged.measures.get("parts") or [])
        merge_insert_only(accepted, path, time, partition, dedupe=dedupe, fmt=fmt, extent=extent)
    elif passed and not dedupe:
        publish_folder(rows.sparkSession, staged.path, path)
    else:
        write_partitioned(accepted.dropDuplicates() if dedupe else accepted, path, partition, fmt=fmt, spread=True)
    if not passed:
        return LoadReport("split", summary)
    return LoadReport("merged" if exists else "loaded", summary)


def load_silver(
    spark,
    source: str,
    schema: T.StructType,
    path: str,
    rules: Sequence[Rule],
    time: str,
    measures: Sequence[str],
    good_path: str,
    bad_path: str,
    **options,
) -> LoadReport:
    """Scan landed Parquet under ``schema``, normalise, validate, load.

    The existence rules ask for columns that every file has, before the schema
    fills absent ones with nulls; the files' footers tell.
    """
    with nanos_as_long(spark):
        raw = with_file(scan_parquet(spark, source, schema))
        return load_validated(normalise(raw, time, measures), path, rules, time, good_path, bad_path, **options)


def append_curated(
    source: DataFrame,
    path: str,
    increment_path: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    null_safe: bool = True,
    fmt: str = "parquet",
    **options: str,
) -> int:
    """Bring new rows into the curated table and leave them as the increment snapshot.

    Only a table that is not there, or has no rows, leads to a full write; any other
    read failure is raised. The new rows are checkpointed, so the join runs once and both
    writes hold the same rows. Returns the number of rows written.
    """
    spark = source.sparkSession
    wanted = source.select(*columns) if columns else source
    target = scan_table(spark, path, fmt, **options) if table_exists(spark, path, fmt) else None
    if target is None or target.isEmpty():
        wanted.write.format(fmt).options(**options).mode("overwrite").save(path)
        return scan_table(spark, path, fmt, **options).count()
    new = cut_lineage(anti_new_rows(wanted, target, keys, null_safe))
    written = new.count()
    if written:
        new.write.format(fmt).options(**options).mode("overwrite").save(increment_path)
        new.write.format(fmt).options(**options).mode("append").save(path)
    return written

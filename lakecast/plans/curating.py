"""Keyed appends to a table laid out by month: only the months and keys of an increment are read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.operators.joins import anti_new_rows
from lakecast.session import cut_lineage, is_small
from lakecast.sources.tables import scan_table, table_exists

#: Partition column of tables by month, as ``yyyy-MM``; null for rows without a time.
MONTH = "stored_month"

#: Keys with no more distinct values than this in an increment are looked up by value, others by range.
LISTED = 200


def month_of(time: str) -> Column:
    return F.date_format(F.col(time).cast("timestamp"), "yyyy-MM")


@dataclass(frozen=True)
class Extent:
    """What an increment can meet: months, and for each key its values or its range."""

    months: tuple
    keys: dict[str, tuple[list, object, object, bool]]

    @classmethod
    def of(cls, rows: DataFrame, time: str, keys: Sequence[str]) -> Extent:
        """One aggregate over the keys, and a second one where few values can be listed."""
        sizes = [F.approx_count_distinct(k).alias(f"n_{i}") for i, k in enumerate(keys)]
        ends = [f(k).alias(f"{n}_{i}") for i, k in enumerate(keys) for n, f in (("low", F.min), ("high", F.max))]
        nulls = [F.coalesce(F.bool_or(F.col(k).isNull()), F.lit(False)).alias(f"null_{i}") for i, k in enumerate(keys)]
        found = rows.agg(F.collect_set(F.coalesce(month_of(time), F.lit(""))).alias("months"), *sizes, *ends, *nulls).first()
        listed = [(i, k) for i, k in enumerate(keys) if found[f"n_{i}"] <= LISTED]
        values = rows.agg(*(F.collect_set(k).alias(f"v_{i}") for i, k in listed)).first() if listed else {}
        return cls(
            tuple(sorted(found["months"])),
            {
                k: (list(values[f"v_{i}"]) if (i, k) in listed else [], found[f"low_{i}"], found[f"high_{i}"], found[f"null_{i}"])
                for i, k in enumerate(keys)
            },
        )

    def of_stored(self, stored: DataFrame) -> DataFrame:
        """The stored rows that can meet the increment. Months prune folders; keys prune row groups by their ranges and Bloom filters."""
        known = [m for m in self.months if m]
        tests = [F.col(MONTH).isin(known) | F.col(MONTH).isNull() if "" in self.months else F.col(MONTH).isin(known)]
        for key, (values, low, high, null) in self.keys.items():
            kind = stored.schema[key].dataType
            if low is None and not null:
                return stored.limit(0)
            column = F.col(key)
            fits = F.lit(False)
            if values:
                fits = column.isin([F.lit(v).cast(kind) for v in values])
            elif low is not None:
                fits = column.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
            tests.append(fits | column.isNull() if null else fits)
        return stored.where(reduce(lambda a, b: a & b, tests))


def _write_months(rows: DataFrame, path: str, time: str, keys: Sequence[str], fmt: str, mode: str, **options: str) -> None:
    """Even files by month; Parquet files get Bloom filters on keys that are text or whole numbers."""
    writer = rows.withColumn(MONTH, month_of(time)).hint("rebalance", MONTH).write.format(fmt).options(**options).mode(mode)
    for key in keys if fmt == "parquet" else ():
        if isinstance(rows.schema[key].dataType, T.StringType | T.IntegralType):
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    writer.partitionBy(MONTH).save(path)


def scan_curated(spark, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """A curated table by month with its partition column; no file is opened for its schema."""
    full = T.StructType([f for f in schema.fields if f.name != MONTH]).add(MONTH, "string")
    return spark.read.schema(full).format(fmt).options(**options).load(path)


def append_months_by_key(
    source: DataFrame,
    path: str,
    increment_path: str,
    keys: Sequence[str],
    time: str,
    columns: Sequence[str] | None = None,
    null_safe: bool = True,
    fmt: str = "parquet",
    **options: str,
) -> int:
    """Bring rows of new keys into the curated table by month and leave them as the increment snapshot.

    ``time`` has to be one of ``keys``: a row with a known key then stands in its own month. The stored side is cut to the
    increment's months and keys, and by a broadcast of the keys where these are few, so the cost follows the increment. The new rows are
    checkpointed: the join runs once and both writes hold the same rows. If nothing is new, the snapshot is left empty.
    Returns the number of rows written.
    """
    if time not in keys:
        raise ValueError(f"the time {time!r} has to be one of the keys")
    spark = source.sparkSession
    wanted = source.select(*columns) if columns else source
    new = wanted
    if table_exists(spark, path, fmt):
        known = Extent.of(wanted, time, keys).of_stored(scan_curated(spark, path, wanted.schema, fmt, **options))
        new = anti_new_rows(wanted, _met(known, wanted.select(*keys).distinct(), keys, null_safe), keys, null_safe)
    new = cut_lineage(new)
    written = new.count()
    new.write.format(fmt).options(**options).mode("overwrite").save(increment_path)
    if written:
        _write_months(new, path, time, keys, fmt, "append", **options)
    return written


def _met(known: DataFrame, wanted: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Of the stored keys those that the increment has, without a shuffle, if a count shows the increment to be small."""
    if not is_small(wanted):
        return known
    asked = F.broadcast(wanted.select(*(F.col(k).alias(f"_asked_{k}") for k in keys)))
    pairs = [F.col(k).eqNullSafe(F.col(f"_asked_{k}")) if null_safe else F.col(k) == F.col(f"_asked_{k}") for k in keys]
    return known.join(asked, reduce(lambda a, b: a & b, pairs), "left_semi")

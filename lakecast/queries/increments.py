"""Tables that follow increments: keyed appends by month, groups from partial sums, feature rows with a halo."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.encoding import build_code_table, encode, extend_code_table
from lakecast.plans.curating import append_months_by_key
from lakecast.plans.increments import add_partial_groups, merged_groups, update_model_table
from lakecast.plans.staging import with_file
from lakecast.queries.common import (
    DAILY,
    DAILY_LABELS,
    SQL_DAILY,
    SQL_DAILY_SERIES,
    Query,
    comparable,
    model_columns,
    sql_edge,
    sql_model_ctes,
    table,
)
from lakecast.queries.loads import KEYS, OVERLAP_FROM, SPLIT_AT
from lakecast.queries.lookups import ORDER_COLUMNS, SQL_ORDERS
from lakecast.session import scratch_path
from lakecast.sources.tables import create_or_replace_as, scan_table

SUMS = {"ridership": "l_quantity", "transfer": "l_extendedprice"}
FACTS = ("l_orderkey", "l_linenumber", "l_shipdate", *DAILY_LABELS, *SUMS.values())

#: Facts that come in time, and those that come with the newest files although they are old.
_OLD = "l_shipdate < TIMESTAMP '2001-07-01' AND l_orderkey % 40 <> 0"
_NEW = "l_shipdate >= TIMESTAMP '2001-07-01' AND l_orderkey % 40 <> 0"
_LATE = "l_orderkey % 40 = 0"

#: Rows of a landed file, about 60 MB on their way through the shuffle; there are as many files as that takes, and two at least.
FILE_ROWS = 2_000_000


def _curated_months(fmt: str = "parquet", snapshot: bool = False):
    """Orders before a date, then all from a few days earlier on, with some older ones again."""

    def run(spark, sf_dir):
        path, increment = scratch_path(spark, "curated"), scratch_path(spark, "increment")
        orders = table(spark, sf_dir, "orders")
        late = F.col("o_orderkey") % 5 == 0
        first = orders.where((F.col("o_orderdate") < F.lit(SPLIT_AT).cast("timestamp")) & ~late)
        second = orders.where((F.col("o_orderdate") >= F.lit(OVERLAP_FROM).cast("timestamp")) | (F.col("o_orderkey") % 10 == 0))
        for batch in (first, second) if snapshot else (first, second, second, orders):
            append_months_by_key(batch, path, increment, KEYS, "o_orderdate", ORDER_COLUMNS, fmt=fmt)
        return comparable(scan_table(spark, increment if snapshot else path, fmt).select(*ORDER_COLUMNS))

    return run


def _landed(spark, sf_dir, condition: str, files: int = 2):
    """The facts of a condition as files of their own, ``files`` at least.

    The number of rows and the row itself decide on a row's file, so the same facts always give files of the same rows, and no key
    makes a file large.
    """
    rows = table(spark, sf_dir, "lineitem").where(condition).select(*FACTS)
    files = max(files, -(-rows.count() // FILE_ROWS))
    return with_file(create_or_replace_as(rows.repartition(files, *FACTS), scratch_path(spark, "landed")))


def _add(facts, root):
    return add_partial_groups(facts, root, F.to_date("l_shipdate"), DAILY.time, DAILY_LABELS, SUMS)


def _groups(spark, root):
    return merged_groups(spark, root, DAILY.time, DAILY_LABELS, list(SUMS))


def _group_daily_increment(spark, sf_dir):
    """Three loads: old facts, new ones, late ones; old files come again, once by their name and once by another."""
    root = scratch_path(spark, "groups")
    old, new = (_landed(spark, sf_dir, condition) for condition in (_OLD, _NEW))
    again = _landed(spark, sf_dir, _OLD)
    for facts in (old, new, old, again, _landed(spark, sf_dir, _LATE)):
        _add(facts, root)
    return comparable(_groups(spark, root))


def _model_daily_increment(spark, sf_dir):
    """The model table after a first load, an increment in order and one of late rows, each computed from what it touches."""
    root, path = scratch_path(spark, "groups"), scratch_path(spark, "model")
    codes = None
    for condition in (_OLD, _NEW, _LATE):
        changed = _add(_landed(spark, sf_dir, condition), root)
        groups = create_or_replace_as(_groups(spark, root), scratch_path(spark, "series"))
        codes = build_code_table(groups, DAILY_LABELS) if codes is None else extend_code_table(codes, groups, DAILY_LABELS)
        series, touched = (encode(rows, codes, DAILY_LABELS, keep_labels=False) for rows in (groups, changed))
        if condition is _OLD:
            touched = series.select(DAILY.time, *DAILY.keys)
        update_model_table(series, touched, path, DAILY)
    return comparable(scan_table(spark, path).select(*model_columns(DAILY)))


_SQL_MODEL = f"WITH {sql_model_ctes(SQL_DAILY, DAILY)} SELECT {sql_edge(DAILY, model_columns(DAILY))} FROM model"
_SQL_GROUPS = f"""
    SELECT strftime(transit_date, '%Y-%m-%d') AS transit_date, {", ".join(DAILY_LABELS)}, ridership, transfer
    FROM ({SQL_DAILY_SERIES})"""
_SQL_SNAPSHOT = f"""
    SELECT {SQL_ORDERS} FROM orders
    WHERE (o_orderdate >= TIMESTAMP '{OVERLAP_FROM}' OR o_orderkey % 10 = 0)
      AND NOT (o_orderdate < TIMESTAMP '{SPLIT_AT}' AND o_orderkey % 5 <> 0)"""

QUERIES = [
    Query("incremental_curated_months", _curated_months(), f"SELECT {SQL_ORDERS} FROM orders"),
    Query("incremental_curated_months_orc", _curated_months("orc"), f"SELECT {SQL_ORDERS} FROM orders"),
    Query("curated_months_snapshot", _curated_months(snapshot=True), _SQL_SNAPSHOT),
    Query("group_daily_increment", _group_daily_increment, _SQL_GROUPS),
    Query("model_daily_increment", _model_daily_increment, _SQL_MODEL),
]

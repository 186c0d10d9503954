"""Incremental loads of new, late, repeated and timeless rows, run twice to show that a second run adds nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.projections import temporal_split
from lakecast.operators.quality import Rule
from lakecast.operators.encoding import build_code_table, extend_code_table
from lakecast.plans.landing import backfill_missing
from lakecast.plans.loading import append_curated, load_validated
from lakecast.queries.common import Query, comparable, table
from lakecast.queries.lookups import ORDER_COLUMNS, OVERLAP_FROM, SPLIT_AT, SQL_ORDERS
from lakecast.session import scratch_path
from lakecast.sources.files import common_columns, scan_months
from lakecast.sources.tables import scan_table, write_partitioned
from lakecast.streaming.incremental import run_incremental_stream

KEYS = ("o_orderkey", "o_orderdate", "o_orderpriority")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


#: Most rows of a landed file.
FILE_ROWS = 1_000_000


def _rules(high: float = 1e12):
    return [
        *(Rule.exists(c) for c in ORDER_COLUMNS),
        Rule.in_set("o_orderpriority", PRIORITIES),
        Rule.between("o_totalprice", 0.0, high),
    ]


def _batches(spark, sf_dir):
    """Orders before a date, and all orders from a few days earlier on."""
    orders = table(spark, sf_dir, "orders")
    first, _ = temporal_split(orders, "o_orderdate", SPLIT_AT)
    _, second = temporal_split(orders, "o_orderdate", OVERLAP_FROM)
    return first, second


def _validated(high: float = 1e12, on_fail: str = "quarantine_batch"):
    def run(spark, sf_dir):
        path, good, bad = (scratch_path(spark, name) for name in ("orders", "good", "bad"))
        first, second = _batches(spark, sf_dir)
        load_validated(first, path, _rules(), "o_orderdate", good, bad)
        for _ in range(2):
            load_validated(second, path, _rules(high), "o_orderdate", good, bad, on_fail=on_fail)
        return comparable(scan_table(spark, path).select(*ORDER_COLUMNS))

    return run


def _curated(spark, sf_dir):
    path, increment = scratch_path(spark, "curated"), scratch_path(spark, "increment")
    first, second = _batches(spark, sf_dir)
    append_curated(first, path, increment, KEYS, ORDER_COLUMNS)
    for _ in range(2):
        append_curated(second, path, increment, KEYS, ORDER_COLUMNS)
    return comparable(scan_table(spark, path))


def _snapshot(spark, sf_dir):
    """The last increment: the rows the second batch added."""
    path, increment = scratch_path(spark, "curated"), scratch_path(spark, "increment")
    first, second = _batches(spark, sf_dir)
    append_curated(first, path, increment, KEYS, ORDER_COLUMNS)
    append_curated(second, path, increment, KEYS, ORDER_COLUMNS)
    return comparable(scan_table(spark, increment))


def _stream(spark, sf_dir):
    """All orders arrive as files; the stream merges them into a table that has the old ones."""
    landing, path, good, bad, state = (
        scratch_path(spark, name) for name in ("landing", "orders", "good", "bad", "stream")
    )
    orders = table(spark, sf_dir, "orders")
    first, _ = temporal_split(orders, "o_orderdate", SPLIT_AT)
    write_partitioned(first.withColumn("year", F.year("o_orderdate")), path, spread=True)
    orders.write.parquet(landing)

    def load(batch):
        load_validated(batch, path, _rules(), "o_orderdate", good, bad)

    for _ in range(2):
        run_incremental_stream(spark, landing, orders.schema, load, state)
    return comparable(scan_table(spark, path).select(*ORDER_COLUMNS))


def _late_rows(fmt: str = "parquet"):
    """The newer half is loaded first; the batch after it brings the older half, and some rows again."""

    def run(spark, sf_dir):
        path, good, bad = (scratch_path(spark, name) for name in ("orders", "good", "bad"))
        orders = table(spark, sf_dir, "orders")
        older, _ = temporal_split(orders, "o_orderdate", SPLIT_AT)
        _, newer = temporal_split(orders, "o_orderdate", OVERLAP_FROM)
        for batch in (newer, older, older.union(newer)):
            load_validated(batch, path, _rules(), "o_orderdate", good, bad, fmt=fmt)
        return comparable(scan_table(spark, path, fmt).select(*ORDER_COLUMNS))

    return run


_TIMELESS = "o_orderkey % 7 = 0"


def _null_time(spark, sf_dir):
    """Some rows of a batch have no time and some break a rule: what is in the table and in quarantine."""
    path, good, bad = (scratch_path(spark, name) for name in ("orders", "good", "bad"))
    first, second = _batches(spark, sf_dir)
    load_validated(first, path, _rules(), "o_orderdate", good, bad)
    timeless = second.withColumn("o_orderdate", F.when(~F.expr(_TIMELESS), F.col("o_orderdate")))
    for _ in range(2):
        load_validated(timeless, path, _rules(_HIGH), "o_orderdate", good, bad, on_fail="split")
    table_, *quarantined = (
        scan_table(spark, place).select(F.lit(side).alias("side"), *ORDER_COLUMNS)
        for side, place in (("table", path), ("good", good), ("bad", bad))
    )
    return comparable(table_.union(quarantined[0]).union(quarantined[1]))


def _backfill_then_validate(spark, sf_dir):
    """The newer months are landed and validated, then the older ones are backfilled and validated."""
    lake, path, good, bad = (scratch_path(spark, name) for name in ("lake", "orders", "good", "bad"))
    orders = table(spark, sf_dir, "orders")
    first, last = orders.agg(F.date_format(F.min("o_orderdate"), "MM/yyyy"), F.date_format(F.max("o_orderdate"), "MM/yyyy")).first()
    middle = F.date_format(F.lit(SPLIT_AT).cast("timestamp"), "MM/yyyy")
    start = spark.range(1).select(middle).first()[0]
    for begin in (start, first):
        backfill_missing(orders, "o_orderdate", lake, begin, last)
        load_validated(scan_months(spark, lake).select(*ORDER_COLUMNS), path, _rules(), "o_orderdate", good, bad)
    return comparable(scan_table(spark, path).select(*ORDER_COLUMNS))


def _land(rows, landing):
    """Rows arrive as the files that their tasks write, none of them large."""
    rows.write.option("maxRecordsPerFile", FILE_ROWS).mode("append").parquet(landing)


def _stream_two_batches(spark, sf_dir):
    """The newer rows arrive first, then the older ones; all files that arrive together are a batch of their own."""
    landing, path, good, bad, state = (
        scratch_path(spark, name) for name in ("landing", "orders", "good", "bad", "stream")
    )
    orders = table(spark, sf_dir, "orders")
    older, newer = temporal_split(orders, "o_orderdate", SPLIT_AT)

    def load(batch):
        load_validated(batch, path, _rules(), "o_orderdate", good, bad)

    for part in (newer, older):
        _land(part, landing)
        files = len(scan_table(spark, landing).inputFiles())
        run_incremental_stream(spark, landing, orders.schema, load, state, files_per_batch=files)
    return comparable(scan_table(spark, path).select(*ORDER_COLUMNS))


def _curated_orc(spark, sf_dir):
    path, increment = scratch_path(spark, "curated"), scratch_path(spark, "increment")
    first, second = _batches(spark, sf_dir)
    for batch in (second, first, second):
        append_curated(batch, path, increment, KEYS, ORDER_COLUMNS, fmt="orc")
    return comparable(scan_table(spark, path, "orc"))


def _schema_gate_files(spark, sf_dir):
    """Some of the landed files lack a column that a rule asks for: nothing is loaded."""
    landing, path, good, bad = (scratch_path(spark, name) for name in ("landing", "orders", "good", "bad"))
    orders = table(spark, sf_dir, "orders")
    older, newer = temporal_split(orders, "o_orderdate", SPLIT_AT)
    _land(older, landing)
    _land(newer.drop("o_orderpriority"), landing)
    columns = common_columns(spark, landing)
    try:
        load_validated(spark.read.schema(orders.schema).parquet(landing), path, _rules(), "o_orderdate", good, bad, columns)
    except ValueError:
        loaded = 0
    else:
        loaded = scan_table(spark, path).count()
    rows = [(c, c in columns, loaded) for c in orders.columns]
    return spark.createDataFrame(rows, "`column` string, in_every_file boolean, rows_loaded bigint")


def _codes_extended(spark, sf_dir):
    """Codes of the first half of the parts' labels, extended by all: the first keep theirs."""
    part = table(spark, sf_dir, "part")
    half = part.where("p_partkey <= 100")
    columns = ["p_brand", "p_type", "p_name"]
    return comparable(extend_code_table(build_code_table(half, columns), part, columns))


def _sql_codes(column):
    return f"""
    SELECT '{column}' AS "column", label, CAST(row_number() OVER (ORDER BY late, label) AS BIGINT) AS code
    FROM (SELECT {column} AS label, min(CASE WHEN p_partkey <= 100 THEN 0 ELSE 1 END) AS late FROM part GROUP BY 1)"""


_HIGH = 300000.0
_SQL_BATCH = f"""
    SELECT * REPLACE (CASE WHEN NOT ({_TIMELESS}) THEN o_orderdate END AS o_orderdate)
    FROM orders WHERE o_orderdate >= TIMESTAMP '{OVERLAP_FROM}'"""
_SQL_NULL_TIME = f"""
    WITH batch AS ({_SQL_BATCH}),
    merged AS (
      SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_AT}'
      UNION ALL SELECT * FROM batch WHERE o_totalprice <= {_HIGH}
        AND (o_orderdate IS NULL OR o_orderdate >= TIMESTAMP '{SPLIT_AT}'))
    SELECT 'table' AS side, {SQL_ORDERS} FROM merged
    UNION ALL SELECT 'good', {SQL_ORDERS} FROM batch WHERE o_totalprice <= {_HIGH}
    UNION ALL SELECT 'bad', {SQL_ORDERS} FROM batch WHERE o_totalprice > {_HIGH}"""

QUERIES = [
    Query("incremental_validated", _validated(), f"SELECT {SQL_ORDERS} FROM orders"),
    Query("incremental_quarantined", _validated(_HIGH),
          f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_AT}'"),
    Query("incremental_split", _validated(_HIGH, "split"),
          f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_AT}' OR o_totalprice <= {_HIGH}"),
    Query("incremental_curated", _curated, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("increment_snapshot", _snapshot,
          f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_AT}'"),
    Query("incremental_stream", _stream, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("incremental_late_rows", _late_rows(), f"SELECT {SQL_ORDERS} FROM orders"),
    Query("incremental_null_time", _null_time, _SQL_NULL_TIME),
    Query("incremental_validated_orc", _late_rows("orc"), f"SELECT {SQL_ORDERS} FROM orders"),
    Query("incremental_curated_orc", _curated_orc, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("backfill_then_validate", _backfill_then_validate, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("stream_two_batches", _stream_two_batches, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("schema_gate_files", _schema_gate_files,
          "SELECT column_name AS \"column\", column_name <> 'o_orderpriority' AS in_every_file, "
          "CAST(0 AS BIGINT) AS rows_loaded FROM (DESCRIBE orders)"),
    Query("codes_extended", _codes_extended, " UNION ALL ".join(map(_sql_codes, ("p_brand", "p_type", "p_name")))),
]

"""Landing, month partitions and tables, written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.functions.temporal import month_label
from lakecast.operators.sets import union_all
from lakecast.plans.landing import backfill_missing, resume_month
from lakecast.queries.common import Query, comparable, sql_time, table
from lakecast.queries.lookups import ORDER_COLUMNS, SQL_ORDERS
from lakecast.session import scratch_path
from lakecast.sources.files import (
    append_months,
    bounded_fetch,
    json_to_parquet,
    list_months,
    newest_month,
    parse_time_column,
    scan_code_csv,
    scan_json,
    scan_months,
    scan_parquet,
    write_months,
)
from lakecast.sources.tables import (
    append_to_current,
    compact,
    create_or_replace_as,
    latest_in_partitions,
    read_current,
    remove_versions,
    replace_self,
    scan_table,
    scan_warehouse,
    write_partitioned,
    write_warehouse,
)

EVENT_SCHEMA = "event_id bigint, ts string, event_type string, value double, props struct<k: bigint>"
HELD_BACK_FROM = "2001-06-10"


def _landed_json(spark, sf_dir):
    """Events as JSON lines with ISO time text, as an open-data API would deliver them."""
    path = scratch_path(spark, "landed")
    events = table(spark, sf_dir, "events")
    events.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ts"),
        "event_type",
        "value",
        F.from_json("props", "k bigint").alias("props"),
    ).write.json(path)
    return scan_json(spark, path, _schema(EVENT_SCHEMA))


def _schema(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _bounded_fetch(spark, sf_dir):
    landed = parse_time_column(_landed_json(spark, sf_dir), "ts")
    rows = bounded_fetch(landed, "ts", "01/05/2024", "01/11/2024")
    return comparable(rows.select("event_id", "ts", "event_type", "value", F.col("props.k").alias("k")))


def _json_to_parquet(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    json_to_parquet(_landed_json(spark, sf_dir), "ts", path)
    rows = scan_parquet(spark, path)
    return comparable(rows.select("event_id", "ts", "event_type", "value", F.col("props.k").alias("k")))


def _order_lake(spark, sf_dir):
    """Orders by month: one part written, the rest appended to old and new months."""
    root = scratch_path(spark, "lake")
    orders = table(spark, sf_dir, "orders")
    held_back = F.col("o_orderdate") >= F.lit(HELD_BACK_FROM).cast("timestamp_ntz")
    write_months(orders.where(~held_back), "o_orderdate", root)
    append_months(orders.where(held_back), "o_orderdate", root)
    return root


def _lake_rows(spark, sf_dir):
    lake = scan_months(spark, _order_lake(spark, sf_dir))
    return comparable(
        lake.groupBy("year", "month").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.round("o_totalprice").cast("bigint")).alias("total")
        )
    )


def _list_months(spark, sf_dir):
    return comparable(list_months(spark, _order_lake(spark, sf_dir)))


def _newest_month(spark, sf_dir):
    return comparable(newest_month(list_months(spark, _order_lake(spark, sf_dir))))


def _backfill(spark, sf_dir):
    """A lake with every third month is backfilled; nothing is loaded twice."""
    root = scratch_path(spark, "lake")
    orders = table(spark, sf_dir, "orders")
    write_months(orders.where(F.month("o_orderdate") % 3 == 0), "o_orderdate", root)
    backfill_missing(orders, "o_orderdate", root, "01/1995", "12/2000")
    lake = scan_months(spark, root)
    return comparable(lake.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")))


def _resume(spark, sf_dir):
    """A lake that stops inside its last month takes the rest of that month, no more."""
    root = scratch_path(spark, "lake")
    orders = table(spark, sf_dir, "orders")
    loaded = F.col("o_orderdate") < F.lit(HELD_BACK_FROM).cast("timestamp_ntz")
    write_months(orders.where(loaded), "o_orderdate", root)
    resume_month(orders, "o_orderdate", root)
    return comparable(scan_months(spark, root).select(*ORDER_COLUMNS))


def _yearly_table(spark, sf_dir):
    path = scratch_path(spark, "yearly")
    orders = table(spark, sf_dir, "orders")
    write_partitioned(orders.withColumn("year", F.year("o_orderdate")), path)
    return path


def _write_partitioned(spark, sf_dir):
    rows = scan_table(spark, _yearly_table(spark, sf_dir))
    return comparable(rows.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("top")))


def _latest_in_partitions(spark, sf_dir):
    """High-water mark of a partitioned table, then the rows that carry it."""
    path = _yearly_table(spark, sf_dir)
    top = latest_in_partitions(spark, path, "o_orderdate")
    rows = scan_table(spark, path).where(F.col("o_orderdate") == F.lit(top).cast("timestamp_ntz"))
    return comparable(rows.select(*ORDER_COLUMNS))


def _replace_self(spark, sf_dir):
    """A table replaced by itself plus new rows."""
    root = scratch_path(spark, "history")
    orders = table(spark, sf_dir, "orders")
    held_back = F.col("o_orderdate") >= F.lit(HELD_BACK_FROM).cast("timestamp_ntz")
    replace_self(orders.where(~held_back), root)
    replace_self(union_all(read_current(spark, root), orders.where(held_back)), root)
    return comparable(read_current(spark, root).select(*ORDER_COLUMNS))


def _compacted(spark, sf_dir):
    """Orders appended in four batches to years, their small files merged, older states removed."""
    root = scratch_path(spark, "appended")
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    for batch in range(4):
        append_to_current(orders.where(F.pmod("o_orderkey", F.lit(4)) == batch), root, ["year"])
    compact(spark, root)
    remove_versions(spark, root, keep=1)
    return comparable(read_current(spark, root).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents")))


def _create_or_replace(spark, sf_dir):
    path = scratch_path(spark, "staging")
    lineitem = table(spark, sf_dir, "lineitem")
    step = create_or_replace_as(lineitem.select("l_returnflag", "l_quantity"), path)
    return comparable(step.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity")))


def _warehouse(spark, sf_dir):
    """Overwrite then append through a connector named by its format."""
    path = scratch_path(spark, "warehouse")
    lineitem = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    for mode, flag in (("overwrite", "F"), ("append", "O")):
        write_warehouse(lineitem.where(F.col("l_linestatus") == flag), "lines", mode, "orc", path=path)
    rows = scan_warehouse(spark, "lines", "orc", path=path)
    return comparable(
        rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("quantity"))
    )


def _code_csv(spark, sf_dir):
    """A code file written as CSV, labels with commas included, and read back."""
    path = scratch_path(spark, "codes")
    part = table(spark, sf_dir, "part")
    listed = part.select(F.concat_ws(", ", "p_name", "p_brand").alias("label"), F.col("p_partkey").alias("code"))
    listed.write.option("header", "true").csv(path)
    return comparable(scan_code_csv(spark, path, "label", "code"))


def _month_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    label = month_label(F.col("o_orderdate")).alias("month_label")
    return orders.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


_SQL_EVENTS = (
    f"SELECT event_id, {sql_time('ts', 'ts')}, event_type, round(value, 6) AS value, "
    "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
)
_SQL_MONTH = "CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month"

QUERIES = [
    Query("bounded_fetch", _bounded_fetch,
          f"{_SQL_EVENTS} WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'"),
    Query("json_to_parquet", _json_to_parquet, _SQL_EVENTS),
    Query("lake_rows", _lake_rows,
          f"SELECT {_SQL_MONTH}, COUNT(*) AS n, CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total "
          "FROM orders GROUP BY 1, 2"),
    Query("list_months", _list_months,
          "SELECT DISTINCT strftime(o_orderdate, '%m-%Y') AS month_label, "
          "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start FROM orders"),
    Query("newest_month", _newest_month,
          "SELECT strftime(MAX(date_trunc('month', o_orderdate)), '%Y-%m-%d') AS month_start FROM orders"),
    Query("backfill_missing", _backfill,
          f"SELECT {_SQL_MONTH}, COUNT(*) AS n FROM orders "
          "WHERE month(o_orderdate) % 3 = 0 OR o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1, 2"),
    Query("resume_month", _resume,
          f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'"),
    Query("write_partitioned", _write_partitioned,
          "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) AS n, MAX(o_orderkey) AS top FROM orders GROUP BY 1"),
    Query("latest_in_partitions", _latest_in_partitions,
          f"SELECT {SQL_ORDERS} FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)"),
    Query("replace_self", _replace_self, f"SELECT {SQL_ORDERS} FROM orders"),
    Query("compacted_appends", _compacted,
          "SELECT year(o_orderdate)::INT AS year, COUNT(*) AS n, SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY 1"),
    Query("create_or_replace_as", _create_or_replace,
          "SELECT l_returnflag, round(SUM(l_quantity), 6) AS quantity FROM lineitem GROUP BY 1"),
    Query("warehouse_round_trip", _warehouse,
          "SELECT l_returnflag, l_linestatus, round(SUM(l_quantity), 6) AS quantity FROM lineitem GROUP BY 1, 2"),
    Query("code_csv", _code_csv,
          "SELECT p_partkey AS code, p_name || ', ' || p_brand AS label FROM part"),
    Query("month_labels", _month_labels,
          "SELECT strftime(o_orderdate, '%m-%Y') AS month_label, COUNT(*) AS n FROM orders GROUP BY 1"),
]

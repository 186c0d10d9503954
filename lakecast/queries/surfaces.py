"""Descriptions, previews, reference lists and the small answers that loads and jobs ask for."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.aggregates import is_empty, max_time
from lakecast.operators.joins import member_flag
from lakecast.operators.quality import Rule, all_success, run_suite
from lakecast.queries.common import Query, comparable, sql_time, table
from lakecast.session import scratch_path
from lakecast.sources.files import preview, reference_values
from lakecast.sources.tables import as_rows
from lakecast.surface import describe


def _describe(spark, sf_dir):
    return describe(table(spark, sf_dir, "lineitem"))


def _reference_list(spark, sf_dir):
    """Nations with suppliers on file, from a CSV reference list: is each customer's nation among them?"""
    path = scratch_path(spark, "reference")
    nations = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    nations.select(F.col("n_nationkey").cast("string").alias("key"), "n_name").write.option("header", True).csv(path)
    listed = reference_values(spark, path, ["key", "n_name"])
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return comparable(member_flag(customers, "nation", listed, "key", "listed"))


def _newest_orders(spark, sf_dir):
    """The first few rows in a fixed order, as a display gets them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = as_rows(orders, [F.col("o_orderdate").desc(), "o_orderkey"], 20)
    return comparable(spark.createDataFrame([(r["o_orderkey"], r["o_orderdate"]) for r in rows], "o_orderkey bigint, o_orderdate timestamp"))


def _answers(spark, sf_dir):
    """Whether tables are empty, whether rules pass, and the latest time."""
    orders = table(spark, sf_dir, "orders")
    summary = run_suite(orders, [Rule.exists("o_orderkey"), Rule.between("o_totalprice", 0, 1000)], sample=0)
    latest = max_time(orders, "o_orderdate")
    facts = (
        is_empty(orders),
        is_empty(orders.where("o_totalprice < 0")),
        all_success(summary),
        all_success(summary, "expect_column_to_exist"),
    )
    names = ("latest", "orders_empty", "negative_empty", "all_pass", "columns_pass")
    return comparable(spark.range(1).select(*(F.lit(f).alias(n) for n, f in zip(names, (latest, *facts), strict=True))))


def _preview(spark, sf_dir):
    return comparable(preview(table(spark, sf_dir, "customer"), 25, ["c_custkey"]))


QUERIES = [
    Query("describe_table", _describe,
          "SELECT column_name AS name, CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
          "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' ELSE 'timestamp_ntz' END AS type, 'NULLABLE' AS mode "
          "FROM (DESCRIBE lineitem)"),
    Query("reference_list", _reference_list,
          "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, c_nationkey < 20 AS listed FROM customer"),
    Query("newest_orders", _newest_orders,
          f"SELECT o_orderkey, {sql_time('o_orderdate', 'o_orderdate')} FROM "
          "(SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20)"),
    Query("load_answers", _answers,
          f"SELECT {sql_time('max(o_orderdate)', 'latest')}, count(*) = 0 AS orders_empty, "
          "count(*) FILTER (WHERE o_totalprice < 0) = 0 AS negative_empty, "
          "bool_and(o_totalprice BETWEEN 0 AND 1000) AS all_pass, true AS columns_pass FROM orders"),
    Query("preview_rows", _preview, "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment "
          "FROM customer ORDER BY c_custkey LIMIT 25"),
]

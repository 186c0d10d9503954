"""Rule suites and isolation over customers and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakecast.operators.quality import (
    Rule,
    good_bad_ratio,
    isolate,
    rule_counts,
    run_suite,
)
from lakecast.plans.loading import quarantine
from lakecast.queries.common import Query, comparable, table
from lakecast.session import scratch_path
from lakecast.sources.tables import scan_table

SAMPLE = 20


def _lines(spark, sf_dir):
    """Line items with some nulls: the flag of every eleventh order, the tax of every seventh part."""
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_discount",
        F.when(F.col("l_orderkey") % 11 != 0, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_tax")).alias("l_tax"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipday"),
    )


def _rules(spark, sf_dir):
    """One rule of each kind and more; suppliers of one region's nations are the member list."""
    nation = table(spark, sf_dir, "nation").where("n_regionkey <> 0")
    supplier = table(spark, sf_dir, "supplier")
    allowed = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left_semi")
    return [
        Rule.exists("l_orderkey"),
        Rule.exists("l_returnflag"),
        Rule.exists("l_shipmode"),
        Rule.regex("l_shipday", r"^\d{4}-\d{2}-[0-2]\d$"),
        Rule.in_set("l_returnflag", ["A", "N"]),
        Rule.in_table("l_suppkey", allowed, "s_suppkey"),
        Rule.between("l_quantity", 2, 49),
        Rule.between("l_discount", 0.0, 0.08),
        Rule.between("l_tax", 0.0, 0.07),
    ]


_IDS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipday")


def _suite(spark, sf_dir):
    summary = run_suite(_lines(spark, sf_dir), _rules(spark, sf_dir), sample=SAMPLE)
    listed = F.concat_ws("|", "partial_unexpected_list").alias("partial_unexpected_list")
    return comparable(
        summary.select("rule", "kind", "column", "success", "unexpected_count", "unexpected_percent", listed)
    )


def _rule_counts(spark, sf_dir):
    return comparable(rule_counts(_lines(spark, sf_dir), _rules(spark, sf_dir)))


def _ratio(spark, sf_dir):
    return comparable(good_bad_ratio(_lines(spark, sf_dir), _rules(spark, sf_dir)))


def _side(side, null_policy="bad"):
    def run(spark, sf_dir):
        sides = isolate(_lines(spark, sf_dir), _rules(spark, sf_dir), null_policy)
        return comparable(sides[side].select(*_IDS))

    return run


def _quarantine(spark, sf_dir):
    """Both quarantine tables, as written."""
    good_path, bad_path = scratch_path(spark, "good"), scratch_path(spark, "bad")
    lines = _lines(spark, sf_dir)
    quarantine(lines, _rules(spark, sf_dir), lines.schema, good_path, bad_path)
    good, bad = (
        scan_table(spark, path).select(F.lit(name).alias("side"), "l_returnflag", "l_quantity")
        for name, path in (("good", good_path), ("bad", bad_path))
    )
    return comparable(
        good.unionByName(bad)
        .groupBy("side", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    )


# --- the same in SQL --------------------------------------------------------------------

_SQL_LINES = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount,
       CASE WHEN l_orderkey % 11 <> 0 THEN l_returnflag END AS l_returnflag,
       CASE WHEN l_partkey % 7 <> 0 THEN l_tax END AS l_tax,
       strftime(l_shipdate, '%Y-%m-%d') AS l_shipday
FROM lineitem
"""
_SQL_ALLOWED = (
    "SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 0"
)
# Number, kind, column, condition, value as text.
_SQL_RULES = (
    (3, "match_regex", "l_shipday", r"regexp_matches(l_shipday, '^\d{4}-\d{2}-[0-2]\d$')", "l_shipday"),
    (4, "be_in_set", "l_returnflag", "l_returnflag IN ('A', 'N')", "l_returnflag"),
    (5, "be_in_set", "l_suppkey", f"l_suppkey IN ({_SQL_ALLOWED})", "CAST(l_suppkey AS VARCHAR)"),
    (6, "be_between", "l_quantity", "l_quantity BETWEEN 2 AND 49", "CAST(l_quantity AS VARCHAR)"),
    (7, "be_between", "l_discount", "l_discount BETWEEN 0.0 AND 0.08", "CAST(l_discount AS VARCHAR)"),
    (8, "be_between", "l_tax", "l_tax BETWEEN 0.0 AND 0.07", "CAST(l_tax AS VARCHAR)"),
)
_SQL_OK = " AND ".join(f"({condition})" for _, _, _, condition, _ in _SQL_RULES)
_SQL_IDS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS l_quantity, l_shipday"
)


def _sql_suite() -> str:
    checked = ", ".join(f"({condition}) AS ok_{i}" for i, _, _, condition, _ in _SQL_RULES)
    texts = ", ".join(f"{value} AS text_{i}" for i, _, _, _, value in _SQL_RULES)
    parts = [
        f"""SELECT {i} AS rule, 'expect_column_values_to_{kind}' AS kind, '{column}' AS "column",
        COUNT(*) FILTER (WHERE NOT ok_{i}) = 0 AS success,
        COUNT(*) FILTER (WHERE NOT ok_{i}) AS unexpected_count,
        round(COUNT(*) FILTER (WHERE NOT ok_{i}) * 100.0 / COUNT({column}), 6) AS unexpected_percent,
        coalesce((SELECT string_agg(t, '|' ORDER BY t) FROM
          (SELECT text_{i} AS t FROM c WHERE NOT ok_{i} ORDER BY 1 LIMIT {SAMPLE})), '') AS partial_unexpected_list
        FROM c"""
        for i, kind, column, _, _ in _SQL_RULES
    ]
    for i, column in enumerate(("l_orderkey", "l_returnflag", "l_shipmode")):
        success = "false" if column == "l_shipmode" else "true"
        parts.append(
            f"SELECT {i}, 'expect_column_to_exist', '{column}', {success}, 0, 0.0, ''"
        )
    return f"WITH c AS MATERIALIZED (SELECT *, {checked}, {texts} FROM ({_SQL_LINES})) " + " UNION ALL ".join(parts)


def _sql_counts() -> str:
    checked = ", ".join(f"({condition}) AS ok_{i}" for i, _, _, condition, _ in _SQL_RULES)
    parts = [
        f"SELECT 'expect_column_values_to_{kind}' AS kind, '{column}' AS \"column\", "
        f"COUNT(*) FILTER (WHERE ok_{i}) AS success_count, "
        f"COUNT(*) - COUNT(*) FILTER (WHERE ok_{i}) AS failure_count FROM c"
        for i, kind, column, _, _ in _SQL_RULES
    ]
    return f"WITH c AS MATERIALIZED (SELECT *, {checked} FROM ({_SQL_LINES})) " + " UNION ALL ".join(parts)


_GOOD = f"coalesce({_SQL_OK}, false)"

QUERIES = [
    Query("suite_summary", _suite, _sql_suite()),
    Query("rule_counts", _rule_counts, _sql_counts()),
    Query("good_bad_ratio", _ratio,
          f"SELECT COUNT(*) AS row_count, round(AVG(CAST({_GOOD} AS DOUBLE)), 6) AS good_ratio, "
          f"round(1.0 - AVG(CAST({_GOOD} AS DOUBLE)), 6) AS bad_ratio FROM ({_SQL_LINES})"),
    Query("isolate_good", _side(0), f"SELECT {_SQL_IDS} FROM ({_SQL_LINES}) WHERE {_GOOD}"),
    Query("isolate_bad", _side(1), f"SELECT {_SQL_IDS} FROM ({_SQL_LINES}) WHERE NOT {_GOOD}"),
    Query("isolate_bad_drop_nulls", _side(1, "drop"),
          f"SELECT {_SQL_IDS} FROM ({_SQL_LINES}) WHERE NOT ({_SQL_OK})"),
    Query("quarantine_tables", _quarantine,
          f"SELECT CASE WHEN {_GOOD} THEN 'good' ELSE 'bad' END AS side, l_returnflag, COUNT(*) AS n, "
          f"round(SUM(l_quantity), 6) AS quantity FROM ({_SQL_LINES}) GROUP BY 1, 2"),
]

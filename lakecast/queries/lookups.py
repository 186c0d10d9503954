"""Filters, scalar functions, joins, aggregates, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecast.functions.numeric import PREDICTION_CASTS
from lakecast.functions.temporal import (
    month_end,
    nanos_to_text,
    nanos_to_timestamp,
    parse_timestamp,
    shift,
)
from lakecast.operators.aggregates import (
    count_where,
    distinct_keys,
    distinct_rows,
    global_sum,
    latest_row,
    regression_metrics,
)
from lakecast.operators.encoding import (
    build_code_table,
    code_listing,
    codes_from_maps,
    codes_from_table,
    decode_labels,
    decode_with_maps,
    encode,
    rank_labels_by_range,
    distinct_labels,
)
from lakecast.operators.joins import (
    anti_new_rows,
    expected_months,
    member_of_dim,
    missing_months,
    missing_rows,
    months_present,
)
from lakecast.operators.projections import (
    cast_measures,
    cast_to_schema,
    derive_year,
    equality_filter,
    filter_after_max_of,
    filter_at_max,
    filter_last_k,
    match_date,
    remove_date,
    select_required,
    since_high_water,
    temporal_split,
    time_range,
)
from lakecast.operators.sets import concat_by_name, set_difference, union_all
from lakecast.plans.landing import resume_window
from lakecast.queries.common import (
    DAILY,
    HOURLY,
    SQL_DAILY,
    SQL_DAILY_SERIES,
    SQL_HOURLY,
    Query,
    comparable,
    daily_model,
    encoded_daily,
    encoded_hourly,
    sql_date,
    sql_double,
    sql_edge,
    sql_model_ctes,
    sql_time,
    table,
)
from lakecast.series import SeriesSpec
from lakecast.surface import run_sql, sample_rows, with_calendar_parts

SPLIT_AT = "2001-07-15"
OVERLAP_FROM = "2001-07-10"
ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)
SQL_ORDERS = (
    "o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, "
    f"{sql_time('o_orderdate', 'o_orderdate')}, o_orderpriority"
)
_DAILY_COLUMNS = (DAILY.time, *DAILY.keys, "ridership", "transfer")
_HOURLY_COLUMNS = (HOURLY.time, *HOURLY.keys, "ridership")


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def _on_orders(build):
    """A query over all orders that returns whole order rows."""

    def run(spark, sf_dir):
        return comparable(build(_orders(spark, sf_dir)).select(*ORDER_COLUMNS))

    return run


def _split_counts(spark, sf_dir):
    train, test = temporal_split(_orders(spark, sf_dir), "o_orderdate", "2000-01-01")
    sides = [
        df.groupBy(F.lit(side).alias("side"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
        for side, df in (("train", train), ("test", test))
    ]
    return union_all(*sides)


def _select_required(spark, sf_dir):
    return comparable(select_required(table(spark, sf_dir, "events"), ["event_id", "ts", "event_type", "value"]))


def _cast_to_schema(spark, sf_dir):
    """Text that is partly no number: part names next to their sizes."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string")).alias("p_size"),
        F.col("p_retailprice").cast("string").alias("p_retailprice"),
    )
    schema = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    )
    return comparable(cast_to_schema(part, schema))


def _cast_measures(spark, sf_dir):
    """Discounts as text, every fifth one unreadable, to float."""
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_linenumber") % 5 == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("string"))
        .alias("l_quantity"),
    )
    return comparable(cast_measures(rows, ["l_quantity"]))


def _nanos(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn(
        "nanos", F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    )
    shaped = events.select(
        "event_id",
        "nanos",
        nanos_to_text(F.col("nanos")).alias("ts_text"),
        nanos_to_timestamp(F.col("nanos")).alias("_t"),
    )
    return comparable(derive_year(shaped, "_t").drop("_t"))


def _parsed_times(spark, sf_dir):
    """ISO text back to a time; text that is none becomes null."""
    events = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    )
    parsed = parse_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss.SSS", strict=False)
    return comparable(
        events.select("event_id", parsed.alias("ts"), F.unix_timestamp(parsed).alias("epoch"))
    )


def _shifted_times(spark, sf_dir):
    ts = F.col("ts")
    return comparable(
        table(spark, sf_dir, "events").select(
            "event_id",
            shift(ts, 1, "hour").alias("next_hour"),
            shift(ts, -29, "hour").alias("hours_back"),
            shift(F.to_date(ts), 1, "day").alias("next_day"),
            shift(F.to_date(ts), -29, "day").alias("days_back"),
        )
    )


def _calendar_parts(spark, sf_dir):
    return comparable(with_calendar_parts(_orders(spark, sf_dir).select("o_orderkey", "o_orderdate"), "o_orderdate"))


def _prediction_casts(spark, sf_dir):
    """Rounded and truncated account balances, negative halves included."""
    customer = table(spark, sf_dir, "customer")
    half = F.col("c_acctbal") - F.lit(5000)
    return comparable(
        customer.select(
            "c_custkey",
            PREDICTION_CASTS["round"](half).alias("rounded"),
            PREDICTION_CASTS["truncate"](half).alias("truncated"),
        )
    )


def _month_ends(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    ends = orders.select(month_end(F.col("o_orderdate")).alias("month_end"))
    return comparable(ends.groupBy("month_end").agg(F.count(F.lit(1)).alias("n")))


def _missing_months(spark, sf_dir):
    present = months_present(_orders(spark, sf_dir), "o_orderdate")
    return comparable(missing_months(expected_months(spark, "07/1994", "12/2002"), present))


def _set_difference(spark, sf_dir):
    present = months_present(_orders(spark, sf_dir), "o_orderdate")
    return comparable(set_difference(expected_months(spark, "07/1994", "12/2002"), present))


def _at_max(series, spec, columns):
    def run(spark, sf_dir):
        return comparable(filter_at_max(series(spark, sf_dir), spec.time).select(*columns))

    return run


def _last_k(series, spec, columns):
    def run(spark, sf_dir):
        return comparable(filter_last_k(series(spark, sf_dir), spec).select(*columns))

    return run


def _after_max(spark, sf_dir):
    """Order dates later than the last ship date of returned items before a cut-off."""
    orders = _orders(spark, sf_dir)
    shipped = table(spark, sf_dir, "lineitem").where("l_shipdate < timestamp_ntz'2001-03-01 00:00:00'")
    later = filter_after_max_of(
        orders, "o_orderdate", shipped.select(F.col("l_shipdate").alias("o_orderdate"))
    )
    return comparable(later.select(*ORDER_COLUMNS))


def _old_and_new(spark, sf_dir):
    """Target: orders before a date. Source: a few days of overlap and all that follows."""
    orders = _orders(spark, sf_dir)
    target, _ = temporal_split(orders, "o_orderdate", SPLIT_AT)
    return target, since_high_water(orders, "o_orderdate", OVERLAP_FROM)


def _anti_new_rows(spark, sf_dir):
    target, source = _old_and_new(spark, sf_dir)
    return comparable(anti_new_rows(source, target, ["o_orderdate", "o_custkey", "o_orderpriority"]))


def _merge_insert_only(spark, sf_dir):
    """Target without the nulls of the source: null-safe on all columns, then the union."""
    target, source = _old_and_new(spark, sf_dir)
    blank = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority"))
    target, source = (df.withColumn("o_orderpriority", blank) for df in (target, source))
    new = missing_rows(source, target, ORDER_COLUMNS, dedupe=True)
    return comparable(union_all(target, new))


def _member(keep):
    def run(spark, sf_dir):
        nation = table(spark, sf_dir, "nation")
        allowed = equality_filter(nation, "n_regionkey", 2)
        customer = table(spark, sf_dir, "customer")
        return comparable(
            member_of_dim(customer, "c_nationkey", allowed, "n_nationkey", keep).select("c_custkey", "c_nationkey")
        )

    return run


def _code_table(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return comparable(build_code_table(part, ["p_brand", "p_type", "p_name"]))


def _code_table_by_range(spark, sf_dir):
    """The ranking for big label sets, on all customer names."""
    labels = distinct_labels(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])
    return comparable(rank_labels_by_range(labels, 16))


def _code_listing(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return comparable(code_listing(build_code_table(part, ["p_brand"]), "p_brand"))


def _decode_labels(spark, sf_dir):
    """Customers by nation code, decoded through a code table; unknown codes give null."""
    nation = table(spark, sf_dir, "nation")
    codes = codes_from_table(nation.where("n_nationkey < 20"), "nation", "n_name", "n_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation_index"))
    return comparable(decode_labels(customer, codes, ["nation"], keep_codes=True))


def _decode_with_maps(spark, sf_dir):
    maps = {"line": {1: "first", 2: "second", 3: "third"}}
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").alias("line_index")
    )
    return comparable(decode_with_maps(lines, maps))


def _encode_decode(spark, sf_dir):
    """Encoding and decoding give the labels back."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    codes = build_code_table(part, ["p_brand", "p_type"])
    return comparable(
        decode_labels(encode(part, codes, ["p_brand", "p_type"], keep_labels=False), codes, ["p_brand", "p_type"])
    )


def _published_codes(spark, sf_dir):
    """Order priorities joined to published codes given as a map."""
    codes = codes_from_maps(spark, {"o_orderstatus": {1: "F", 2: "O", 3: "P"}})
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return comparable(encode(orders, codes, ["o_orderstatus"]))


def _regression_metrics(spark, sf_dir):
    model = daily_model(spark, sf_dir)
    return comparable(regression_metrics(model, "ridership", "ridership_lag_1"))


def _time_bounds(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return comparable(
        orders.agg(
            F.max("o_orderdate").alias("latest"),
            F.count(F.lit(1)).alias("n"),
            count_where(F.col("o_totalprice") > 100000, "large"),
        )
    )


def _resume(unit):
    def run(spark, sf_dir):
        return comparable(resume_window(table(spark, sf_dir, "events"), "ts", unit))

    return run


def _concat_by_name(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    old, new = temporal_split(orders, "o_orderdate", SPLIT_AT)
    return comparable(concat_by_name(old.drop("o_orderpriority"), new.drop("o_custkey")).select(*ORDER_COLUMNS))


def _struct_equality(spark, sf_dir):
    """Lines whose (quantity, discount) pair equals its coarser copy, compared as structs."""
    lineitem = table(spark, sf_dir, "lineitem")
    pair = F.struct("l_quantity", "l_discount")
    coarse = F.struct(F.col("l_quantity"), F.round("l_discount", 1).alias("l_discount"))
    equal = lineitem.where(pair == coarse)
    return comparable(equal.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")))


def _run_sql(spark, sf_dir):
    _orders(spark, sf_dir).createOrReplaceTempView("orders_for_sql")
    answer = """Here is the query:
```sql
SELECT o_orderpriority, SUM(CAST(round(o_totalprice) AS BIGINT)) AS total, COUNT(*) AS n
FROM orders_for_sql GROUP BY o_orderpriority;
```
It sums by priority."""
    result = comparable(run_sql(spark, answer))
    # The plan is resolved; the caller's session keeps no view.
    spark.catalog.dropTempView("orders_for_sql")
    return result


_KEYS = ", ".join(DAILY.keys)
_FIRST_MONTH, _LAST_MONTH = "DATE '1994-07-01'", "DATE '2002-12-01'"
_SQL_MONTHS = (
    f"WITH e AS (SELECT CAST(unnest(generate_series({_FIRST_MONTH}, {_LAST_MONTH}, INTERVAL 1 MONTH)) AS DATE) AS m) "
    "SELECT strftime(m, '%m-%Y') AS month_label, strftime(m, '%Y-%m-%d') AS month_start FROM e "
    "WHERE m NOT IN (SELECT date_trunc('month', CAST(o_orderdate AS DATE)) FROM orders)"
)


def _sql_where(condition: str) -> str:
    return f"SELECT {SQL_ORDERS} FROM orders WHERE {condition}"


_SQL_BLANKED = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
    "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders"
)

QUERIES = [
    Query("select_required", _select_required,
          f"SELECT event_id, {sql_time('ts', 'ts')}, event_type, round(value, 6) AS value FROM events"),
    Query("time_range", _on_orders(lambda o: time_range(o, "o_orderdate", "2000-01-01", "2000-03-31")),
          _sql_where("o_orderdate BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2000-03-31'")),
    Query("temporal_split", lambda s, d: comparable(_split_counts(s, d)),
          "SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS side, "
          "o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2"),
    Query("match_date", _on_orders(lambda o: match_date(o, "o_orderdate", "2000-02-29")),
          _sql_where("CAST(o_orderdate AS DATE) = DATE '2000-02-29'")),
    Query("remove_date", _on_orders(lambda o: remove_date(o, "o_orderdate", "2000-02-29")),
          _sql_where("CAST(o_orderdate AS DATE) <> DATE '2000-02-29'")),
    Query("since_high_water", _on_orders(lambda o: since_high_water(o, "o_orderdate", OVERLAP_FROM)),
          _sql_where(f"o_orderdate >= TIMESTAMP '{OVERLAP_FROM}'")),
    Query("equality_filter", _on_orders(lambda o: equality_filter(o, "o_orderpriority", "2-HIGH")),
          _sql_where("o_orderpriority = '2-HIGH'")),
    Query("at_max_day", _at_max(encoded_daily, DAILY, _DAILY_COLUMNS),
          f"WITH s AS ({SQL_DAILY}) SELECT {sql_edge(DAILY, _DAILY_COLUMNS)} FROM s "
          "WHERE transit_date = (SELECT MAX(transit_date) FROM s)"),
    Query("last_k_days", _last_k(encoded_daily, DAILY, _DAILY_COLUMNS),
          f"WITH s AS ({SQL_DAILY}) SELECT {sql_edge(DAILY, _DAILY_COLUMNS)} FROM s "
          "WHERE transit_date >= (SELECT MAX(transit_date) - 29 FROM s)"),
    Query("last_k_hours", _last_k(encoded_hourly, HOURLY, _HOURLY_COLUMNS),
          f"WITH s AS ({SQL_HOURLY}) SELECT {sql_edge(HOURLY, _HOURLY_COLUMNS)} FROM s "
          "WHERE transit_timestamp >= (SELECT MAX(transit_timestamp) - INTERVAL 29 HOUR FROM s)"),
    Query("after_max_of", _after_max,
          _sql_where("o_orderdate > (SELECT MAX(l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-03-01')")),
    Query("cast_to_schema", _cast_to_schema,
          "SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS BIGINT) END AS p_size, "
          "round(p_retailprice, 6) AS p_retailprice FROM part"),
    Query("cast_measures", _cast_measures,
          "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, "
          "CASE WHEN l_linenumber % 5 <> 0 THEN round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE), 6) END AS l_quantity "
          "FROM lineitem"),
    Query("epoch_nanos", _nanos,
          f"SELECT event_id, CAST(epoch_us(ts) * 1000 AS BIGINT) AS nanos, {sql_time('ts', 'ts_text')}, "
          "CAST(year(ts) AS BIGINT) AS year FROM events"),
    Query("parsed_times", _parsed_times,
          f"WITH p AS (SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN date_trunc('second', ts) END AS ts FROM events) "
          f"SELECT event_id, {sql_time('ts', 'ts')}, CAST(epoch(ts) AS BIGINT) AS epoch FROM p"),
    Query("shifted_times", _shifted_times,
          f"SELECT event_id, {sql_time('ts + INTERVAL 1 HOUR', 'next_hour')}, "
          f"{sql_time('ts - INTERVAL 29 HOUR', 'hours_back')}, {sql_date('CAST(ts AS DATE) + 1', 'next_day')}, "
          f"{sql_date('CAST(ts AS DATE) - 29', 'days_back')} FROM events"),
    Query("calendar_parts", _calendar_parts,
          f"SELECT o_orderkey, {sql_time('o_orderdate', 'o_orderdate')}, CAST(year(o_orderdate) AS BIGINT) AS year, "
          "CAST(month(o_orderdate) AS BIGINT) AS month, CAST(weekofyear(o_orderdate) AS BIGINT) AS week_number, "
          f"{sql_date('o_orderdate', 'date')} FROM orders"),
    Query("prediction_casts", _prediction_casts,
          "SELECT c_custkey, CAST(round(c_acctbal - 5000) AS BIGINT) AS rounded, "
          "CAST(trunc(c_acctbal - 5000) AS BIGINT) AS truncated FROM customer"),
    Query("month_ends", _month_ends,
          f"SELECT {sql_date('last_day(o_orderdate)', 'month_end')}, COUNT(*) AS n FROM orders GROUP BY 1"),
    Query("missing_months", _missing_months, _SQL_MONTHS),
    Query("set_difference", _set_difference, _SQL_MONTHS),
    Query("resume_window", _resume("hour"),
          f"WITH t AS (SELECT date_trunc('hour', MAX(ts)) + INTERVAL 1 HOUR AS a, "
          f"CAST(last_day(MAX(ts)) AS TIMESTAMP) + INTERVAL 23 HOUR AS b FROM events) "
          f"SELECT {sql_time('a', 'resume_from')}, {sql_time('b', 'resume_to')} FROM t WHERE a <= b"),
    Query("resume_window_days", _resume("day"),
          f"WITH t AS (SELECT CAST(MAX(ts) AS DATE) + 1 AS a, last_day(MAX(ts)) AS b FROM events) "
          f"SELECT {sql_date('a', 'resume_from')}, {sql_date('b', 'resume_to')} FROM t WHERE a <= b"),
    Query("anti_new_rows", _anti_new_rows,
          _sql_where(f"o_orderdate >= TIMESTAMP '{OVERLAP_FROM}' AND NOT EXISTS (SELECT 1 FROM orders t WHERE "
                     f"t.o_orderdate < TIMESTAMP '{SPLIT_AT}' AND t.o_orderdate = orders.o_orderdate AND "
                     "t.o_custkey = orders.o_custkey AND t.o_orderpriority = orders.o_orderpriority)")),
    Query("merge_insert_only", _merge_insert_only,
          f"WITH o AS ({_SQL_BLANKED}), t AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '{SPLIT_AT}'), "
          f"s AS (SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '{OVERLAP_FROM}'), "
          f"a AS (SELECT * FROM t UNION ALL (SELECT * FROM s EXCEPT SELECT * FROM t)) SELECT {SQL_ORDERS} FROM a"),
    Query("member_of_dim", _member(True),
          "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer "
          "WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"),
    Query("not_member_of_dim", _member(False),
          "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer "
          "WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"),
    Query("code_table", _code_table,
          " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", label, CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS code "
              f"FROM (SELECT DISTINCT {c} AS label FROM part)" for c in ("p_brand", "p_type", "p_name"))),
    Query("code_table_by_range", _code_table_by_range,
          " UNION ALL ".join(
              f"SELECT '{c}' AS \"column\", label, CAST(row_number() OVER (ORDER BY label) AS BIGINT) AS code "
              f"FROM (SELECT DISTINCT {c} AS label FROM customer)" for c in ("c_name", "c_mktsegment"))),
    Query("code_listing", _code_listing,
          "SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS p_brand_index "
          "FROM (SELECT DISTINCT p_brand FROM part)"),
    Query("decode_labels", _decode_labels,
          "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS nation_index, "
          "CASE WHEN n_nationkey < 20 THEN n_name END AS nation "
          "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"),
    Query("decode_with_maps", _decode_with_maps,
          "SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS line_index, "
          "CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' END AS line FROM lineitem"),
    Query("encode_decode", _encode_decode, "SELECT p_partkey, p_brand, p_type FROM part"),
    Query("published_codes", _published_codes,
          "SELECT o_orderkey, o_orderstatus, CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END "
          "AS BIGINT) AS o_orderstatus_index FROM orders"),
    Query("regression_metrics", _regression_metrics,
          f"WITH {sql_model_ctes(SQL_DAILY, DAILY)}, e AS (SELECT CAST(ridership - ridership_lag_1 AS DOUBLE) AS e FROM model) "
          "SELECT round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae FROM e"),
    Query("time_bounds", _time_bounds,
          f"SELECT {sql_time('MAX(o_orderdate)', 'latest')}, COUNT(*) AS n, "
          "COUNT(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders"),
    Query("distinct_keys", lambda s, d: comparable(distinct_keys(_orders(s, d), ["o_orderdate", "o_orderpriority"])),
          f"SELECT DISTINCT {sql_time('o_orderdate', 'o_orderdate')}, o_orderpriority FROM orders"),
    Query("distinct_rows", lambda s, d: comparable(
              distinct_rows(table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_shipdate"))),
          f"SELECT DISTINCT l_returnflag, l_linestatus, round(l_quantity, 6) AS l_quantity, "
          f"{sql_time('l_shipdate', 'l_shipdate')} FROM lineitem"),
    Query("latest_row", lambda s, d: comparable(latest_row(_orders(s, d), "o_orderdate", "o_orderkey")),
          f"SELECT {SQL_ORDERS} FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)"),
    Query("global_sum", lambda s, d: comparable(
              global_sum(encoded_daily(s, d), "ridership", "total")),
          f"SELECT CAST(SUM(ridership) AS BIGINT) AS total FROM ({SQL_DAILY_SERIES})"),
    Query("sample_rows", lambda s, d: comparable(sample_rows(_orders(s, d), "o_orderkey")),
          f"SELECT {SQL_ORDERS} FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)"),
    Query("union_history", lambda s, d: comparable(
              union_all(*temporal_split(_orders(s, d), "o_orderdate", SPLIT_AT)).select(*ORDER_COLUMNS)),
          f"SELECT {SQL_ORDERS} FROM orders"),
    Query("concat_by_name", _concat_by_name,
          f"SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '{SPLIT_AT}' THEN o_custkey END AS o_custkey, "
          f"o_orderstatus, round(o_totalprice, 6) AS o_totalprice, {sql_time('o_orderdate', 'o_orderdate')}, "
          f"CASE WHEN o_orderdate >= TIMESTAMP '{SPLIT_AT}' THEN o_orderpriority END AS o_orderpriority FROM orders"),
    Query("struct_equality", _struct_equality,
          "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem "
          "WHERE {'q': l_quantity, 'd': l_discount} = {'q': l_quantity, 'd': round(l_discount, 1)} GROUP BY 1, 2"),
    Query("run_sql", _run_sql,
          "SELECT o_orderpriority, CAST(SUM(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total, COUNT(*) AS n "
          "FROM orders GROUP BY 1"),
]

"""Landing, tables, merges, curated appends and the stream."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakecast import transit
from lakecast.operators.joins import anti_new_rows, expected_months, missing_months, missing_rows
from lakecast.operators.quality import Rule
from lakecast.plans.landing import backfill_missing, resume_month, resume_window
from lakecast.plans.loading import append_curated, load_silver, load_validated, merge_insert_only
from lakecast.sources.files import (
    append_months,
    bounded_fetch,
    list_files,
    list_months,
    newest_month,
    reference_values,
    scan_months,
    write_months,
)
from lakecast.sources.tables import (
    append_to_current,
    compact,
    latest_in_partitions,
    read_current,
    remove_batches,
    remove_versions,
    replace_self,
    scan_table,
    scan_warehouse,
    table_exists,
    write_partitioned,
    write_quarantine,
    write_warehouse,
)
from lakecast.session import is_small
from lakecast.streaming.incremental import run_incremental_stream


def facts(spark, rows):
    return spark.createDataFrame(rows, "ts string, k string, y double").withColumn("ts", F.to_timestamp("ts"))


def test_new_rows_by_key(spark):
    target = spark.createDataFrame([(1, "x")], "a int, b string")
    source = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (None, "z")], "a int, b string")
    for null_safe in (False, True):
        assert anti_new_rows(source, target, ["a", "b"], null_safe).count() == 3
    after = target.union(source)
    assert anti_new_rows(source, after, ["a", "b"], null_safe=True).count() == 0
    assert anti_new_rows(source, after, ["a", "b"], null_safe=False).count() == 2


def test_merge_compares_nested_and_null_columns(spark):
    ddl = "k string, geo struct<coordinates: array<double>, type: string>"
    rows = [("a", ([1.0, None], "Point")), ("a", ([1.0, 2.0], "Point")), (None, None), (None, None)]
    source = spark.createDataFrame(rows, ddl)
    assert missing_rows(source, source, source.columns).count() == 0
    empty = source.limit(0)
    assert missing_rows(source, empty, source.columns).count() == 4
    assert missing_rows(source, empty, source.columns, dedupe=True).count() == 3
    assert missing_rows(source, source.limit(1), source.columns).count() == 3


def test_hot_key_of_an_anti_join_is_split(spark):
    """A third of the source has one key; adaptive execution splits it over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        source = spark.range(0, 300000, 1, 8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        target = spark.range(0, 300000, 5, 8).select((F.col("id") + 11).alias("k"))
        new = anti_new_rows(source, target, ["k"])
        rows = new.collect()
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "isSkew=true" in plan or "skew=true" in plan
        known = set(range(11, 300011, 5))
        expected = sum((7 if i % 3 == 0 else i) not in known for i in range(300000))
        assert len(rows) == expected
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_missing_and_newest_months(spark, tmp_path):
    root = str(tmp_path / "lake")
    assert list_months(spark, root).count() == 0
    df = facts(spark, [(f"{y}-{m:02d}-05 00:00:00", "a", 1.0) for y, m in ((2020, 11), (2020, 12), (2021, 1))])
    assert write_months(df, "ts", root)
    assert not write_months(df.limit(0), "ts", root)
    months = list_months(spark, root)
    missing = missing_months(expected_months(spark, "10/2020", "02/2021"), months)
    assert sorted(r["month_label"] for r in missing.collect()) == ["02-2021", "10-2020"]
    assert newest_month(months).first()[0] == dt.date(2021, 1, 1)


def test_months_are_replaced_or_appended(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_months(facts(spark, [("2024-01-01 00:00:00", "a", 1.0), ("2024-02-01 00:00:00", "a", 1.0)]), "ts", root)
    write_months(facts(spark, [("2024-02-09 00:00:00", "b", 2.0)]), "ts", root)
    append_months(
        facts(spark, [("2024-02-10 00:00:00", "c", 3.0), ("2024-03-01 00:00:00", "c", 4.0)]).withColumn("extra", F.lit(1)),
        "ts", root,
    )
    rows = {(r["month"], r["k"], r["y"], r["extra"]) for r in scan_months(spark, root).collect()}
    assert rows == {(1, "a", 1.0, None), (2, "b", 2.0, None), (2, "c", 3.0, 1), (3, "c", 4.0, 1)}
    assert all(r[0].endswith(".parquet") for r in list_files(spark.read.parquet(root)).collect())


def test_backfill_reports_errors_by_month(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = facts(spark, [("2024-01-05 00:00:00", "1", 1.0), ("2024-02-05 00:00:00", "x", 1.0), ("2024-03-05 00:00:00", "3", 1.0)])
    report = backfill_missing(good.withColumn("k", F.col("k").cast("int")), "ts", root, "01/2024", "04/2024")
    assert report.missing == ["01-2024", "02-2024", "03-2024", "04-2024"]
    assert set(report.errors) == {"02-2024"}
    assert sorted(r["month_label"] for r in list_months(spark, root).collect()) == ["01-2024", "03-2024"]
    again = backfill_missing(good, "ts", root, "01/2024", "03/2024")
    assert again.missing == ["02-2024"] and not again.errors


def test_resume_starts_at_the_next_hour(spark):
    def window(at):
        return [tuple(map(str, r)) for r in resume_window(facts(spark, [(at, "a", 1.0)]), "ts").collect()]

    assert window("2024-02-10 13:00:00") == [("2024-02-10 14:00:00", "2024-02-29 23:00:00")]
    assert window("2024-02-29 23:00:00") == []


def test_resume_appends_the_rest_of_the_month(spark, tmp_path):
    root = str(tmp_path / "lake")
    hours = [("2024-02-10 13:00:00", "a", 1.0), ("2024-02-10 14:00:00", "a", 2.0),
             ("2024-02-29 23:30:00", "a", 3.0), ("2024-03-01 00:00:00", "a", 4.0)]
    source = facts(spark, hours)
    assert resume_month(source, "ts", root) is None
    write_months(source.limit(1), "ts", root)
    resume_month(source, "ts", root)
    assert sorted(r["y"] for r in scan_months(spark, root).collect()) == [1.0, 2.0, 3.0]
    resume_month(source, "ts", root)
    assert scan_months(spark, root).count() == 3


def test_fetch_bounds_are_whole_days(spark):
    df = facts(spark, [("2024-01-01 00:00:00", "a", 1.0), ("2024-01-02 23:59:59.9", "a", 2.0), ("2024-01-03 00:00:00", "a", 3.0)])
    assert {r["y"] for r in bounded_fetch(df, "ts", "01/01/2024", "01/02/2024").collect()} == {1.0, 2.0}
    assert bounded_fetch(df, "ts", "01/01/2024", "01/03/2024", limit=2).count() == 2


def test_table_exists_only_says_no_when_there_is_none(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    spark.range(3).write.parquet(path)
    assert table_exists(spark, path)
    assert not table_exists(spark, path, fmt="delta")
    with pytest.raises(Exception, match="scheme|FileSystem"):
        table_exists(spark, "nosuchscheme://x/y")


def test_table_replaced_by_itself(spark, tmp_path):
    root = str(tmp_path / "history")
    replace_self(spark.range(3), root)
    replace_self(read_current(spark, root).union(spark.range(3, 5)), root)
    assert sorted(r[0] for r in read_current(spark, root).collect()) == [0, 1, 2, 3, 4]


def test_a_failed_pointer_leaves_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "history")
    replace_self(spark.range(3), root)

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr("lakecast.sources.tables._rename_over", fail)
    with pytest.raises(OSError, match="lost"):
        replace_self(spark.range(9), root)
    assert read_current(spark, root).count() == 3


def test_nested_values_count_when_a_side_is_measured(spark):
    small = spark.range(10).selectExpr("array(id) as a", "map('k', struct(id)) as m")
    assert is_small(small) and is_small(small, max_bytes=1200) and not is_small(small, max_bytes=100)
    large = spark.range(10).selectExpr("array(repeat('x', 100000)) as a")
    assert not is_small(large, max_bytes=900_000) and is_small(large, max_bytes=1_100_000)


def test_warehouse_table(spark):
    write_warehouse(spark.range(3), "lakecast_test_table", "overwrite")
    write_warehouse(spark.range(2), "lakecast_test_table", "append")
    assert scan_warehouse(spark, "lakecast_test_table").count() == 5
    with pytest.raises(ValueError, match="overwrite"):
        write_warehouse(spark.range(1), "lakecast_test_table", "ignore")


RULES = [Rule.exists("k"), Rule.between("y", 0, 100)]


def load(df, tmp_path, **options):
    paths = [str(tmp_path / name) for name in ("table", "good", "bad")]
    return load_validated(df, paths[0], RULES, "ts", paths[1], paths[2], **options)


def test_validated_load_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "table")
    first = facts(spark, [("2023-12-31 23:00:00", "a", 1.0), ("2024-01-01 00:00:00", None, 2.0)])
    assert load(first, tmp_path).status == "loaded"
    second = first.union(facts(spark, [("2024-01-01 00:00:00", "b", 3.0), ("2024-01-02 00:00:00", "b", 4.0)]))
    for _ in range(2):
        assert load(second, tmp_path).status == "merged"
        assert scan_table(spark, path).count() == 4
    assert latest_in_partitions(spark, path, "ts") == dt.datetime(2024, 1, 2)
    late = facts(spark, [("2020-01-01 00:00:00", "a", 1.0), (None, "a", 7.0)])
    assert load(late, tmp_path, since_latest=True).status == "up_to_date"
    for _ in range(2):
        assert load(late, tmp_path).status == "merged"
        assert scan_table(spark, path).count() == 6
    assert scan_table(spark, path).where("ts is null").first()["y"] == 7.0


def test_quarantine_of_a_batch_loaded_again_stays_as_it_was(spark, tmp_path):
    load(facts(spark, [("2024-01-01 00:00:00", "a", 1.0)]), tmp_path)
    mixed = facts(spark, [("2024-01-02 00:00:00", "a", 1.0), (None, "b", 999.0), ("2023-01-02 00:00:00", "c", 999.0)])
    for batch in (mixed, mixed.orderBy("k"), mixed):
        assert load(batch, tmp_path).status == "quarantined"
    bad = scan_table(spark, str(tmp_path / "bad"))
    assert sorted(r["k"] for r in bad.collect()) == ["b", "c"]
    assert scan_table(spark, str(tmp_path / "good")).count() == 1
    load(mixed.limit(2), tmp_path)
    assert scan_table(spark, str(tmp_path / "bad")).count() == 3


def test_loads_take_a_format(spark, tmp_path):
    first = facts(spark, [("2024-01-01 00:00:00", "a", 1.0)])
    second = first.union(facts(spark, [("2020-01-01 00:00:00", "b", 2.0)]))
    for batch in (first, second, second):
        load(batch, tmp_path, fmt="orc")
    assert scan_table(spark, str(tmp_path / "table"), "orc").count() == 2
    paths = [str(tmp_path / name) for name in ("gold", "increment")]
    assert [append_curated(b, *paths, ["ts", "k"], fmt="orc") for b in (first, second, second)] == [1, 1, 0]


def test_failed_batch_stays_out(spark, tmp_path):
    path = str(tmp_path / "table")
    load(facts(spark, [("2024-01-01 00:00:00", "a", 1.0)]), tmp_path)
    mixed = facts(spark, [("2024-01-02 00:00:00", "a", 1.0), ("2024-01-02 00:00:00", "b", 999.0)])
    report = load(mixed, tmp_path)
    assert report.status == "quarantined"
    assert {r["column"]: r["success"] for r in report.summary.collect()} == {"k": True, "y": False}
    assert scan_table(spark, path).count() == 1
    assert scan_table(spark, str(tmp_path / "good")).count() == 1
    assert scan_table(spark, str(tmp_path / "bad")).count() == 1
    assert load(mixed, tmp_path, on_fail="split").status == "split"
    assert scan_table(spark, path).count() == 2
    with pytest.raises(ValueError, match="missing: k"):
        load(mixed.drop("k"), tmp_path)


def test_merge_reads_only_touched_years(spark, tmp_path):
    path = str(tmp_path / "table")
    old = facts(spark, [("2023-05-01 00:00:00", "a", 1.0), ("2024-05-01 00:00:00", "a", 1.0)])
    write_partitioned(old.withColumn("year", F.year("ts")), path)
    batch = facts(spark, [("2024-05-01 00:00:00", "a", 1.0), ("2024-06-01 00:00:00", "a", 1.0)] * 2)
    merge_insert_only(batch.withColumn("year", F.year("ts")), path, "ts", dedupe=True)
    assert scan_table(spark, path).count() == 3


def test_curated_append_and_snapshot(spark, tmp_path):
    path, increment = str(tmp_path / "gold"), str(tmp_path / "increment")
    old = facts(spark, [("2024-01-01 00:00:00", "a", 1.0)])
    new = old.union(facts(spark, [("2024-01-02 00:00:00", "a", 2.0), ("2024-01-03 00:00:00", None, 3.0)]))
    assert append_curated(old, path, increment, ["ts", "k"]) == 1
    assert append_curated(new, path, increment, ["ts", "k"]) == 2
    assert append_curated(new, path, increment, ["ts", "k"]) == 0
    assert scan_table(spark, path).count() == 3
    assert sorted(r["y"] for r in scan_table(spark, increment).collect()) == [2.0, 3.0]


def test_stream_equals_batch(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "table")
    days = [facts(spark, [(f"2024-01-{d:02d} 00:00:00", "a", float(d))]) for d in range(1, 6)]
    schema = days[0].schema

    def run():
        return run_incremental_stream(
            spark, landing, schema, lambda b: load(b, tmp_path), str(tmp_path / "state"), files_per_batch=1
        )

    for df in days[:3]:
        df.coalesce(1).write.mode("append").parquet(landing)
    assert run() == 3
    for df in days[2:]:
        df.coalesce(1).write.mode("append").parquet(landing)
    assert run() == 3
    assert sorted(r["y"] for r in scan_table(spark, path).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]


def raw_parquet(path, hours, ridership, drop=()):
    n = len(hours)
    columns = {
        "transit_timestamp": pa.array([int(h.timestamp() * 1e9) for h in hours], pa.int64()).cast(pa.timestamp("ns")),
        "transit_mode": ["subway"] * n,
        "station_complex_id": ["1"] * n,
        "station_complex": ["A St (1,2)"] * n,
        "borough": ["Queens"] * n,
        "payment_method": ["omny"] * n,
        "fare_class_category": ["OMNY - Full Fare"] * n,
        "ridership": ridership,
        "transfers": ["0.0"] * n,
        "latitude": ["40.7"] * n,
        "longitude": ["-73.9"] * n,
        "georeference": [{"coordinates": [-73.9, 40.7], "type": "Point"}] * n,
    }
    pq.write_table(pa.table({k: v for k, v in columns.items() if k not in drop}), path)


def test_raw_files_to_validated_table(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    csv = tmp_path / "stations.csv"
    csv.write_text('station_complex_id,station_complex\n1,"A St (1,2)"\n')
    stations = reference_values(spark, str(csv), ["station_complex_id", "station_complex"])
    hours = [dt.datetime(2024, 12, 31, h, tzinfo=dt.UTC) for h in (22, 23)]

    def run():
        return load_silver(
            spark, str(source), transit.RAW_SCHEMA, str(tmp_path / "silver"), transit.rules(stations),
            "transit_timestamp", ["ridership", "transfers", "latitude", "longitude"],
            str(tmp_path / "good"), str(tmp_path / "bad"),
        )

    raw_parquet(source / "12-2024.parquet", hours, ["5.0", "7.0"])
    assert run().status == "loaded"
    silver = scan_table(spark, str(tmp_path / "silver"))
    assert sorted((str(r["transit_timestamp"]), r["ridership"], r["year"]) for r in silver.collect()) == [
        ("2024-12-31 22:00:00", 5.0, 2024), ("2024-12-31 23:00:00", 7.0, 2024)
    ]
    raw_parquet(source / "01-2025.parquet", [dt.datetime(2025, 1, 1, tzinfo=dt.UTC)], ["3.0"])
    assert run().status == "merged"
    assert run().status == "merged"
    assert scan_table(spark, str(tmp_path / "silver")).count() == 3
    raw_parquet(source / "02-2025.parquet", [dt.datetime(2025, 2, 1, tzinfo=dt.UTC)], ["not a number"])
    # A null from a bad cast does not fail the suite, and the row is merged as a null.
    assert run().status == "merged"
    raw_parquet(source / "03-2025.parquet", [dt.datetime(2025, 3, 1, tzinfo=dt.UTC)], ["0"])
    assert run().status == "quarantined"


def test_missing_file_column_is_noticed(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    raw_parquet(source / "x.parquet", [dt.datetime(2024, 1, 1, tzinfo=dt.UTC)], ["1"], drop=("borough",))
    stations = spark.createDataFrame([("1", "A")], "station_complex_id string, station_complex string")
    with pytest.raises(ValueError, match="borough"):
        load_silver(
            spark, str(source), transit.RAW_SCHEMA, str(tmp_path / "silver"), transit.rules(stations),
            "transit_timestamp", ["ridership"], str(tmp_path / "good"), str(tmp_path / "bad"),
        )


def _versioned(spark, root, batches=3):
    """Months 1 and 2 in every batch, month 3 in the first alone."""
    for batch in range(batches):
        months = 3 if batch == 0 else 2
        rows = spark.range(batch * 100, batch * 100 + 30 * months).withColumn("month", (F.col("id") % months + 1).cast("int"))
        append_to_current(rows, root, ["month"])


def test_compaction_rewrites_crowded_partitions_only(spark, tmp_path):
    root = str(tmp_path / "lake")
    _versioned(spark, root)
    before = read_current(spark, root)
    rows, files = sorted(before.collect()), set(before.inputFiles())
    assert compact(spark, root) == ["month=1", "month=2"]
    after = read_current(spark, root)
    assert sorted(after.select(*before.columns).collect()) == rows
    assert len(after.inputFiles()) == 3 < len(files)
    kept = {f for f in after.inputFiles() if "month=3" in f}
    assert kept and kept <= files
    # A reader of the state before still has its files; nothing is left to merge.
    assert sorted(before.collect()) == rows
    assert compact(spark, root) == []


def test_old_states_are_removed_after_a_stated_number(spark, tmp_path):
    root = str(tmp_path / "lake")
    _versioned(spark, root)
    before = read_current(spark, root)
    rows = sorted(before.collect())
    compact(spark, root)
    assert remove_versions(spark, root, keep=2) == 0
    assert sorted(before.collect()) == rows
    # Of the first batch, month 3 is still the table's; its other months go, and so do the other batches.
    assert remove_versions(spark, root, keep=1) == 4
    assert sorted(read_current(spark, root).select(*before.columns).collect()) == rows
    with pytest.raises(ValueError):
        remove_versions(spark, root, keep=0)
    for n in (1, 2, 3):
        replace_self(spark.range(n), root, keep=2)
    assert len(list((tmp_path / "lake").glob("version=*"))) == 2
    assert read_current(spark, root).count() == 3


def test_unpartitioned_tables_are_compacted_too(spark, tmp_path):
    root = str(tmp_path / "plain")
    for n in range(3):
        append_to_current(spark.range(n * 10, n * 10 + 10), root)
    assert compact(spark, root) == [""]
    assert sorted(r.id for r in read_current(spark, root).collect()) == list(range(30))
    assert len(read_current(spark, root).inputFiles()) == 1
    with pytest.raises(ValueError):
        replace_self(spark.range(1).withColumn("Version", F.lit(1)), root)


def test_quarantine_keeps_the_newest_batches(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for n in range(3):
        write_quarantine(spark.range(n), spark.range(n + 1), good, bad, f"b{n}")
    assert remove_batches(spark, bad, 2) == 1
    assert {p.name for p in (tmp_path / "bad").glob("batch=*")} == {"batch=b1", "batch=b2"}
    assert remove_batches(spark, str(tmp_path / "none"), 2) == 0

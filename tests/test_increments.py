"""One-scan gate, footers, keyed appends by month, partial groups and feature rows that follow an increment."""

import datetime as dt
import random
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lakecast import jobs
from lakecast.operators.quality import Rule, judge
from lakecast.plans.curating import MONTH, append_months_by_key
from lakecast.plans.features import model_table
from lakecast.plans.increments import add_partial_groups, merged_groups, update_model_table
from lakecast.plans.loading import load_validated
from lakecast.plans.staging import FILE, stage, with_file
from lakecast.queries import increments, loads
from lakecast.series import SeriesSpec
from lakecast.sources import footers
from lakecast.sources.files import common_columns, scan_parquet
from lakecast.sources.tables import create_or_replace_as, scan_table
from lakecast.streaming.incremental import run_incremental_stream

DDL = "ts timestamp, k string, y double"
RULES = [Rule.exists("k"), Rule.between("y", 0, 100), Rule.in_set("k", ("a", "b", "c"))]


def facts(spark, rows):
    return spark.createDataFrame([(dt.datetime.fromisoformat(t) if t else None, k, y) for t, k, y in rows], DDL)


# --- one scan ------------------------------------------------------------------------------


def counted(spark, df):
    """The rows, and how many of them tasks have read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), read


@pytest.mark.parametrize("on_fail", ["quarantine_batch", "split"])
def test_a_batch_is_scanned_once(spark, tmp_path, on_fail):
    paths = [str(tmp_path / name) for name in ("table", "good", "bad")]
    clean = [(f"2024-0{m}-01 00:00:00", "a", float(m)) for m in range(1, 7)]
    failing = [*clean[3:], ("2025-01-01 00:00:00", "z", 5.0), (None, "b", 500.0), ("2025-01-02 00:00:00", None, 1.0)]
    dim = create_or_replace_as(spark.createDataFrame([("a",), ("b",)], "name string"), str(tmp_path / "dim"))
    rules = [*RULES, Rule.in_table("k", dim, "name")]
    for rows, status in ((clean, "loaded"), (clean + clean, "merged"), (failing, "quarantined" if on_fail == "quarantine_batch" else "split")):
        batch, read = counted(spark, facts(spark, rows))
        report = load_validated(batch, paths[0], rules, "ts", *paths[1:], on_fail=on_fail)
        assert report.status == status and read.value == len(rows)
        assert [tuple(r) for r in report.summary.orderBy("rule").collect()] == [
            tuple(r) for r in judge(facts(spark, rows), rules)[0].orderBy("rule").collect()
        ]
    assert scan_table(spark, paths[0]).count() == 6
    assert scan_table(spark, paths[2]).count() == 3
    # Nothing is left of the staging folders.
    assert not [p.name for p in tmp_path.iterdir() if "staged" in p.name]


def test_a_load_that_dies_leaves_table_and_staging_as_they_were(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / name) for name in ("table", "good", "bad")]
    monkeypatch.setattr("lakecast.plans.loading.publish_folder", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    batch = facts(spark, [("2024-01-01 00:00:00", "a", 1.0)])
    with pytest.raises(OSError, match="lost"):
        load_validated(batch, paths[0], RULES, "ts", *paths[1:])
    assert not list(tmp_path.iterdir())
    monkeypatch.undo()
    assert load_validated(batch, paths[0], RULES, "ts", *paths[1:]).status == "loaded"


def test_staged_measures(spark, tmp_path):
    rows = facts(spark, [("2024-01-01 00:00:00", "a", 1.0), (None, "b", -1.0), ("2023-01-01 00:00:00", None, None)])
    named = rows.withColumn("m", F.create_map(F.lit("x"), F.col("y"))).withColumn("year", F.year("ts"))
    one, two = (stage(df, RULES, str(tmp_path / "t"), "ts", "year") for df in (named, named.orderBy("y")))
    assert one.count == 3 and one.name == two.name and one.measures["first"] == "2023-01-01 00:00:00"
    assert sorted(one.measures["parts"]) == [2023, 2024] and one.files == []
    assert sorted(map(str, one.rows.collect())) == sorted(map(str, named.collect()))
    other = stage(named.withColumn("y", F.col("y") + 1), RULES, str(tmp_path / "t"), "ts", "year")
    assert other.name != one.name
    empty = stage(named.limit(0), RULES, str(tmp_path / "t"), "ts", "year")
    assert empty.count == 0 and empty.rows.count() == 0


def writers(folder):
    """Numbers of the tasks that wrote the files below a folder."""
    return {p.name.split("-")[1] for p in folder.rglob("part-*.parquet")}


def test_the_rows_of_one_file_are_written_by_several_tasks(spark, tmp_path):
    paths = [str(tmp_path / name) for name in ("table", "good", "bad")]
    rows = [(f"{1990 + i % 12}-01-01 00:00:00", "a", float(i % 50)) for i in range(600)]
    later = [(f"{1990 + i % 12}-02-01 00:00:00", "a", float(i % 50)) for i in range(600)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        staged = stage(facts(spark, rows).coalesce(1).withColumn("year", F.year("ts")), RULES, str(tmp_path / "t"), "ts", "year")
        assert staged.count == 600 and len(staged.measures["parts"]) == 12 and staged.rows.count() == 600
        assert len(writers(tmp_path)) > 1
        staged.discard()
        # A first load, a merge, and one of good rows only.
        assert load_validated(facts(spark, rows).coalesce(1), paths[0], RULES, "ts", *paths[1:]).status == "loaded"
        assert load_validated(facts(spark, rows + later).coalesce(1), paths[0], RULES, "ts", *paths[1:]).status == "merged"
        assert scan_table(spark, paths[0]).count() == 1200
        mixed = facts(spark, [*rows, ("1999-01-01 00:00:00", "z", 1.0)]).coalesce(1)
        other = tmp_path / "other"
        assert load_validated(mixed, str(other), RULES, "ts", *paths[1:], on_fail="split").status == "split"
        assert scan_table(spark, str(other)).count() == 600 and len(writers(other)) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_two_arrivals_are_two_batches_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "FILE_ROWS", 10, raising=False)
    monkeypatch.setattr(loads, "scratch_path", lambda _, name: str(tmp_path / name))
    batches = []
    load = loads.load_validated
    monkeypatch.setattr(loads, "load_validated", lambda batch, *a: batches.append(batch.count()) or load(batch, *a))
    rows = [(i, i, "O", 1.0, dt.datetime(1998 + i % 6, 1, 2), "5-LOW") for i in range(120)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    orders = create_or_replace_as(spark.createDataFrame(rows, names).coalesce(1), str(tmp_path / "orders.parquet"))
    found = loads._stream_two_batches(spark, str(tmp_path))
    newer = orders.where(F.col("o_orderdate") >= F.lit(loads.SPLIT_AT).cast("timestamp")).count()
    assert found.count() == 120 and batches == [newer, 120 - newer] and 0 < newer < 120
    landed = [r["count"] for r in with_file(scan_table(spark, str(tmp_path / "landing"))).groupBy(FILE).count().collect()]
    assert sum(landed) == 120 and max(landed) == 10


# --- footers -------------------------------------------------------------------------------


def jobs_of(spark, run):
    """What ``run`` returns, and the number of Spark jobs it started."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_thousand_footers_in_one_job(spark, tmp_path):
    table = pa.table({"a": [1], "b": ["x"], "c c": [2.0]})
    for i in range(1000):
        pq.write_table(table if i % 100 else table.drop(["b"]), tmp_path / f"part {i}.parquet")
    files = [p.as_uri() for p in tmp_path.iterdir()]
    gaps, started = jobs_of(spark, lambda: footers.columns_missing_in(spark, files, ["a", "b", "c c", "year"]))
    # One query: adaptive execution shows its three stages (deal out, read, add up) as jobs of their own.
    assert gaps == {"b": 10, "year": 1000} and started <= 3
    assert sorted(common_columns(spark, str(tmp_path))) == ["a", "c c"]
    assert footers.columns_missing_in(spark, [], ["a"]) == {}


def test_footers_of_a_store_that_arrow_cannot_open(spark, tmp_path, monkeypatch):
    pq.write_table(pa.table({"a": [1]}), tmp_path / "x.parquet")
    name = (tmp_path / "x.parquet").as_uri()
    assert footers.footer_columns("nosuchscheme://x/y.parquet") is None
    assert footers._columns_by_hadoop(spark, [name]) == [{"a"}]
    closed = footers.file_columns_of(spark, [name]).withColumn("columns", F.lit(None).cast("array<string>"))
    monkeypatch.setattr(footers, "file_columns_of", lambda *a: closed)
    assert footers.columns_missing_in(spark, [name], ["a", "b"]) == {"b": 1}


def test_only_the_new_files_are_asked_for_their_columns(spark, tmp_path, monkeypatch):
    landing, paths = tmp_path / "landing", [str(tmp_path / name) for name in ("table", "good", "bad")]
    asked = []
    whole = footers.file_columns_of
    monkeypatch.setattr(footers, "file_columns_of", lambda s, files: asked.append(len(files)) or whole(s, files))

    def arrive(rows, drop=()):
        facts(spark, rows).drop(*drop).coalesce(1).write.mode("append").parquet(str(landing))

    def run():
        schema = facts(spark, []).schema
        return run_incremental_stream(
            spark, str(landing), schema, lambda b: load_validated(b, paths[0], RULES, "ts", *paths[1:]), str(tmp_path / "state"), name_files=True
        )

    for day in range(1, 4):
        arrive([(f"2024-01-0{day} 00:00:00", "a", 1.0)])
        assert run() == 1
    assert asked == [1, 1, 1] and scan_table(spark, paths[0]).columns == ["ts", "k", "y", "year"]
    arrive([("2024-01-05 00:00:00", "a", 1.0)], drop=["k"])
    with pytest.raises(Exception, match="missing: k"):
        run()
    assert scan_table(spark, paths[0]).count() == 3


def test_a_given_schema_reads_no_footer_ahead(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    wider = scan_parquet(spark, path, spark.range(1).withColumn("x", F.lit("")).schema)
    assert wider.where("x is null").count() == 3
    plan, started = jobs_of(spark, lambda: scan_parquet(spark, path, spark.range(1).schema))
    assert started == 0 and plan.columns == ["id"]


# --- keyed appends by month ---------------------------------------------------------------


def test_untouched_months_are_not_read(spark, tmp_path):
    path, increment = str(tmp_path / "gold"), str(tmp_path / "increment")
    old = [(f"2024-{m:02d}-01 0{h}:00:00", k, 1.0) for m in range(1, 7) for h in range(3) for k in "ab"]
    assert append_months_by_key(facts(spark, old), path, increment, ["ts", "k"], "ts") == len(old)
    # Files of untouched months are made unreadable.
    for file in [f for m in (1, 2, 4, 5) for f in (tmp_path / "gold" / f"{MONTH}=2024-{m:02d}").glob("*.parquet")]:
        file.write_bytes(b"not a table")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    more = [("2024-03-01 00:00:00", "a", 2.0), ("2024-03-05 00:00:00", "a", 3.0), ("2024-06-01 00:00:00", "c", 4.0), (None, "a", 5.0), (None, None, 6.0)]
    assert append_months_by_key(facts(spark, more), path, increment, ["ts", "k"], "ts") == 4
    assert sorted(r["y"] for r in scan_table(spark, increment).collect()) == [3.0, 4.0, 5.0, 6.0]
    assert append_months_by_key(facts(spark, more), path, increment, ["ts", "k"], "ts") == 0
    assert scan_table(spark, increment).count() == 0
    with pytest.raises(ValueError, match="one of the keys"):
        append_months_by_key(facts(spark, more), path, increment, ["k"], "ts")


def test_curated_files_have_bloom_filters_on_their_keys(spark, tmp_path):
    path = str(tmp_path / "gold")
    append_months_by_key(facts(spark, [("2024-01-01 00:00:00", "a", 1.0)]), path, str(tmp_path / "i"), ["ts", "k"], "ts")
    (file,) = (tmp_path / "gold" / f"{MONTH}=2024-01").glob("*.parquet")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(str(file)), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    with_filter = {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0}
    reader.close()
    assert with_filter == {"k"}


# --- partial groups and features -----------------------------------------------------------

SPEC = SeriesSpec(time="day", keys=("key",), value="n", carried=(), n_lags=4, windows=(("2d", 2), ("3d", 3)))


def test_partial_groups_of_files(spark, tmp_path):
    root = str(tmp_path / "groups")

    def land(name, rows):
        return with_file(create_or_replace_as(facts(spark, rows).coalesce(1), str(tmp_path / name)))

    def add(df):
        return sorted(map(tuple, add_partial_groups(df, root, F.to_date("ts"), "day", ["k"], {"n": "y"}).collect()))

    def groups():
        return {(str(r.day), r.k): r.n for r in merged_groups(spark, root, "day", ["k"], ["n"]).collect()}

    one = [("2024-01-01 01:00:00", "a", 1.6), ("2024-01-01 02:00:00", "a", 1.6), ("2024-02-01 00:00:00", None, 1.0)]
    add(land("one", one))
    assert groups() == {("2024-01-01", "a"): 4, ("2024-02-01", None): 1}
    touched = add(land("late", [("2024-01-01 05:00:00", "a", 3.0)]))
    assert touched == [(dt.date(2024, 1, 1), "a")]
    expected = {("2024-01-01", "a"): 7, ("2024-02-01", None): 1}
    assert groups() == expected
    # The same file again, under its own name and another, and twice in a batch.
    for df in (land("one", one), land("two", one), with_file(spark.read.parquet(str(tmp_path / "one"), str(tmp_path / "two")))):
        add(df)
    assert groups() == expected
    add(land("empty", []))
    assert groups() == expected


def lineitem(spark, folder):
    """4,000 rows of one order, each day from 1998 on; copies of rows as well."""
    row = F.col("id") % 3900
    df = spark.range(4000).select(
        F.lit(41).alias("l_orderkey"), row.cast("int").alias("l_linenumber"), (row % 50).cast("double").alias("l_quantity"),
        row.cast("double").alias("l_extendedprice"), F.lit("A").alias("l_returnflag"), F.when(row % 2 == 0, "F").alias("l_linestatus"),
        F.date_add(F.lit("1998-01-01").cast("date"), (row % 400).cast("int")).cast("timestamp").alias("l_shipdate"),
    )
    return create_or_replace_as(df, f"{folder}/lineitem.parquet")


def test_landed_files_grow_in_number_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(increments, "FILE_ROWS", 500, raising=False)
    lineitem(spark, tmp_path)
    one, two = (increments._landed(spark, str(tmp_path), increments._OLD) for _ in range(2))
    sizes = [r["count"] for r in one.groupBy(FILE).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 8 and max(sizes) < 750
    contents = [
        sorted(map(tuple, df.groupBy(FILE).agg(F.count("*"), F.sum("l_linenumber"), F.min("l_linenumber")).drop(FILE).collect())) for df in (one, two)
    ]
    assert contents[0] == contents[1]
    # Few rows, and none: two files at most, as before.
    monkeypatch.undo()
    assert increments._landed(spark, str(tmp_path), increments._OLD).select(FILE).distinct().count() == 2
    assert increments._landed(spark, str(tmp_path), increments._LATE).count() == 0


def test_groups_of_many_landed_files(spark, tmp_path, monkeypatch):
    """Old files that come three times count once each, however many there are."""
    monkeypatch.setattr(increments, "FILE_ROWS", 500, raising=False)
    monkeypatch.setattr(increments, "scratch_path", lambda _, name: str(tmp_path / f"{name}-{uuid.uuid4().hex}"))
    rows = lineitem(spark, tmp_path)
    found = increments._group_daily_increment(spark, str(tmp_path))
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("transit_date")
    sums = [F.sum(c).cast("bigint").alias(n) for n, c in increments.SUMS.items()]
    whole = rows.groupBy(day, *increments.DAILY_LABELS).agg(*sums)
    assert found.count() == 400 and found.exceptAll(whole).count() == whole.exceptAll(found).count() == 0
    (listed,) = tmp_path.glob("groups-*/files")
    assert spark.read.parquet(str(listed)).count() == 8


def test_sums_of_a_load_that_died_do_not_count(spark, tmp_path):
    root = str(tmp_path / "groups")
    df = with_file(create_or_replace_as(facts(spark, [("2024-01-01 01:00:00", "a", 2.0)]), str(tmp_path / "one")))
    add_partial_groups(df, root, F.to_date("ts"), "day", ["k"], {"n": "y"})
    # Sums that were written without their files being listed.
    sums = spark.read.parquet(f"{root}/sums")
    sums.withColumn("load_id", F.lit("died")).write.mode("append").partitionBy(MONTH).parquet(f"{root}/sums")
    assert [r.n for r in merged_groups(spark, root, "day", ["k"], ["n"]).collect()] == [2]


def test_model_rows_follow_the_series(spark, tmp_path):
    rng, path = random.Random(3), str(tmp_path / "model")
    start = dt.date(2023, 11, 1)
    every = [(start + dt.timedelta(days=d), key, rng.randrange(100)) for key in (1, 2, 3, None) for d in range(150) if rng.random() < 0.8]
    late = [r for r in every if rng.random() < 0.02] + [r for r in every if r[1] == 3 and r[0] < dt.date(2023, 12, 1)]
    newest = [r for r in every if r[0] >= dt.date(2024, 3, 20) and r not in late]
    now: list = []

    def step(rows, expect_few=False):
        now.extend(r for r in rows if r not in now)
        series = create_or_replace_as(spark.createDataFrame(now, "day date, key int, n long"), str(tmp_path / f"series-{len(now)}"))
        changed = spark.createDataFrame([r[:2] for r in rows], "day date, key int")
        computed = update_model_table(series, changed, path, SPEC)
        whole = model_table(series, SPEC)
        found = spark.read.parquet(path).select(*whole.columns)
        assert found.exceptAll(whole).count() == whole.exceptAll(found).count() == 0
        assert not expect_few or computed < whole.count() / 5
        return computed

    step([r for r in every if r not in late and r not in newest])
    untouched = sorted((tmp_path / "model" / f"{MONTH}=2023-12").glob("*.parquet"))
    step(newest, expect_few=True)
    assert untouched == sorted((tmp_path / "model" / f"{MONTH}=2023-12").glob("*.parquet"))
    step(late)
    again = step(late)
    assert again > 0 and step([]) == 0
    # A null value: rows without full lags drop out between others.
    now[:] = [(d, k, None if i % 37 == 0 else n) for i, (d, k, n) in enumerate(now)]
    step(list(now))
    step([(dt.date(2024, 3, 31), 1, 5), (dt.date(2024, 4, 1), 1, 5)])


def test_curate_from_new_files_only(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d), "1", "omny", float(d)) for d in range(1, 5)]
    names = ("transit_timestamp", "station_complex_id", "payment_method", "ridership")
    df = spark.createDataFrame(rows, "transit_timestamp timestamp, station_complex_id string, payment_method string, ridership double")
    others = [c for c in jobs.transit.REQUIRED_COLUMNS if c not in names]
    silver = df.select("*", *(F.lit("x").alias(c) for c in others)).withColumn("year", F.year("transit_timestamp"))
    args = ["curate", "--table", str(tmp_path / "silver"), "--curated", str(tmp_path / "gold"), "--increment", str(tmp_path / "i"), "--state", str(tmp_path / "s")]
    for low, high in ((1, 3), (3, 5)):
        part = silver.where(F.dayofmonth("transit_timestamp").between(low, high - 1))
        part.coalesce(1).write.mode("append").partitionBy("year").parquet(str(tmp_path / "silver"))
        jobs.main(args)
        assert scan_table(spark, str(tmp_path / "i")).count() == 2
    assert scan_table(spark, str(tmp_path / "gold")).count() == 4

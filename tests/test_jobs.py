"""The whole chain on a small transit data set, job by job."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from lakecast import jobs

STATIONS = {"10": ("14 St (A,C,E)", "Manhattan"), "20": ("Main St, Flushing", "Queens"), "30": ("Bay Ridge", "Brooklyn")}


def records(days):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    for hour in range(24 * days):
        at = start + dt.timedelta(hours=hour)
        for number, (name, borough) in STATIONS.items():
            for payment in ("metrocard", "omny"):
                yield {
                    "transit_timestamp": at.strftime("%Y-%m-%dT%H:%M:%S.000"),
                    "transit_mode": "subway",
                    "station_complex_id": number,
                    "station_complex": name,
                    "borough": borough,
                    "payment_method": payment,
                    "fare_class_category": "OMNY - Full Fare" if payment == "omny" else "Metrocard - Full Fare",
                    "ridership": str(float(int(number) + 3 * (hour % 24) + rng.randrange(1, 4))),
                    "transfers": "1.0",
                    "latitude": "40.7",
                    "longitude": "-73.9",
                    "georeference": {"type": "Point", "coordinates": [-73.9, 40.7]},
                }


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("chain")
    (root / "stations.csv").write_text(
        "station_complex_id,station_complex\n"
        + "".join(f'{n},"{name}"\n' for n, (name, _) in STATIONS.items())
    )
    lines = [json.dumps(r) for r in records(75)]
    (root / "landed").mkdir()
    (root / "landed" / "rows.json").write_text("\n".join(lines))

    def run(*args):
        jobs.main([str(root / a[1:]) if str(a).startswith("@") else str(a) for a in args])
        return root

    run("backfill", "--source", "@landed", "--lake", "@lake", "--start", "01/2024", "--end", "03/2024")
    run("resume", "--source", "@landed", "--lake", "@lake")
    for _ in range(2):
        run("validate", "--lake", "@lake", "--stations", "@stations.csv", "--table", "@silver", "--good", "@good", "--bad", "@bad")
        run("curate", "--table", "@silver", "--curated", "@gold", "--increment", "@increment")
    run("features", "--curated", "@gold", "--out", "@features")
    return run


def test_tables(spark, chain):
    root = chain("curate", "--table", "@silver", "--curated", "@gold", "--increment", "@increment")
    assert spark.read.parquet(str(root / "silver")).count() == 75 * 24 * 6
    assert spark.read.parquet(str(root / "gold")).count() == 75 * 24 * 6
    assert spark.read.parquet(str(root / "features" / "hour_model")).count() == 6 * (75 * 24 - 25)
    daily = spark.read.parquet(str(root / "features" / "date_model"))
    assert daily.count() == 6 * (75 - 31)
    assert set(jobs.DAILY.features) <= set(daily.columns)


def test_models_and_forecasts(spark, chain):
    model = ("--features", "@features", "--model", "@model")
    root = chain("train", *model, "--out", "@predictions", "--cutoff", "2024-03-01", "--depth", 4, "--trees", 5, "--rounds", 3)
    published = spark.read.parquet(str(root / "predictions"))
    assert published.columns == [
        "transit_date", "transit_mode", "station_complex", "borough", "payment_method", "ridership", "transfer", "prediction"
    ]
    assert {r[0] for r in published.select("station_complex").distinct().collect()} == {n for n, _ in STATIONS.values()}

    chain("predict", *model, "--out", "@next")
    assert spark.read.parquet(str(root / "next")).count() == 6
    chain("forecast", *model, "--out", "@forecast", "--steps", 3)
    rows = spark.read.parquet(str(root / "forecast"))
    assert rows.count() == 18
    assert rows.agg(F.min("transit_date"), F.max("transit_date")).first() == (dt.date(2024, 3, 16), dt.date(2024, 3, 18))
    chain("backtest", *model, "--out", "@tested", "--steps", 4, "--seed", "2024-02-15", "2024-03-05", "--actual", "2024-03-06", "2024-03-15")
    tested = spark.read.parquet(str(root / "tested"))
    assert tested.count() == 24
    assert tested.where("actual_ridership is null").count() == 0


def test_hourly_forecast(spark, chain):
    model = ("--unit", "hour", "--features", "@features", "--model", "@hour-model")
    chain("train", *model, "--out", "@hour-predictions", "--cutoff", "2024-03-10", "--depth", 3, "--trees", 3, "--rounds", 2)
    root = chain("forecast", *model, "--out", "@hour-forecast", "--steps", 2)
    assert spark.read.parquet(str(root / "hour-forecast")).count() == 12

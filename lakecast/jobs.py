"""The chain for the transit data set as command-line jobs.

``python -m lakecast.jobs <job> --help``; jobs in order: backfill, resume, validate,
curate, features, train, predict, forecast, backtest. Submit with spark-submit on a
cluster. Every path is an argument; nothing is fixed.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecast import transit
from lakecast.operators.encoding import build_code_table, extend_code_table
from lakecast.operators.projections import clean_relevant, select_required, temporal_split
from lakecast.plans.features import encode_keys, group_daily, group_hourly, model_table
from lakecast.plans.forecasting import backtest, predict_next, recursive_forecast
from lakecast.plans.landing import backfill_missing, resume_month
from lakecast.plans.curating import append_months_by_key
from lakecast.plans.loading import load_validated, normalise
from lakecast.plans.staging import with_file
from lakecast.plans.modeling import (
    boosted_trees,
    cast_time,
    compare,
    load_model,
    publish,
    random_forest,
    save_model,
)
from lakecast.series import DAILY, HOURLY, SeriesSpec
from lakecast.session import build_session
from lakecast.sources.files import (
    nanos_as_long,
    parse_time_column,
    reference_values,
    scan_json,
    scan_parquet,
)
from lakecast.sources.tables import create_or_replace_as, read_current, replace_self, scan_table, table_exists
from lakecast.streaming.incremental import run_incremental_stream

log = logging.getLogger(__name__)

TIME = "transit_timestamp"
MEASURES = ["ridership", "transfers", "latitude", "longitude"]
SPECS = {"day": DAILY, "hour": HOURLY}
#: States of the code table that stay readable for jobs still at work.
KEPT_STATES = 5


def _landed(spark: SparkSession, path: str) -> DataFrame:
    return parse_time_column(scan_json(spark, path, transit.JSON_SCHEMA), TIME)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    report = backfill_missing(_landed(spark, args.source), TIME, args.lake, args.start, args.end)
    log.info("months loaded: %s, failed: %s", report.missing, report.errors)


def resume(spark: SparkSession, args: argparse.Namespace) -> None:
    resume_month(_landed(spark, args.source), TIME, args.lake)


def validate(spark: SparkSession, args: argparse.Namespace) -> None:
    stations = reference_values(spark, args.stations, ["station_complex_id", "station_complex"])

    def load(raw: DataFrame) -> None:
        report = load_validated(
            normalise(raw, TIME, MEASURES), args.table, transit.rules(stations), TIME, args.good, args.bad,
            on_fail=args.on_fail,
        )
        log.info("batch %s", report.status)
        if report.summary is not None and args.summary:
            # With a state there may be several batches in a run, each with its own result.
            report.summary.write.mode("append" if args.state else "overwrite").parquet(args.summary)

    with nanos_as_long(spark):
        kind = spark.read.parquet(args.lake).schema[TIME].dataType.simpleString()
        schema = transit.RAW_SCHEMA if kind == "bigint" else transit.LAKE_SCHEMA
        if args.state:
            run_incremental_stream(spark, f"{args.lake}/year=*/month=*", schema, load, args.state, name_files=True)
        else:
            load(with_file(scan_parquet(spark, args.lake, schema)))


def curate(spark: SparkSession, args: argparse.Namespace) -> None:
    """Append to the curated table, which is laid out by month; with a state, from the files that are new since the last run."""

    def append(rows: DataFrame) -> None:
        facts = select_required(rows, transit.REQUIRED_COLUMNS)
        written = append_months_by_key(facts, args.curated, args.increment, transit.GOLD_KEYS, TIME)
        log.info("%d new rows", written)

    validated = scan_table(spark, args.table)
    if args.state:
        run_incremental_stream(spark, f"{args.table}/year=*", validated.drop("year").schema, append, args.state)
    else:
        append(validated)


def features(spark: SparkSession, args: argparse.Namespace) -> None:
    """Hourly and daily model tables below ``--out``, and the code table both are coded with."""
    facts = clean_relevant(
        scan_table(spark, args.curated),
        TIME,
        [*transit.LABEL_COLUMNS, "fare_class_category"],
        ["ridership", "transfers"],
    )
    grouped = group_hourly(
        facts, TIME, transit.LABEL_COLUMNS, {"ridership": "ridership", "transfer": "transfers"}
    )
    grouped = create_or_replace_as(grouped, f"{args.out}/grouped")
    codes = _codes(spark, grouped, f"{args.out}/codes")
    hourly = create_or_replace_as(
        encode_keys(grouped, codes, transit.LABEL_COLUMNS), f"{args.out}/encoded_hour"
    )
    daily = create_or_replace_as(
        group_daily(hourly, TIME, DAILY.keys, {"ridership": "ridership", "transfer": "transfer"}),
        f"{args.out}/encoded_date",
    )
    create_or_replace_as(model_table(hourly, HOURLY, split_rows=args.split_rows), f"{args.out}/hour_model")
    create_or_replace_as(model_table(daily, DAILY, split_rows=args.split_rows), f"{args.out}/date_model")


def _codes(spark: SparkSession, grouped: DataFrame, root: str) -> DataFrame:
    """The code table next to the models: built once, then only extended."""
    if table_exists(spark, root):
        return replace_self(extend_code_table(read_current(spark, root), grouped, transit.LABEL_COLUMNS), root, keep=KEPT_STATES)
    return replace_self(build_code_table(grouped, transit.LABEL_COLUMNS), root, keep=KEPT_STATES)


def _model_rows(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, SeriesSpec]:
    name = "date_model" if args.unit == "day" else "hour_model"
    return scan_table(spark, f"{args.features}/{name}"), SPECS[args.unit]


def _publish(df: DataFrame, spec: SeriesSpec, args: argparse.Namespace, extra=()) -> None:
    codes = read_current(df.sparkSession, f"{args.features}/codes")
    rows = publish(cast_time(df, spec), spec, codes, transit.LABEL_COLUMNS, extra)
    rows.write.mode("overwrite").parquet(args.out)


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    rows, spec = _model_rows(spark, args)
    before, after = temporal_split(rows, spec.time, args.cutoff)
    regressors = {
        "boosted": boosted_trees(spec.value, args.depth, rounds=args.rounds),
        "forest": random_forest(spec.value, args.trees, args.depth),
    }
    result = compare(before, after, spec, regressors)
    log.info("metrics: %s, best: %s", result.metrics, result.best)
    best = result.models[result.best]
    save_model(best, args.model)
    _publish(best.transform(after), spec, args, (spec.value, *spec.carried))


def predict(spark: SparkSession, args: argparse.Namespace) -> None:
    rows, spec = _model_rows(spark, args)
    _publish(predict_next(rows, spec, load_model(args.model)), spec, args)


def forecast(spark: SparkSession, args: argparse.Namespace) -> None:
    rows, spec = _model_rows(spark, args)
    _publish(recursive_forecast(rows, spec, load_model(args.model), args.steps), spec, args)


def backtest_job(spark: SparkSession, args: argparse.Namespace) -> None:
    rows, spec = _model_rows(spark, args)
    tested = backtest(
        rows, spec, load_model(args.model), tuple(args.seed), tuple(args.actual), args.steps
    )
    _publish(tested, spec, args, (f"actual_{spec.value}",))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakecast.jobs")
    jobs = top.add_subparsers(required=True)

    def job(name, run, *paths):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    sub = job("backfill", backfill, "source", "lake")
    sub.add_argument("--start", required=True, help="first month, MM/yyyy")
    sub.add_argument("--end", required=True, help="last month, MM/yyyy")
    job("resume", resume, "source", "lake")
    sub = job("validate", validate, "lake", "stations", "table", "good", "bad")
    sub.add_argument("--on-fail", choices=("quarantine_batch", "split"), default="quarantine_batch")
    sub.add_argument("--state", help="remembers the files loaded, so that a run takes only new ones")
    sub.add_argument("--summary", help="where the suite's full result is written")
    sub = job("curate", curate, "table", "curated", "increment")
    sub.add_argument("--state", help="remembers the validated files taken, so that a run reads only new ones")
    sub = job("features", features, "curated", "out")
    sub.add_argument("--split-rows", type=int, help="cut series into segments of that many rows")
    for name, run in (("train", train), ("predict", predict), ("forecast", forecast), ("backtest", backtest_job)):
        sub = job(name, run, "features", "model", "out")
        sub.add_argument("--unit", choices=("day", "hour"), default="day")
        if name == "train":
            sub.add_argument("--cutoff", required=True)
            sub.add_argument("--depth", type=int, default=10)
            sub.add_argument("--trees", type=int, default=100)
            sub.add_argument("--rounds", type=int, default=100)
        if name in ("forecast", "backtest"):
            sub.add_argument("--steps", type=int, default=14)
        if name == "backtest":
            for part in ("seed", "actual"):
                sub.add_argument(f"--{part}", nargs=2, required=True, metavar=("FROM", "TO"))
    return top


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()

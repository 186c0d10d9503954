"""Fitting, scoring and publishing regression models with Spark ML."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.operators.aggregates import regression_metrics
from lakecast.operators.encoding import decode_labels
from lakecast.operators.projections import temporal_split
from lakecast.series import SeriesSpec


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def boosted_trees(
    label: str,
    max_depth: int = 10,
    learning_rate: float = 0.1,
    rounds: int = 100,
    workers: int = 8,
    engine: str = "spark",
    seed: int = 42,
) -> Estimator:
    """Gradient-boosted trees: Spark ML's, or by name XGBoost's Spark estimator, which has to be installed."""
    if engine not in ("spark", "xgboost"):
        raise ValueError("engine is 'spark' or 'xgboost'")
    if engine == "xgboost":
        from xgboost.spark import SparkXGBRegressor

        return SparkXGBRegressor(
            features_col="features",
            label_col=label,
            num_workers=workers,
            max_depth=max_depth,
            learning_rate=learning_rate,
            n_estimators=rounds,
            random_state=seed,
        )
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxDepth=max_depth,
        stepSize=learning_rate,
        maxIter=rounds,
        seed=seed,
    )


def random_forest(
    label: str, trees: int = 100, max_depth: int = 10, subsample: float = 1.0, seed: int = 42
) -> Estimator:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        numTrees=trees,
        maxDepth=max_depth,
        featureSubsetStrategy="auto",
        subsamplingRate=subsample,
        seed=seed,
    )


def linear_model(label: str) -> Estimator:
    """Least squares by the normal equations."""
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal")


def fit(train: DataFrame, features: Sequence[str], regressor: Estimator) -> PipelineModel:
    return Pipeline(stages=[assembler(features), regressor]).fit(train)


_NODES = (
    "array<struct<weight: double, feature: array<int>, threshold: array<double>, low: array<int>, high: array<int>, value: array<double>>>"
)
_LINE = re.compile(r"\s*(?:(If|Else) \(feature (\d+) (?:<=|>) ([^)]*)\)|Predict: (\S+)|Tree \d+ \(weight (\S+)\):)")


def tree_arrays(model: PipelineModel) -> list[dict]:
    """The trees of a fitted forest or of boosted trees as arrays of nodes: feature (-1 in a leaf), threshold, next nodes, value."""
    last, trees, open_ = model.stages[-1], [], []
    for line in last.toDebugString.splitlines()[1:]:
        found = _LINE.match(line)
        if found is None:
            raise ValueError(f"only splits by thresholds are known, not {line.strip()!r}")
        side, feature, threshold, value, weight = found.groups()
        if weight is not None:
            trees.append({k: [] for k in ("feature", "threshold", "low", "high", "value")} | {"weight": float(weight)})
            open_ = []
            continue
        tree = trees[-1]
        if side == "Else":
            # What follows is the other side of the last split that still waits for it.
            tree["high"][open_[-1]] = len(tree["value"])
            open_.pop()
            continue
        at = len(tree["value"])
        for k, x in zip(("feature", "threshold", "low", "high", "value"), (-1, 0.0, at, at, 0.0), strict=True):
            tree[k].append(x)
        if side == "If":
            tree["feature"][at], tree["threshold"][at], tree["low"][at] = int(feature), float(threshold), at + 1
            open_.append(at)
        else:
            tree["value"][at] = float(value)
    return trees


class TreeExpression:
    """A fitted tree ensemble as one expression of built-in functions, with a pipeline model's ``transform``.

    The trees are a constant of the plan; a row walks each from its root. A step of a recursive forecast stays a
    projection, so several steps are one plan without a vector column in between.
    """

    def __init__(self, model: PipelineModel):
        self.features = list(model.stages[0].getInputCols())
        self.trees = tree_arrays(model)
        mean = isinstance(model.stages[-1], RandomForestRegressionModel)
        self.scale = float(len(self.trees)) if mean else 1.0
        self.depth = max((t.depth for t in model.stages[-1].trees), default=0)

    def score(self) -> Column:
        x = F.array(*(F.col(f"`{c}`").cast("double") for c in self.features))
        trees = F.from_json(F.lit(json.dumps(self.trees)), _NODES)

        def leaf(tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                below = F.get(x, F.get(tree["feature"], at)) <= F.get(tree["threshold"], at)
                onward = F.when(below, F.get(tree["low"], at)).otherwise(F.get(tree["high"], at))
                return F.when(F.get(tree["feature"], at) < 0, at).otherwise(onward)

            return F.aggregate(F.sequence(F.lit(0), F.lit(self.depth)), F.lit(0), step)

        total = F.aggregate(trees, F.lit(0.0), lambda so_far, tree: so_far + tree["weight"] * F.get(tree["value"], leaf(tree)))
        return total / F.lit(self.scale)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.score())


def evaluate(model: PipelineModel, test: DataFrame, label: str) -> DataFrame:
    """rmse, mse and mae of ``model`` on ``test``, scored once."""
    return regression_metrics(model.transform(test), label)


@dataclass(frozen=True)
class Comparison:
    """Fitted models by name, their metrics, and the name of the one with the lowest rmse."""

    models: dict[str, PipelineModel]
    metrics: dict[str, dict[str, float]]
    best: str


def compare(
    train: DataFrame, test: DataFrame, spec: SeriesSpec, regressors: Mapping[str, Estimator]
) -> Comparison:
    models = {name: fit(train, spec.features, r) for name, r in regressors.items()}
    metrics = {
        name: evaluate(model, test, spec.value).first().asDict() for name, model in models.items()
    }
    return Comparison(models, metrics, min(metrics, key=lambda name: metrics[name]["rmse"]))


def fit_on_split(
    table: DataFrame, spec: SeriesSpec, cutoff: str, regressors: Mapping[str, Estimator]
) -> tuple[Comparison, DataFrame]:
    """Train before ``cutoff``, compare after it; also the best model's test predictions."""
    train, test = temporal_split(table, spec.time, cutoff)
    result = compare(train, test, spec, regressors)
    return result, result.models[result.best].transform(test)


def publish(
    predictions: DataFrame,
    spec: SeriesSpec,
    code_table: DataFrame | None = None,
    labels: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Final columns: time, decoded labels (or the bare keys), ``extra`` and ``prediction``."""
    time = [spec.time] if spec.time in predictions.columns else []
    kept = predictions.select(*time, *spec.keys, *extra, "prediction")
    if code_table is None:
        return kept
    decoded = decode_labels(kept, code_table, labels)
    plain = [k for k in spec.keys if k in decoded.columns]
    return decoded.select(*time, *labels, *plain, *extra, "prediction")


def cast_time(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Date or timestamp type for the time column of a published table."""
    return df.withColumn(spec.time, F.col(spec.time).cast("date" if spec.unit == "day" else "timestamp"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

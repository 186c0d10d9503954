"""Quality rules by robust multivariate outliers.

Every text gives a vector of transformed statistics. For each language and source the
minimum-covariance-determinant estimate gives the centre and scatter of the closest half
of its documents; documents far from it by Mahalanobis distance are rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts, kept, stored
from lakecast.session import broadcast_if_small

WINDOW = 8

#: Vectors are whole numbers of this part of a unit: their sums are exact, so results do not
#: depend on the order in which tasks add up.
UNIT = 256

#: Statistics of a text as the transform's input, and the vector's components.
VECTOR = ("word_length", "symbols", "dup_lines", "repeats", "capitals", "marks", "doubled")
_P = len(VECTOR)
_X = [f"x{i}" for i in range(_P)]

# Classes of bytes: 1 white space, 2 symbols, 3 capitals, 4 other ASCII marks, 5 continuation bytes.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4
_CLASS[[32, *range(9, 14)]] = 1
_CLASS[list(b"#*$%&|<>")] = 2
_CLASS[65:91] = 3
_CLASS[128:192] = 5


@dataclass(frozen=True)
class Rules:
    """``least_words`` and ``most_repeats`` (percent of the words) are the base rules. ``tail``: share of normal vectors
    beyond the limit. ``floors``: standard deviation that each component has at least, in
    units of the transform, so that a statistic that is 0 for most documents does not reject every other
    value. Each statistic alone can pass the limit; a line that stands twice is no fault, which the transform sees to.
    ``least_rows``: smaller groups are pooled. ``steps``: concentration steps."""

    least_words: int = 20
    most_repeats: int = 30
    tail: float = 1e-6
    floors: tuple[float, ...] = (0.25, 0.25, 0.5, 0.4, 0.25, 0.25, 0.25)
    least_rows: int = 100
    steps: int = 6


def statistics(text: bytes | None) -> tuple[int, ...]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_marks, n_doubled`` of a whole text."""
    if not text:
        return (0,) * 9
    classes = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=6)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    chars = len(text) - int(classes[1]) - int(classes[5])
    return (
        len(words), chars, int(classes[2]), len(lines) - len(set(lines)), _repeated(words), len(lines), int(classes[3]), int(classes[4]),
        sum(map(eq, words, words[1:])),
    )


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a window of 8 words which occurs twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    # Distinct numbers, well mixed; a window is a polynomial of its words modulo 2^64.
    ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    ids ^= ids >> np.uint64(29)
    ids *= np.uint64(0xBF58476D1CE4E5B9)
    windows = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        windows = windows * np.uint64(0x100000001B3) + ids[i : i + n]
    order = np.argsort(windows, kind="stable")
    equal = windows[order[1:]] == windows[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, np.flatnonzero(twice), 1)
    np.add.at(steps, np.flatnonzero(twice) + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(steps)[:-1]))


def vector(stats: tuple[int, ...]) -> list[int]:
    """Logarithms of the mean word length and of percentages. Each ratio has some more words or lines in
    its denominator, so that short texts do not stand out by chance. The first two repeated lines, and as many
    words as two windows twice, do not count."""
    words, chars, symbols, dup_lines, repeats, lines, capitals, marks, doubled = stats
    shares = (
        symbols / (chars + 100), max(0, dup_lines - 2) / (lines + 5), max(0, repeats - 4 * WINDOW) / (words + 50), capitals / (chars + 100), marks / (chars + 100),
        doubled / (words + 50),
    )
    whole = [4 * math.log((chars + 250) / (words + 50)), *(math.log1p(100 * s) for s in shares)]
    return [round(UNIT * v) for v in whole]


def measured(docs: DataFrame, rules: Rules, key: str, text: str, by: tuple[str, ...]) -> DataFrame:
    """``key``, the statistics, the vector ``x0...``, ``base_failed`` and the group columns ``g0...``."""
    kind = docs.schema[key].dataType.simpleString()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    groups = [F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(by)]
    rows = docs.select(F.col(key).alias("id"), *groups, F.col(text).cast("string").alias("text"))
    fields = f"id {kind}, " + ", ".join(f"g{i} string" for i in range(len(by)))
    fields += "".join(f", {n} long" for n in (*names, *_X)) + ", base_failed boolean"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t) for t in byte_texts(batch.column(len(by) + 1))]
            stats = np.array(found, np.int64).reshape(-1, 9)
            vectors = np.array([vector(s) for s in found], np.int64).reshape(-1, _P)
            failed = (stats[:, 0] < rules.least_words) | (100 * stats[:, 4] > rules.most_repeats * stats[:, 0])
            columns = [*batch.columns[: len(by) + 1], *(pa.array(c) for c in stats[:, :5].T), *(pa.array(c) for c in vectors.T), pa.array(failed)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *(f"g{i}" for i in range(len(by))), *names, *_X, "base_failed"])

    return rows.mapInArrow(measure, fields)


def _cells(rows: DataFrame, n_groups: int, least: int) -> DataFrame:
    """``g0..., cell``: a group's own cell if it has enough rows, else the one of its first column, else that of all such."""
    groups = [f"g{i}" for i in range(n_groups)]
    counts = rows.groupBy(*groups).agg(F.count(F.when(~F.col("base_failed"), 1)).alias("n"))
    small = F.when(F.col("n") < least, F.col("n")).otherwise(0)
    pooled = F.sum(small).over(Window.partitionBy("g0"))
    cell = (
        F.when(F.col("n") >= least, F.to_json(F.struct(F.lit(0).alias("level"), *groups)))
        .when(pooled >= least, F.to_json(F.struct(F.lit(1).alias("level"), "g0")))
        .otherwise(F.lit("all"))
    )
    return counts.select(*groups, cell.alias("cell"))


def chi2_below(x: float, dof: float) -> float:
    """Share of a chi-square distribution below ``x``, by the series of the incomplete gamma function."""
    a, y = dof / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= y / n
        total += term
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a)))


def chi2_limit(share: float, dof: float) -> float:
    """The value with ``share`` of the distribution below it."""
    low, high = 0.0, 10.0 * dof + 200
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_below(middle, dof) < share else (low, middle)
    return high


_ESTIMATE = "cell string, start string, centre array<double>, inverse array<double>, log_det double, n long"


def _consistency(share: float) -> float:
    """Factor that makes the scatter of the closest ``share`` of normal vectors that of all."""
    return 1.0 if share >= 1 else share / chi2_below(chi2_limit(share, _P), _P + 2)


def _estimates(moments: DataFrame, rules: Rules, share: float) -> DataFrame:
    """Centre, inverse scatter and its determinant from exact sums; one row per cell and start."""
    factor = _consistency(share)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(_P)
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                centre = np.array([int(s) for s in row.sums], float) / row.n / UNIT
                second = np.zeros((_P, _P))
                second[upper] = np.array([int(s) for s in row.products], float) / row.n / UNIT**2
                second = second + np.triu(second, 1).T
                scatter = factor * (second - np.outer(centre, centre)) + np.diag(np.square(rules.floors))
                out.append((row.cell, row.start, centre, np.linalg.inv(scatter).ravel(), np.linalg.slogdet(scatter)[1], row.n))
            yield pd.DataFrame(out, columns=["cell", "start", "centre", "inverse", "log_det", "n"])

    return moments.mapInPandas(solve, _ESTIMATE)


def _sums() -> list[Column]:
    pairs = [(i, j) for i in range(_P) for j in range(i, _P)]
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.sum(x).alias(f"s_{x}") for x in _X),
        *(F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}_{j}") for i, j in pairs),
    ]


def _packed(sums: DataFrame) -> DataFrame:
    pairs = [f"p_{i}_{j}" for i in range(_P) for j in range(i, _P)]
    return sums.select("cell", "start", "n", F.array(*(f"s_{x}" for x in _X)).alias("sums"), F.array(*pairs).alias("products"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from the estimate beside it."""
    away = [F.col(x) / UNIT - F.col("centre")[i] for i, x in enumerate(_X)]
    terms = [away[i] * away[j] * F.col("inverse")[i * _P + j] * (1 if i == j else 2) for i in range(_P) for j in range(i, _P)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def _concentrated(rows: DataFrame, estimates: DataFrame, rules: Rules) -> DataFrame:
    """One concentration step: estimates from the closest half of each cell.

    Distances are sorted into classes of a sixteenth of an octave, and sums are kept per class, so a
    step is one pass over the rows and a running count over at most about a thousand classes a cell. The
    half takes whole classes: equal distances are never parted.
    """
    near = F.floor(16 * F.log2(1 + 16 * F.greatest(_distance(), F.lit(0.0)))).cast("int")
    classes = (
        rows.join(broadcast_if_small(estimates.select("cell", "start", "centre", "inverse")), "cell")
        .withColumn("class", near)
        .groupBy("cell", "start", "class")
        .agg(*_sums())
    )
    cell = Window.partitionBy("cell", "start")
    upto = F.sum("n").over(cell.orderBy("class"))
    half = (F.sum("n").over(cell) + _P + 1) / 2
    inner = classes.withColumn("closer", upto - F.col("n")).withColumn("half", half).where("closer < half")
    sums = [c for c in inner.columns if c.startswith(("s_", "p_"))]
    total = inner.groupBy("cell", "start").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in sums))
    return kept(_estimates(_packed(total), rules, 0.5))


def mcd(rows: DataFrame, rules: Rules) -> DataFrame:
    """``cell, centre, inverse``: the reweighted minimum-covariance-determinant estimate of each cell.

    Concentration starts from medians with absolute deviations and from classical moments; the
    start that ends at the smaller determinant is taken. The estimate is made once more from all
    rows within the 97.5 % limit.
    """
    medians = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *(F.percentile(x, F.lit(0.5)).alias(f"m_{x}") for x in _X))
    medians = kept(medians)
    off = [F.percentile(F.abs(F.col(x) - F.col(f"m_{x}")), F.lit(0.5)) for x in _X]
    spread = rows.join(broadcast_if_small(medians.drop("n")), "cell").groupBy("cell").agg(*(c.alias(f"d_{x}") for c, x in zip(off, _X, strict=True)))
    deviations = [F.pow(F.col(f"d_{x}") * 1.4826 / UNIT, 2) + floor**2 for x, floor in zip(_X, rules.floors, strict=True)]
    diagonal = F.array(*(1 / deviations[i] if i == j else F.lit(0.0) for i in range(_P) for j in range(_P)))
    robust = medians.join(spread, "cell").select(
        "cell", F.lit("medians").alias("start"), F.array(*(F.col(f"m_{x}") / UNIT for x in _X)).alias("centre"),
        diagonal.alias("inverse"), F.lit(0.0).alias("log_det"), "n",
    )
    classical = _estimates(_packed(rows.withColumn("start", F.lit("moments")).groupBy("cell", "start").agg(*_sums())), rules, 1.0)
    estimates = kept(robust.unionByName(classical))
    for _ in range(rules.steps):
        estimates = _concentrated(rows, estimates, rules)
    best = estimates.groupBy("cell").agg(F.min(F.struct("log_det", "start", "centre", "inverse")).alias("e")).select("cell", "e.centre", "e.inverse")
    best = kept(best)
    inside = rows.join(broadcast_if_small(best), "cell").where(_distance() <= chi2_limit(0.975, _P))
    final = _estimates(_packed(inside.withColumn("start", F.lit("reweighted")).groupBy("cell", "start").agg(*_sums())), rules, 0.975)
    return kept(final.select("cell", "centre", "inverse"))


def judge(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``key``, five base statistics, ``base_failed``, ``kept``, ``distance`` and the ``cell`` that was compared with.

    Estimates come from all rows that pass the base rules. Groups with fewer than ``rules.least_rows`` of them are
    judged with the other small groups of their first column, or with all such groups; if
    even those are few, only the base rules hold. Whole texts are measured, one document at a time.

    Nulls: a null or empty text has no words and fails the base rules; a null language or source
    is a group of its own; a null key stays null. Repeated rows each count and are judged alike. An empty table
    gives an empty result. Other columns are ignored.
    """
    rows = stored(measured(docs, rules, key, text, by), "statistics")
    groups = [f"g{i}" for i in range(len(by))]
    cells = kept(_cells(rows, len(by), rules.least_rows))
    own = [F.col(f"r.{g}").eqNullSafe(F.col(f"c.{g}")) for g in groups]
    placed = rows.alias("r").join(broadcast_if_small(cells).alias("c"), own).select("r.*", "c.cell").drop(*groups)
    sound = placed.where("NOT base_failed").select("cell", *_X)
    sound = stored(sound, "vectors")
    few = sound.groupBy("cell").count().where(F.col("count") >= rules.least_rows).select("cell")
    estimates = mcd(sound.join(broadcast_if_small(kept(few)), "cell"), rules)
    distance = _distance()
    within = F.coalesce(distance <= chi2_limit(1 - rules.tail, _P), F.lit(True))
    return placed.join(broadcast_if_small(estimates), "cell", "left").select(
        F.col("id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & within).alias("kept"), F.sqrt(distance).alias("distance"), "cell",
    )

"""Language ID by multilingual mixture inference.

A document's n-grams are draws from a mixture of the languages' n-gram distributions.
Expectation-maximisation finds the proportions; the set of languages is the one whose
likelihood, less a penalty for each language, is greatest. Whether a text is in them at all is told by
that likelihood, next to what their own training texts have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts

UNKNOWN = "und"
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[[*range(9, 14)]] = 32


@dataclass(frozen=True)
class Settings:
    """``bits``: n-grams are hashed to 2^bits classes. ``penalty``: log-likelihood a language has to
    add per log of the n-gram count (0.5 would be the usual penalty for independent draws; n-grams overlap,
    so it is larger). ``least_share``: proportions below it leave the set. ``languages``:
    bound of the model broadcast, 2^bits floats of four bytes a language; of more, those with the most documents are
    learned. ``block``: languages fitted at once. ``taught``: documents that a language needs before a text is rejected for
being unlike it; of fewer, too much of the language is unseen. ``deviations``: standard deviations of chance that a text's fit is forgiven."""

    bits: int = 14
    rounds: int = 15
    penalty: float = 3.0
    least_share: float = 0.02
    languages: int = 1024
    block: int = 64
    taught: int = 50
    deviations: float = 4.0


def ngram_counts(text: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and counts of the byte trigrams of a whole text, in lower case, blanks at its ends."""
    codes = _LOWER[np.frombuffer(b" " + text + b" ", np.uint8)]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0)
    grams = codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]
    classes = (grams * np.uint32(2654435761)) >> np.uint32(32 - bits)
    counts = np.bincount(classes, minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)


def has_letter(text: bytes | None) -> bool:
    """Does the text hold a letter of any script?"""
    if not text:
        return False
    if _LETTERS[np.frombuffer(text, np.uint8)].any():
        return True
    return not text.isascii() and any(map(str.isalpha, text.decode()))


@dataclass(frozen=True)
class Model:
    """``chances``: class by language, each language's n-gram distribution. ``levels``: mean log-likelihood of an n-gram
    of a language's training texts, minus infinity if they are too few to tell. ``spreads``: its standard deviation."""

    names: tuple[str, ...]
    chances: np.ndarray
    settings: Settings
    levels: np.ndarray
    spreads: np.ndarray


def train(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> Model:
    """Distributions from all rows with a text and a language.

    Each task counts its rows' n-grams by language; the counts are summed in one aggregate. The model's
    size is set by ``bits`` and ``settings.languages``, not by the rows: a column with more values than that teaches those
    that most documents have (ties: by name), so that stray values cannot stop a run. Without rows the model knows no language.
    """
    size = 1 << settings.bits
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1)), strict=True):
                if not has_letter(content):
                    continue
                if name not in sums:
                    sums[name] = np.zeros(size)
                classes, counts = ngram_counts(content, settings.bits)
                # A document weighs as one: long texts are no better evidence of a language.
                sums[name][classes] += counts / counts.sum()
        for name, total in sums.items():
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                # Millionths in whole numbers add up to the same sums in any order.
                [pa.array([name] * len(found)), pa.array(found, pa.int64()), pa.array(np.rint(total[found] * 1e6).astype(np.int64))],
                names=["lang", "class", "n"],
            )

    sums = rows.mapInArrow(count, "lang string, class long, n long").groupBy("lang", "class").agg(F.sum("n").alias("n"))
    each = sums.groupBy("lang").agg(F.sum("n").alias("weight"), F.collect_list(F.struct(F.col("class").cast("int").alias("class"), "n")).alias("counts"))
    most = each.orderBy(F.desc("weight"), "lang").limit(settings.languages)
    found = most.select("lang", F.col("counts.class").alias("classes"), F.col("counts.n").alias("counts")).toArrow().sort_by("lang")
    names = tuple(found["lang"].to_pylist())
    chances = np.empty((size, len(names)), np.float32)
    levels, spreads = np.full(len(names), -np.inf), np.zeros(len(names))
    for i in range(len(names)):
        column = np.zeros(size)
        column[found["classes"][i].values.to_numpy()] = found["counts"][i].values.to_numpy()
        # Unseen classes get the share of a single n-gram in a text of a thousand.
        smooth = column + 1e-4 * max(column.sum(), 1.0) / size
        chances[:, i] = smooth / smooth.sum()
        # Each document weighs a million.
        if column.sum() >= (settings.taught - 0.5) * 1e6:
            logs, seen = np.log(smooth / smooth.sum()), column / column.sum()
            levels[i] = seen @ logs
            spreads[i] = np.sqrt(max(0.0, seen @ logs**2 - levels[i] ** 2))
    return Model(names, chances, settings, levels, spreads)


def _fit(chances: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions of the languages in ``chances``' columns, and the log-likelihood."""
    n = counts.sum()
    shares = np.full(chances.shape[1], 1 / chances.shape[1])
    if len(shares) == 1:
        return shares, float(counts @ np.log(chances[:, 0]))
    for _ in range(rounds):
        shares = shares * (chances.T @ (counts / (chances @ shares))) / n
    return shares, float(counts @ np.log(chances @ shares))


def _candidates(chances: np.ndarray, counts: np.ndarray, settings: Settings) -> np.ndarray:
    """Columns of the languages to fit together: with more than a block, those that take the least share, or the largest, of their block.

    A text's own languages explain their part in any block, so they stay; blocks of what stays are fitted again.
    """
    found = np.arange(chances.shape[1])
    while len(found) > settings.block:
        parts = []
        for part in np.array_split(found, -(-len(found) // settings.block)):
            shares, _ = _fit(chances[:, part], counts, settings.rounds)
            parts.append(part[shares >= min(settings.least_share, shares.max())])
        left = np.concatenate(parts)
        if len(left) == len(found):
            break
        found = left
    return found


def judge(text: bytes | None, model: Model) -> tuple[dict[str, float], float]:
    """Languages of a text with their proportions, and how well they explain it; none if it is null, has no letter, or nothing was learned.

    All languages are fitted first, in blocks where they are many; sets of the first one, two, ... by proportion are
    fitted again and the best by penalised likelihood is taken. Equal proportions
    are ordered by name.

    The second number is 0, or what the log-likelihood of an n-gram lacks, beyond chance, to that of texts of these
    languages in these proportions; texts of known languages are near 0 however many they mix, others far below.
    """
    if not model.names or not has_letter(text):
        return {}, 0.0
    settings = model.settings
    classes, counts = ngram_counts(text, settings.bits)
    chances = model.chances[classes].astype(np.float64)
    kept = _candidates(chances, counts, settings)
    chances = chances[:, kept]
    shares, _ = _fit(chances, counts, settings.rounds)
    order = np.argsort(-shares, kind="stable")
    cost = settings.penalty * np.log(counts.sum() + 1)
    best, best_shares, likeliest = order[:1], np.ones(1), _fit(chances[:, order[:1]], counts, 0)[1]
    for k in range(2, len(order) + 1):
        if shares[order[k - 1]] < settings.least_share:
            break
        own, likelihood = _fit(chances[:, order[:k]], counts, settings.rounds)
        if likelihood - k * cost <= likeliest - len(best) * cost:
            break
        best, best_shares, likeliest = order[:k], own, likelihood
    ranked = sorted(zip(-best_shares, kept[best], strict=True))
    n, part = counts.sum(), np.maximum(best_shares, 1e-12)
    # A mixture is at least as likely as its parts in their places, each less the cost of the choice.
    level = part @ (model.levels[kept[best]] + np.log(part))
    lack = likeliest / n - level + settings.deviations * (part @ model.spreads[kept[best]]) / np.sqrt(n)
    return {model.names[i]: float(-share) for share, i in ranked}, float(min(0.0, lack))


def infer(text: bytes | None, model: Model) -> dict[str, float]:
    """Languages of a text with their proportions, largest first, as ``judge`` finds them."""
    return judge(text, model)[0]


def predictor(docs: DataFrame, model: Model):
    """A column function: text to ``struct<lang, score, languages, shares, fit>``.

    ``lang`` is the language of the largest proportion, ``score`` that proportion, ``fit`` how well all explain the text;
    a text without languages gets ``und`` and 0. The model is broadcast; its size is bounded
    by the settings. Only the text is an input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, languages array<string>, shares array<double>, fit double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        judged = [judge(t.encode() if t is not None else None, shared.value) for t in texts]
        found = [languages for languages, _ in judged]
        top = [next(iter(f.items()), (UNKNOWN, 0.0)) for f in found]
        return pd.DataFrame(
            {
                "lang": [t[0] for t in top],
                "score": [min(1.0, max(0.0, t[1])) for t in top],
                "languages": [list(f) for f in found],
                "shares": [list(f.values()) for f in found],
                "fit": [fit for _, fit in judged],
            }
        )

    return predict


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with the struct column ``into``; a column of that name is replaced.

    Null and empty texts and texts without a letter are ``und``. Each row is judged alone, so repeated rows get
    the same answer and an empty table stays empty; very long texts count whole.
    """
    return docs.withColumn(into, predictor(docs, model)(F.col(text).cast("string")))


def without_unidentified(docs: DataFrame, model: Model, least_fit: float = -1.5, text: str = "text") -> DataFrame:
    """Rows in languages that the model knows, one or many; all columns stay.

    A text goes if it is ``und``, or if its n-grams are on average ``exp(-least_fit)`` times less likely than those of
    texts in the languages that explain it best. Languages taught by few documents reject nothing.
    """
    judged: Column = predictor(docs, model)(F.col(text).cast("string"))
    return docs.where((judged["lang"] != UNKNOWN) & (judged["fit"] >= least_fit))

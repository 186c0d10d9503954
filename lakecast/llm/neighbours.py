"""Quality classifier by nearest-neighbour voting in a latent semantic space.

Labelled texts give a term matrix (hashed n-grams and word shapes), whose leading singular
vectors span the latent space. The labelled vectors are broadcast; each document's vector
is compared with all of them by blocked cosine products, and the nearest vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts, kept, seeded
from lakecast.llm.languages import ngram_counts

SHAPES = 10
BLOCK = 256


@dataclass(frozen=True)
class Settings:
    """``per_label``: labelled rows kept of each label, the bound of the fit and of the broadcast.
    ``bits``: n-grams are hashed to 2^bits terms. ``dimensions`` of the latent space,
    ``neighbours`` that vote, ``sharpness``: power of the similarity that is a vote's weight."""

    per_label: int = 2000
    bits: int = 12
    dimensions: int = 64
    neighbours: int = 25
    sharpness: int = 8
    shape_weight: float = 1.5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """``space``: term by dimension. ``vectors``: unit rows of the labelled texts with ``labels`` and how many rows each stands for."""

    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    settings: Settings = field(default_factory=Settings)


def shapes(text: bytes) -> np.ndarray:
    """Shares of the words (or lines) of a whole text that have each shape; zeros without words."""
    words = text.split()
    if not words:
        return np.zeros(SHAPES)
    codes = np.frombuffer(text, np.uint8)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    inside = np.concatenate([[False], ~blank, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]

    def per_word(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[ends] - sums[starts]

    length = ends - starts
    upper = per_word((codes >= 65) & (codes <= 90))
    lower = per_word(((codes >= 97) & (codes <= 122)) | (codes >= 128))
    digits = per_word((codes >= 48) & (codes <= 57))
    marks = length - upper - lower - digits
    lines = [line for line in text.split(b"\n") if line.strip()]
    n = len(words)
    return np.array(
        [
            sum(map(eq, words, words[1:])) / n,
            np.count_nonzero((upper > 1) & (lower == 0)) / n,
            np.count_nonzero(digits) / n,
            np.count_nonzero(marks > 1) / n,
            np.count_nonzero(marks == length) / n,
            np.count_nonzero(length <= 2) / n,
            np.count_nonzero(length > 12) / n,
            1 - len(set(lines)) / len(lines),
            1 - len(set(words)) / n,
            len(lines) / n,
        ]
    )


def features(text: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram classes with dampened counts, and dampened shapes."""
    classes, counts = ngram_counts(text, settings.bits)
    return classes, np.log1p(counts), np.sqrt(shapes(text))


def _matrix(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], idf: np.ndarray, settings: Settings) -> np.ndarray:
    """Unit n-gram parts beside the weighted shapes."""
    size = 1 << settings.bits
    out = np.zeros((len(rows), size + SHAPES), np.float32)
    for i, (classes, counts, shape) in enumerate(rows):
        part = counts * idf[classes]
        norm = np.sqrt(part @ part)
        out[i, classes] = part / norm if norm else 0
        out[i, size:] = settings.shape_weight * shape
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The latent space and the labelled vectors, from at most ``per_label`` rows of each label 0 and 1.

    The keys with the smallest seeded hashes are taken; together they stand for
    all rows of their label, so that votes are not tilted. Only that bounded sample reaches the driver, as term vectors: one
    for each key and label, however often they repeat. Of texts that repeat a key, the smallest counts.
    Labels besides 0 and 1, and labels of documents that are missing or null, are left out.
    """
    known = labels.select(F.col(key).alias("key_"), F.col(label).cast("int").alias("label_")).where("key_ IS NOT NULL AND label_ IN (0, 1)")
    totals = dict(known.groupBy("label_").count().collect())
    drawn = known.distinct().withColumn("draw_", seeded(settings.seed, F.col("key_")))
    sample = None
    for value in sorted(totals):
        part = drawn.where(F.col("label_") == value).orderBy("draw_", "key_").limit(settings.per_label)
        sample = part if sample is None else sample.union(part)
    rows = [] if sample is None else _term_vectors(docs, kept(sample), settings, key, text)
    size = 1 << settings.bits
    if not rows:
        return Model(np.ones(size), np.zeros((size + SHAPES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), settings)
    rows.sort(key=lambda r: (r[0], r[1]))
    label_of = np.array([r[1] for r in rows])
    vectors = [r[2:] for r in rows]
    have = np.zeros(size)
    for classes, _, _ in vectors:
        have[classes] += 1
    idf = np.log((1 + len(rows)) / (1 + have)) + 0.1
    matrix = _matrix(vectors, idf, settings)
    space = _leading(matrix, min(settings.dimensions, *matrix.shape), settings.seed)
    taken = {v: max(1, int((label_of == v).sum())) for v in totals}
    weights = np.array([totals[v] / taken[v] for v in label_of])
    return Model(idf, space, _unit(matrix @ space), label_of.astype(float), weights / weights.sum(), settings)


def _term_vectors(docs: DataFrame, sample: DataFrame, settings: Settings, key: str, text: str) -> list[tuple]:
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, settings) for t in byte_texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *(pa.array([f[i].astype(kind).tobytes() for f in found], pa.binary()) for i, kind in enumerate(("<i4", "<f8", "<f8"))),
                ],
                names=["draw", "label", "classes", "counts", "shapes"],
            )

    texts = docs.select(F.col(key).alias("key_"), F.col(text).cast("string").alias("text_")).where("text_ IS NOT NULL")
    joined = texts.join(F.broadcast(sample), "key_")
    single = joined.groupBy("key_", "draw_", "label_").agg(F.min("text_").alias("text_")).select("draw_", "label_", "text_")
    table = single.mapInArrow(vectors, "draw long, label int, classes binary, counts binary, shapes binary")
    return [
        (r.draw, r.label, np.frombuffer(r.classes, "<i4"), np.frombuffer(r.counts, "<f8"), np.frombuffer(r.shapes, "<f8"))
        for r in table.collect()
    ]


def _leading(matrix: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a seeded start."""
    start = np.random.default_rng(seed).standard_normal((matrix.shape[0], min(matrix.shape[0], k + 16))).astype(np.float32)
    basis = matrix.T @ start
    for _ in range(4):
        basis = np.linalg.qr(matrix.T @ (matrix @ np.linalg.qr(basis)[0]))[0]
    _, _, rotated = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray((basis @ rotated.T)[:, :k])


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors of each text.

    A text without words, or like no labelled text, gets the share among all labels; 0.5 if
    nothing was learned. Neighbours at equal similarity are taken in the model's order.
    """
    if not len(model.labels):
        return np.full(len(texts), 0.5)
    prior = float(model.weights @ model.labels)
    out = np.empty(len(texts))
    for first in range(0, len(texts), BLOCK):
        block = texts[first : first + BLOCK]
        rows = [features(t, model.settings) for t in block]
        cosines = _unit(_matrix(rows, model.idf, model.settings) @ model.space) @ model.vectors.T
        k = min(model.settings.neighbours, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** model.settings.sharpness * model.weights[near]
        total = votes.sum(axis=1)
        share = np.divide((votes * model.labels[near]).sum(axis=1), total, out=np.full(len(block), prior), where=total > 0)
        wordless = [not t.strip() for t in block]
        out[first : first + BLOCK] = np.where(wordless, prior, share)
    return np.clip(out, 0.0, 1.0)


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``into``, 0 to 1: how likely label 1 is, from the whole text alone.

    A null text is scored as an empty one. Repeated rows get the same score; an empty table stays empty; a column
    named ``into`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scores([b"" if t is None else t.encode() for t in texts], shared.value))

    return docs.withColumn(into, score(F.col(text).cast("string")))

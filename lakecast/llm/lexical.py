"""Ranked lexical search over a length-stratified index.

A document's score depends on its length only by a normaliser m, so documents of equal m form a stratum. An index holds,
for each stratum, the postings of the terms by falling count (tf): all documents of a run of equal term, m and
tf get the same score from the term, which is computed once. The best run of each term
bounds what a stratum can score; strata are visited by falling bound, until no bound reaches the k-th result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakecast.llm.common import byte_texts, kept, stored
from lakecast.session import broadcast_if_small

#: Letters, digits and whatever is not ASCII make terms; only A to Z are lowered. UTF-8 has no other bytes below 128.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

#: The number of the pseudo-term whose count is a document's length.
LENGTH = -1


@dataclass(frozen=True)
class Ranking:
    """``k`` results an item. Pieces of a stratum hold about ``piece`` postings, a task's stripe of pieces about ``stripe``; ``items`` are asked together."""

    k: int = 50
    piece: int = 1 << 17
    stripe: int = 1 << 21
    items: int = 256


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a whole text, in order."""
    return text.translate(_TERM_BYTES).split() if text else []


def _counted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, id, n, term, tf`` of every document and distinct term, and a row with an empty term for its length."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column(2))
            at = 0
            while at < len(texts):
                # Rows out of about two megabytes of text at a time.
                which, lengths, terms, counts, size = [], [], [], [], 0
                while at < len(texts) and size < 1 << 21:
                    found = terms_of(texts[at])
                    if found:
                        size += len(texts[at])
                        held = Counter(found)
                        held[b""] = len(found)
                        which.append(at)
                        lengths.append((len(held), len(found)))
                        terms.extend(held)
                        counts.extend(held.values())
                    at += 1
                if not which:
                    continue
                repeats = np.array(lengths, np.int64)
                take = pa.array(np.repeat(np.array(which), repeats[:, 0]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(take),
                        batch.column(1).take(take),
                        pa.array(np.repeat(repeats[:, 1], repeats[:, 0])),
                        pa.array(terms, pa.binary()).cast(pa.string()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["row", "id", "n", "term", "tf"],
                )

    return rows.mapInArrow(count, "row long, id long, n long, term string, tf long")


def _asked_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item, term``: the distinct terms of each item."""
    kind = items.schema[item].dataType.simpleString()
    rows = items.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in byte_texts(batch.column(1))]
            take = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = pa.array([t for f in found for t in f], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), flat], names=["item", "term"])

    return rows.mapInArrow(split, f"item {kind}, term string").distinct()


def impact(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of ``weight`` adds to the score of a document that holds it ``tf`` times."""
    return weight * (1_000_000_000 * tf // (1000 * tf + 20 * m))


@dataclass
class Stripe:
    """Pieces of strata in one task: runs of (term, piece, tf) with their documents.

    ``terms`` are sorted; a term's runs are ``starts[i]`` to ``starts[i + 1]``, by piece, then rising tf. ``rate`` is a run's impact per unit of
    weight, ``last`` marks a term's best run in its piece.
    """

    ids: np.ndarray
    docs: np.ndarray
    pieces: int
    terms: np.ndarray
    starts: np.ndarray
    piece: np.ndarray
    rate: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple]) -> Stripe:
        """From pieces ``m, ids, term, tf, length, docs``, numbers packed in little-endian order."""
        ids, docs, runs, shift, offset = [], [], [], 0, 0
        for p, (m, own, *packed_runs, inside) in enumerate(rows):
            own = np.frombuffer(own, "<i8")
            term, tf, length = (np.frombuffer(x, "<i8") for x in packed_runs)
            ids.append(own)
            docs.append(np.frombuffer(inside, "<i4") + shift)
            ends = np.cumsum(length)
            runs.append(np.stack([term, np.full(len(term), p), tf, np.full(len(term), m), offset + ends - length, length]))
            shift += len(own)
            offset += len(docs[-1])
        term, piece, tf, m, start, length = np.concatenate(runs, axis=1)
        order = np.lexsort((tf, piece, term))
        term, piece, tf, m, start, length = (x[order] for x in (term, piece, tf, m, start, length))
        terms, starts = np.unique(term, return_index=True)
        last = np.append((term[1:] != term[:-1]) | (piece[1:] != piece[:-1]), True)
        rate = impact(np.ones_like(tf), tf, m)
        return cls(np.concatenate(ids), np.concatenate(docs), len(rows), terms, np.append(starts, len(term)), piece, rate, start, length, last)

    def _sums(self, docs: np.ndarray, gains: np.ndarray, exact: bool) -> np.ndarray:
        """What each document of the stripe gains; ``exact``: doubles hold every sum."""
        if exact:
            return np.bincount(docs, weights=gains, minlength=len(self.ids)).astype(np.int64)
        total = np.zeros(len(self.ids), np.int64)
        np.add.at(total, docs, gains)
        return total

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Keys and scores of the ``k`` best documents above zero that reach ``least``, ties to smaller keys, and how many pieces were visited."""
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        spans = [(self.starts[i], self.starts[i + 1], w) for i, w in zip(at[known], weights[known], strict=True) if w > 0]
        if not spans:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        runs = np.concatenate([np.arange(a, b) for a, b, _ in spans])
        gain = self.rate[runs] * np.repeat([w for *_, w in spans], [b - a for a, b, _ in spans])
        best = self.last[runs]
        bounds = np.zeros(self.pieces, np.int64)
        np.add.at(bounds, self.piece[runs][best], gain[best])
        order = np.argsort(-bounds, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        falling, by_visit = bounds[order], np.argsort(rank[self.piece[runs]], kind="stable")
        visit = rank[self.piece[runs]][by_visit]
        keys, scores, done, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, 4
        while done < self.pieces and falling[done] >= max(least, 1):
            if len(scores) == k and scores[-1] > falling[done]:
                break
            upto = min(self.pieces, done + step)
            take = by_visit[slice(*np.searchsorted(visit, [done, upto]))]
            length = self.length[runs[take]]
            ends = np.cumsum(length)
            places = np.repeat(self.offset[runs[take]] - ends + length, length) + np.arange(ends[-1])
            total = self._sums(self.docs[places], np.repeat(gain[take], length), exact=int(falling[0]) < 1 << 53)
            fits = np.flatnonzero(total >= max(least, 1, scores[-1] if len(scores) == k else 1))
            keys = np.concatenate([keys, self.ids[fits]])
            scores = np.concatenate([scores, total[fits]])
            top = np.lexsort((keys, -scores))[:k]
            keys, scores, done, step = keys[top], scores[top], upto, 2 * step
        return keys, scores, done


def _pieces(postings: DataFrame, ranking: Ranking) -> tuple[DataFrame, int]:
    """``stripe, m, ids, term, tf, length, docs``: strata in pieces, packed; postings lie by term and tf. And the number of stripes.

    A stratum is cut by rows' hashes into as many pieces as its postings need, and pieces are dealt to stripes by hash.
    """
    sizes = kept(postings.groupBy("m").agg(F.count(F.lit(1)).alias("postings")))
    total = sizes.agg(F.sum("postings")).first()[0] or 0
    stripes = max(1, -(-total // ranking.stripe))
    parts = sizes.select("m", F.ceil(F.col("postings") / ranking.piece).cast("long").alias("parts"))
    placed = postings.join(broadcast_if_small(parts), "m").select("m", F.pmod(F.xxhash64("row"), "parts").alias("part"), "row", "id", "term", "tf")

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        row, ids, term, tf = (group.column(c).to_numpy() for c in ("row", "id", "term", "tf"))
        _, first, doc = np.unique(row, return_index=True, return_inverse=True)
        order = np.lexsort((doc, tf, term))
        term, tf, doc = term[order], tf[order], doc[order]
        starts = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])))
        length = np.diff(np.append(starts, len(term)))
        packed_ = [x.astype("<i8").tobytes() for x in (ids[first], term[starts], tf[starts], length)]
        columns = [pa.array([key[0].as_py()], pa.int64()), *(pa.array([x], pa.binary()) for x in (*packed_, doc.astype("<i4").tobytes()))]
        return pa.Table.from_arrays(columns, names=["m", "ids", "term", "tf", "length", "docs"])

    packed_pieces = placed.groupBy("m", "part").applyInArrow(pack, "m long, ids binary, term binary, tf binary, length binary, docs binary")
    return packed_pieces.select(F.pmod(F.xxhash64("m", "ids"), F.lit(stripes)).alias("stripe"), "*"), stripes


def _searched(pieces: DataFrame, asked: DataFrame, stripes: range, ranking: Ranking) -> DataFrame:
    """``item, id, score``: the best documents of each stripe for each item. Each block of items in ``asked`` goes to every stripe."""
    kind = asked.schema["items"].dataType.elementType["item"].dataType.simpleString()
    tasks = max(1, asked.count() * len(stripes))
    units = (
        asked.select("items_block", "items", F.explode(F.sequence(F.lit(stripes[0]).cast("long"), F.lit(stripes[-1]).cast("long"))).alias("stripe"))
        .join(pieces, "stripe")
        .select("items_block", "stripe", "items", "m", "ids", "term", "tf", "length", "docs")
        .repartition(2 * tasks, "items_block", "stripe")
        .sortWithinPartitions("items_block", "stripe")
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, items, rows = None, None, []

        def answers() -> Iterator[pa.RecordBatch]:
            stripe = Stripe.of(rows)
            out_items, out_ids, out_scores = [], [], []
            for one in items.values.to_pylist() if items is not None else []:
                terms = np.array([t["term"] for t in one["terms"]], np.int64)
                weights = np.array([t["weight"] for t in one["terms"]], np.int64)
                keys, scores, _ = stripe.search(terms, weights, ranking.k, one["least"])
                out_items += [one["item"]] * len(keys)
                out_ids.append(keys)
                out_scores.append(scores)
            none = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_items, batch_kind), pa.array(np.concatenate([none, *out_ids])), pa.array(np.concatenate([none, *out_scores]))],
                names=["item", "id", "score"],
            )

        for batch in batches:
            batch_kind = batch.schema.field("items").type.value_type.field("item").type
            for i in range(batch.num_rows):
                now = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if now != place and rows:
                    yield from answers()
                    rows = []
                if now != place:
                    place, items = now, batch.column(2)[i]
                rows.append(tuple(batch.column(c)[i].as_py() for c in range(3, 9)))
        if rows:
            yield from answers()

    return units.mapInArrow(look, f"item {kind}, id long, score long")


def search(
    docs: DataFrame, items: DataFrame, ranking: Ranking = Ranking(), key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item, rank, key, score``: each item's ``k`` best documents with a score above zero, equal scores by rising key.

    Statistics (documents, lengths, term counts) are those of all documents; postings are kept of the terms that any item has.
    Terms are runs of ASCII letters and digits and of whatever is not ASCII; only A to Z are lowered.

    Nulls: a null or empty text has no terms, such documents count nowhere and such items have no results.
    A document without key counts in the statistics and is never returned. Rows that repeat a key are documents each. Rows
    that repeat an item's key ask for the terms of all of them together. Empty tables give no rows; other columns are ignored.
    """
    wanted = kept(_asked_terms(items, item, item_text))
    numbers = wanted.select("term").distinct().select("term", F.monotonically_increasing_id().alias("t"))
    spark = docs.sparkSession
    numbers = kept(numbers.union(spark.createDataFrame([("", LENGTH)], numbers.schema)))
    postings = _counted(docs, key, text).join(broadcast_if_small(numbers), "term")
    postings = stored(postings.select("row", "id", "n", F.col("t").alias("term"), "tf"), "postings")
    counts = kept(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")))
    whole = counts.where(F.col("term") == LENGTH).first()
    n_docs, n_terms = (whole["df"], whole["total"]) if whole else (0, 0)

    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = numbers.join(counts, numbers["t"] == counts["term"]).select(numbers["term"], "t", weight.alias("weight"))
    have = wanted.join(broadcast_if_small(kept(weights)), "term").groupBy("item").agg(F.collect_list(F.struct(F.col("t").alias("term"), "weight")).alias("terms"))
    have = kept(have)
    blocks = max(1, -(-have.count() // ranking.items))

    m = F.expr(f"50L + (50L * n * {n_docs}L) div {max(1, n_terms)}L")
    indexed = postings.where((F.col("term") != LENGTH) & F.col("id").isNotNull()).select("row", "id", m.alias("m"), "term", "tf")
    pieces, stripes = _pieces(indexed, ranking)
    pieces = stored(pieces, "index-pieces")

    def packed_items(rows: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("items_block")
        return kept(rows.groupBy(block).agg(F.collect_list(F.struct("item", "least", "terms")).alias("items")))

    # The first stripe's k-th result is a bound that the other stripes start from.
    first = packed_items(have.withColumn("least", F.lit(1).cast("long")))
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    found = kept(_searched(pieces, first, range(1), ranking))
    if stripes > 1:
        ranked = found.withColumn("rank", F.row_number().over(order))
        reached = ranked.where(F.col("rank") == ranking.k).select(F.col("item").alias("i"), F.col("score").alias("s"))
        rest = have.join(reached, F.col("item").eqNullSafe(F.col("i")), "left").select("item", "terms", F.coalesce("s", F.lit(1)).alias("least"))
        found = found.union(_searched(pieces, packed_items(rest), range(1, stripes), ranking))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranking.k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("id").alias(key), "score")

"""Hard negatives, MinHash near-duplicates and lexical search against plain Python on awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakecast.llm import lexical, minhash, negatives, topk
from lakecast.llm.blocks import LIMIT, NONE, Best, products, quantised
from lakecast.llm.common import kept
from tests.llm.brute import DOCS, awkward_documents, jaccard_components, near_copies, order


@pytest.fixture(scope="module")
def rows():
    return awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return kept(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- blocks -------------------------------------------------------------------------------


def test_products_are_exact_at_every_size():
    rng = np.random.default_rng(1)
    for most in (10, 1 << 26, 1 << 29, 1 << 40, LIMIT):
        left, right = (rng.integers(-most, most, (5, 7), endpoint=True) for _ in range(2))
        exact = [[sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for b in right] for a in left]
        assert products(left, right).tolist() == [[min(max(x, -LIMIT), LIMIT) for x in row] for row in exact]


def test_best_keeps_the_highest_with_ties_to_smaller_keys():
    rng = np.random.default_rng(2)
    best, seen = Best(4, 6), [[] for _ in range(4)]
    for _ in range(5):
        ids, scores = rng.choice(1000, 30, replace=False), rng.integers(0, 4, (3, 30))
        scores[rng.random((3, 30)) < 0.3] = NONE
        at = rng.permutation(4)[:3]
        best.add(at, ids, scores)
        for i, row in zip(at, scores, strict=True):
            seen[i] += [(-s, x) for s, x in zip(row, ids, strict=True) if s != NONE]
    query, ids, scores = best.found()
    for i in range(4):
        assert [(-s, x) for s, x in zip(scores[query == i], ids[query == i], strict=True)] == sorted(seen[i])[:6]


def test_scores_beyond_64_bits_are_clamped(spark):
    df = spark.createDataFrame([(0, [3e38, 1.0]), (1, [3e38, 2.0]), (2, [-3e38, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    sound = topk.quantised(df)
    got = [tuple(r) for r in topk.top_k(sound, sound.where("vec_id = 0"), k=3).collect()]
    assert got == [(0, 1, 1, LIMIT), (0, 2, 3, LIMIT), (0, 3, 2, -LIMIT)]


def test_few_candidates_of_skewed_vectors_are_scored():
    rng = np.random.default_rng(3)
    parts = rng.integers(-5, 6, (6000, 4))
    parts[rng.choice(6000, 40, replace=False)] *= 60
    lists, queries, scored = topk.Lists(np.arange(6000), parts), rng.integers(1, 4, (50, 4)), []
    counted = lists._scores
    lists._scores = lambda rows, q: scored.append(len(rows) * len(q)) or counted(rows, q)
    best = Best(50, 10)
    lists.search_all(queries, np.full(50, -1), best)
    assert sum(scored) < 50 * 6000 / 10
    exact = queries @ parts.T
    for q, row in enumerate(exact):
        top = sorted((-s, i) for i, s in enumerate(row))[:10]
        assert [(-s, i) for s, i in zip(best.scores[q], best.ids[q], strict=True)] == top


# --- hard negatives -----------------------------------------------------------------------


def hard_negatives(vectors, anchors, n_pos, n_neg, low):
    out = []
    for a, label, x in anchors:
        scored = sorted((-sum(u * v for u, v in zip(x, y, strict=True)), i, own) for i, own, y in vectors if i != a and len(x) == len(y))
        for p_score, p, _ in [s for s in scored if s[2] == label][:n_pos]:
            window = [(i, -s) for s, i, own in scored if own != label and low * -p_score <= 100 * -s <= 100 * -p_score]
            out += [(a, p, rank, i, -p_score, s) for rank, (i, s) in enumerate(window[:n_neg], 1)]
    return out


def test_hard_negatives_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, int(rng.integers(0, 4)), [float(v) for v in rng.integers(-3, 6, 5) / 16]) for i in range(400)]
    # A label with a third of the rows, copies, a vector of its own length, a lone label, rows that take no part.
    vectors += [(400 + i, 1, vectors[i % 7][2]) for i in range(150)]
    vectors += [(600, 9, [0.5] * 5), (601, 2, [1.0, 2.0]), (602, 1, [2.0, 2.0]), (700, None, [0.5] * 5), (800, 1, None), (801, 1, [])]
    vectors += [(900, 1, [None] * 5), (901, 1, [float("inf")] * 5), (902, 1, [float("nan")] * 5), (None, 1, [1.0] * 5), (20, 1, [0.5] * 5)]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, label int, embedding array<double>, rank string, slot int")
    sound = quantised(df, 256.0, label=F.col("label"))
    ints = [(i, own, [int(np.floor(256 * x)) for x in v]) for i, own, v in vectors if None not in (i, own) and v and None not in v and np.isfinite(v).all()]
    anchors = {}
    for i, own, v in ints:
        if i % 20 == 0:
            anchors[i] = min(anchors.get(i, (own, v)), (own, v))
    for low, n_pos, n_neg in ((80, 5, 5), (20, 3, 4)):
        found = negatives.hard_negatives(sound, sound.where("vec_id % 20 = 0"), n_pos, n_neg, low, candidates=64, per_block=7)
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        expected = hard_negatives(ints, [(i, *a) for i, a in anchors.items()], n_pos, n_neg, low)
        assert len(expected) > 100 and sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert negatives.hard_negatives(sound.limit(0), sound.limit(0)).count() == 0
    assert negatives.hard_negatives(sound, sound.where("vec_id = 600")).count() == 0


# --- MinHash ------------------------------------------------------------------------------


def test_minima_are_those_of_every_hash():
    rng = np.random.default_rng(5)
    rule = minhash.MinHash(bands=4, rows=3)
    sets = [rng.integers(0, 1 << 64, n, np.uint64) for n in (1, 5, 40_000, 3, 70_000, 2)]
    factors, offsets = minhash._family(rule)
    got = minhash.minima(sets, rule)
    for s, row in zip(sets, got, strict=True):
        x = s >> np.uint64(32)
        for a, b, low in zip(factors, offsets, row, strict=True):
            assert low == ((x * np.uint64(a) + np.uint64(b)) % (1 << 32)).min()
    assert (factors % 2 == 1).all() and len(np.unique(minhash.bands_of(got, rule))) == 6 * 4


def test_least_equal_leaves_room_for_chance():
    rule = minhash.MinHash()
    assert 0.6 * 250 < rule.least_equal < 0.7 * 250


@pytest.mark.parametrize("rule", [minhash.MinHash(), minhash.MinHash(small=3, block=8, hubs=1), minhash.MinHash(words=3, percent=60)])
def test_minhash_equals_all_pairs(spark, rows, docs, rule):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
    # A few groups of near copies, some of them chains whose ends are not similar, and templates with half their words alike.
    extra, at = [], 1000
    for group in range(4):
        base = rng.choices(vocabulary, k=60)
        for i in range(40):
            extra.append((at, near_copies(rng, base, rng.randint(0, 6)), "en", "a", 1, 1, "x", None))
            at += 1
        chain = list(base)
        for i in range(12):
            chain[rng.randrange(60)] = f"new{i}"
            extra.append((at, " ".join(chain), "en", "a", 1, 1, "x", None))
            at += 1
        for i in range(25):
            extra.append((at, " ".join(base[:40] + rng.choices(vocabulary, k=20)), "en", "a", 1, 1, "x", None))
            at += 1
    everything = rows + extra
    found = minhash.near_duplicates(spark.createDataFrame(everything, DOCS), rule)
    assert found.columns == ["doc_id", "n_shingles", "component", "kept"]
    got = [tuple(r) for r in found.collect()]
    expected = jaccard_components([(r[0], r[1]) for r in everything], rule.words, rule.percent)
    assert order(r[:3] for r in got) == order(expected)
    assert all(r[3] == (r[0] == r[2]) for r in got)


def test_minhash_of_an_empty_table(none):
    assert minhash.near_duplicates(none).count() == 0


# --- lexical search -----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, items, k):
    counted = [(i, Counter(terms(t))) for i, t in documents]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, c, n in counted:
            m = 50 + 50 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if c[t]
            )
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_terms_of_a_text():
    text = "Ab-c9_É? ß\x00x\x7fyİ z —it's"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)
    assert lexical.terms_of(None) == lexical.terms_of(b"") == lexical.terms_of(b" .,") == []


@pytest.mark.parametrize("ranking", [lexical.Ranking(k=5), lexical.Ranking(k=5, piece=40, stripe=300, items=4), lexical.Ranking(k=1000, piece=64, stripe=512)])
def test_search_equals_scores_of_all_documents(spark, rows, docs, none, ranking):
    items = [(i, " ".join(r[1].split()[:8]), 1) for i, r in enumerate(rows[:20])]
    items += [(100, None, 1), (101, "", 1), (102, "nothing of this", 1), (None, rows[4][1], 1), (3, rows[9][1], 1), (3, rows[9][1], 1), (103, rows[64 + 2][1], 1)]
    asked = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    found = [tuple(r) for r in lexical.search(docs, asked, ranking).collect()]
    expected = ranked([(r[0], r[1]) for r in rows], [i[:2] for i in items], ranking.k)
    assert order(found) == order(expected) and len(expected) > 50
    assert lexical.search(none, asked).count() == 0 and lexical.search(docs, asked.limit(0)).count() == 0


def test_strata_beyond_the_bound_are_not_visited():
    def piece(m, docs):
        runs = sorted({(t, tf) for _, held in docs for t, tf in held.items()})
        inside = [[i for i, (_, held) in enumerate(docs) if held.get(t) == tf] for t, tf in runs]
        numbers = ([i for i, _ in docs], [t for t, _ in runs], [tf for _, tf in runs], [len(x) for x in inside])
        return (m, *(np.array(x, "<i8").tobytes() for x in numbers), np.array([i for x in inside for i in x], "<i4").tobytes())

    rng = random.Random(7)
    rows = [piece(50 + 40 * p, [(100 * p + i, {0: rng.randint(1, 3), 1: 1}) for i in range(20)]) for p in range(40)]
    stripe = lexical.Stripe.of(rows)
    keys, scores, visited = stripe.search(np.array([0, 1, 7]), np.array([900, 500, 300]), 5, 1)
    assert len(keys) == 5 and visited < 20
    assert stripe.search(np.array([0, 1]), np.array([900, 500]), 5, int(scores[-1]) + 1)[2] <= visited
    every = stripe.search(np.array([0, 1]), np.array([900, 500]), 10_000, 1)
    assert len(every[0]) == 800 and list(every[0][:5]) == list(keys) and list(every[1][:5]) == list(scores)

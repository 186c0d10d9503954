"""Language mixtures, line templates and neighbour votes against plain Python, through the registered queries."""

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lakecast.llm import languages, neighbours, templates
from lakecast.llm.queries import QUERIES
from tests.llm.brute import language_mixture, learned_languages, order, template_lines, trigrams, words
from tests.oracle import TESTDATA


def documents(spark, sf):
    return spark.read.parquet(str(TESTDATA / sf / "documents.parquet"))


def speech(rng, seed, n):
    own = random.Random(seed)
    vocabulary = ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", k=own.randint(3, 8))) for _ in range(40)]
    return " ".join(rng.choices(vocabulary, k=n))


def test_mixtures_equal_plain_maximisation(spark):
    rows = documents(spark, "sf0.001").collect()
    rule = languages.Settings()
    learned = learned_languages([(r.text, r.lang) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2], rule.bits)
    found = {r.doc_id: r for r in QUERIES["op6_languages"](spark, str(TESTDATA / "sf0.001")).collect()}
    assert found.keys() == {r.doc_id for r in rows}
    for r in rows:
        if len(r.text or "") < 3000:
            shares = language_mixture(r.text, learned, rule.bits, rule.rounds, rule.penalty, rule.least_share)
            best = max(shares.items(), key=lambda item: item[1], default=("und", 0.0))
            assert found[r.doc_id].lang_pred == best[0] and found[r.doc_id].score == pytest.approx(best[1], abs=1e-3)


def test_mixed_texts_have_the_proportions_of_plain_maximisation(spark):
    rng = random.Random(4)
    rows = [(speech(rng, i % 6, 80), f"l{i % 6}") for i in range(120)]
    model = languages.train(spark.createDataFrame(rows, "text string, lang string"))
    rule = model.settings
    learned = learned_languages(rows, rule.bits)
    for parts in ((200,), (120, 90, 90), (100, 100, 50, 50), (300, 10)):
        text = " ".join(speech(rng, i, n) for i, n in enumerate(parts))
        assert languages.infer(text.encode(), model) == pytest.approx(language_mixture(text, learned, rule.bits, rule.rounds, rule.penalty, rule.least_share), abs=1e-3)


def test_known_mixtures_stay_and_unknown_languages_go(spark):
    rng = random.Random(5)
    taught = spark.createDataFrame([(speech(rng, i % 4, 80), f"l{i % 4}") for i in range(400)], "text string, lang string")
    model = languages.train(taught)
    texts = {
        "three": " ".join(speech(rng, i, n) for i, n in enumerate((120, 90, 90))),
        "four": " ".join(speech(rng, i, 80) for i in range(4)),
        "one": speech(rng, 2, 300),
        "word": speech(rng, 2, 1),
        "other": speech(rng, 99, 300),
        "script": "これは誰も教えなかった言語で書かれた文章です。" * 5,
        "digits": "12 34",
        "empty": "",
        "null": None,
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    assert {r.doc_id for r in languages.without_unidentified(df, model).collect()} == {"three", "four", "one", "word"}
    # Mean log-likelihood of an n-gram of the training texts, each of which weighs as one.
    rows = [(r.text, r.lang) for r in taught.collect()]
    chances, other = learned_languages(rows, model.settings.bits)["l0"]
    means = []
    for text, lang in rows:
        if lang == "l0":
            counts = trigrams(text, model.settings.bits)
            means.append(sum(n * math.log(chances.get(at, other)) for at, n in counts.items()) / sum(counts.values()))
    assert model.levels[0] == pytest.approx(sum(means) / len(means), abs=1e-3)
    # What few documents taught is no measure.
    few = languages.train(taught.limit(40))
    assert {r.doc_id for r in languages.without_unidentified(df, few).collect()} == texts.keys() - {"digits", "empty", "null"}


def test_line_dedup_equals_plain_loops_on_the_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, "sf0.01").collect()]
    place, recurring = {}, template_lines(rows, templates.Tree())
    for (doc, i), template in sorted(recurring.items(), key=lambda item: (item[0][0][0], item[0][1])):
        place.setdefault(template, (doc, i))
    drops = set(recurring) - set(place.values())
    expected = []
    for doc in rows:
        lines = (doc[1] or "").split("\n")
        gone = {i for i in range(len(lines)) if (doc, i) in drops}
        cut = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else doc[1]
        expected.append((doc[0], cut, len(gone), bool(gone) and not words(cut)))
    assert drops and order(map(tuple, QUERIES["op7_line_dedup"](spark, str(TESTDATA / "sf0.01")).collect())) == order(expected)


def plain_shapes(text):
    found, lines = text.encode().split(), [x for x in text.encode().split(b"\n") if x.strip()]
    if not found:
        return [0.0] * 10
    n, out = len(found), [0] * 7
    for w in found:
        upper, digits = len(re.findall(rb"[A-Z]", w)), len(re.findall(rb"[0-9]", w))
        lower = len(re.findall(rb"[a-z\x80-\xff]", w))
        marks = len(w) - upper - digits - lower
        for i, flag in enumerate((upper > 1 and not lower, digits, marks > 1, marks == len(w), len(w) <= 2, len(w) > 12)):
            out[i] += bool(flag)
    again = sum(a == b for a, b in zip(found, found[1:]))
    return [again / n, *(x / n for x in out[:6]), 1 - len(set(lines)) / len(lines), 1 - len(set(found)) / n, len(lines) / n]


def plain_vector(text, model, space):
    s = model.settings
    part = {at: math.log1p(n) * model.idf[at] for at, n in trigrams(text, s.bits).items()}
    norm = math.sqrt(sum(x * x for x in part.values())) or 1.0
    row = {at: x / norm for at, x in part.items()} | {2**s.bits + i: s.shape_weight * math.sqrt(x) for i, x in enumerate(plain_shapes(text))}
    latent = [0.0] * len(space[0])
    for at, x in row.items():
        latent = [a + x * b for a, b in zip(latent, space[at])]
    norm = math.sqrt(sum(x * x for x in latent)) or 1.0
    return [x / norm for x in latent]


def test_votes_equal_plain_ones(spark):
    sf_dir = str(TESTDATA / "sf0.001")
    docs, marks = documents(spark, "sf0.001"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = neighbours.fit(docs, marks.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    space, vectors = model.space.tolist(), model.vectors.tolist()
    rows = [r for r in docs.collect() if len(r.text or "") < 3000]
    # The labelled vectors are the labelled texts' own.
    own = [plain_vector(r.text or "", model, space) for r in rows]
    labelled = {r.doc_id for r in marks.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    for r, vector in zip(rows, own):
        if r.doc_id in labelled and words(r.text):
            assert max(sum(a * b for a, b in zip(vector, v)) for v in vectors) == pytest.approx(1.0, abs=1e-4)
    found = {r.doc_id: r.score for r in QUERIES["op8_neighbours"](spark, sf_dir).collect()}
    away = []
    for r, vector in zip(rows, own):
        cosines = sorted(((sum(a * b for a, b in zip(vector, v)), -i) for i, v in enumerate(vectors)), reverse=True)
        votes = {-i: max(c, 0.0) ** model.settings.sharpness * model.weights[-i] for c, i in cosines[: model.settings.neighbours]}
        share = sum(v * model.labels[i] for i, v in votes.items()) / sum(votes.values()) if words(r.text) else float(model.weights @ model.labels)
        away.append(abs(found[r.doc_id] - share))
    # Copies at equal similarity may stand in for each other at the edge.
    assert max(away) < 0.1 and sorted(away)[int(0.9 * len(away))] < 1e-3

"""The corpus pipeline, each stage against plain Python on what the stage before it kept."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lakecast.llm import languages, packing, templates
from lakecast.llm.common import kept
from tests.llm.brute import DOCS, awkward_documents, jaccard_components, near_copies, order, template_lines, words
from tests.llm.test_operators import water_fill


@pytest.fixture(scope="module")
def documents(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    rows = awkward_documents()
    for i in range(100, 140):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        rows.append((i, " ".join(base), "en", rng.choice("ab"), 1, 1, "x", None))
        rows.append((i + 100, near_copies(rng, base, rng.randint(0, 3)), "en", rng.choice("ab"), 1, 1, "x", None))
        rows.append((i + 200, "Share this page with all your friends\n" + " ".join(rng.choices(vocabulary, k=40)), "en", "c", 1, 1, "x", None))
    rows.append((500, "12 34 !!", "en", "a", 1, 1, "x", None))
    return kept(spark.createDataFrame(rows, DOCS))


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_equal_plain_python(spark, documents):
    docs, columns = documents, documents.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = kept(stage(spark, docs, ""))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert found[name].columns == columns
        docs = found[name]

    model = languages.train(documents)
    judged = {(r.doc_id, r.text): languages.judge(r.text.encode() if r.text else None, model) for r in documents.collect()}
    spoken = [p for p in pairs(documents) if judged[p][0] and judged[p][1] >= -1.5]
    assert order(pairs(found["language_id"])) == order(spoken) and 500 not in {d for d, _ in spoken}

    tree = templates.Tree()
    recurring = template_lines(spoken, tree)
    place = {}
    for at, template in sorted(recurring.items(), key=lambda item: (item[0][0][0] is None, item[0][0][0] or 0, item[0][1])):
        place.setdefault(template, at)
    drops = set(recurring) - set(place.values())
    cut = [(d, "\n".join(line for i, line in enumerate(t.split("\n")) if ((d, t), i) not in drops)) for d, t in spoken]
    cut = [(d, new) for (d, new), (_, old) in zip(cut, spoken, strict=True) if words(new) or not words(old)]
    assert order(pairs(found["line_dedup"])) == order(cut) and drops

    component = jaccard_components(cut, 5, 80)
    stays = pairs(found["near_duplicates"])
    named = [d for d, _ in stays if d is not None]
    assert sorted(named) == sorted({c for _, _, c in component if c is not None}) and set(stays) <= set(cut)
    assert len(stays) < len(cut) - 20

    sizes = {}
    for r in found["near_duplicates"].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
    targets = water_fill(sizes, (5, 2, 1), 1.5, 2.0)
    taken, times = dict.fromkeys(sizes, 0), {}
    for r in found["source_mix"].collect():
        taken[r.source] += len(words(r.text))
        times[r.doc_id, r.text] = times.get((r.doc_id, r.text), 0) + 1
    assert set(times) <= set(stays) and max(times.values()) <= 2
    longest = {s: max(len(words(r.text)) for r in found["near_duplicates"].collect() if r.source == s) for s in sizes}
    assert all(abs(taken[s] - targets[s]) <= max(60, longest[s] / 2) for s in sizes)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = sum(p.length for p in found["token_packing"].collect())
    ids = tokenizer.encode_batch([t for _, t in pairs(found["source_mix"])], add_special_tokens=False)
    assert packed == sum(len(i.ids) + 1 for i in ids)
    assert all(len(packing.unpacked(p.ids)) == p.length for p in found["token_packing"].limit(50).collect())


def test_stages_take_an_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "").count() == 0


def test_pipeline_is_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"] and rows.count() > 200

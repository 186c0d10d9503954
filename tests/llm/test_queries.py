"""The registered queries against their SQL, and the contracts of those without SQL, on the small tables."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakecast.llm.queries import ORACLES, QUERIES
from tests.llm.brute import jaccard_components, order, words
from tests.oracle import TESTDATA, connect, differences

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_base_statistics(spark):
    found = {r.doc_id: r for r in QUERIES["op1_outliers"](spark, SF_DIR).collect()}
    for row in documents(spark):
        own, lines = words(row.text), row.text.split("\n")
        seen, repeated = {}, set()
        for i in range(len(own) - 7):
            seen.setdefault(tuple(own[i : i + 8]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                repeated |= {p + k for p in places for k in range(8)}
        real = [line for line in lines if words(line)]
        expected = (
            len(own), sum(map(len, own)), sum(row.text.count(c) for c in "#*$%&|<>"), len(real) - len(set(real)), len(repeated),
        )
        got = found[row.doc_id]
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == expected
        assert got.base_failed == (len(own) < 20 or 100 * len(repeated) > 30 * len(own))
        assert not (got.base_failed and got.kept)


def test_pieces_are_the_tokenizer_s_ids(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = documents(spark)
    encoded = tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
    ids = {r.doc_id: [*e.ids, 2] for r, e in zip(rows, encoded, strict=True)}
    pieces = QUERIES["op3_packing"](spark, SF_DIR).collect()
    covered = {}
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
        assert p.length & (p.length - 1) == 0 and p.length <= 4096 and p.offset == 0
        assert p.doc_tokens == len(ids[p.doc_id])
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
    for doc_id, parts in covered.items():
        assert sorted(i for start, n in parts for i in range(start, start + n)) == list(range(len(ids[doc_id])))
    assert len({p.sequence_id for p in pieces}) == len(pieces) and covered.keys() == ids.keys()


def test_languages_of_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in documents(spark)}
    held_out = [r for r in QUERIES["op6_languages"](spark, SF_DIR).collect() if r.held_out]
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in held_out} == {2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in held_out)


def test_quality_of_held_out_documents(spark):
    sf_dir = str(TESTDATA / "sf0.1")
    label = dict(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").collect())
    rows = [r for r in QUERIES["op8_neighbours"](spark, sf_dir).collect() if r.held_out and r.doc_id in label]
    assert {zlib.crc32(str(r.doc_id).encode()) % 3 for r in rows} == {1}
    assert np.mean([r.predicted == label[r.doc_id] for r in rows]) > 0.95
    good, bad = ([r.score for r in rows if label[r.doc_id] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_jaccard_components(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark)]
    found = [tuple(r) for r in QUERIES["op9_jaccard"](spark, SF_DIR).select("doc_id", "n_shingles", "component_id").collect()]
    assert order(found) == order(jaccard_components(rows, 3, 90))

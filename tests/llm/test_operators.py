"""Each operator against plain Python on awkward rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakecast.llm import archive, jaccard, languages, mixing, neighbours, outliers, packing, sharding, templates, topk
from lakecast.llm.common import components, kept
from tests.llm.brute import DOCS, awkward_documents, jaccard_components, near_copies, order, template_lines, words


@pytest.fixture(scope="module")
def rows():
    return awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return kept(spark.createDataFrame(rows, DOCS))


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- outliers -----------------------------------------------------------------------------


def test_chi_square_limits():
    assert outliers.chi2_limit(0.95, 2) == pytest.approx(5.9915, abs=1e-3)
    assert outliers.chi2_limit(0.975, 6) == pytest.approx(14.449, abs=1e-3)


def test_outliers_reject_what_lies_far_off(spark):
    rng = random.Random(2)
    sound = [(i, " ".join(rng.choices(["lorem", "ipsum", "dolor", "sit", "amet,", "erat."], k=rng.randint(30, 200))), "la", "s") for i in range(300)]
    odd = [(1000 + i, " ".join(f"{w}$$$" for w in rng.choices(["lorem", "ipsum", "dolor"], k=60)), "la", "s") for i in range(40)]
    found = outliers.judge(spark.createDataFrame(sound + odd, "doc_id long, text string, lang string, source string")).collect()
    kept_of = {r.doc_id: r.kept for r in found if not r.base_failed}
    assert all(kept_of[i] for i in kept_of if i < 1000) and not any(kept_of[i] for i in kept_of if i >= 1000)
    assert sum(i >= 1000 for i in kept_of) > 30


def test_repeated_lines_or_words_alone_are_far_off(spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(500)]

    def prose(n):
        return "\n".join(" ".join(rng.choices(vocabulary, k=10)) for _ in range(n))

    menu = [" ".join(rng.choices(vocabulary, k=2)) for _ in range(12)]
    dull = "\n".join([*rng.choices(menu, k=285), *prose(3).split("\n")])
    passage = prose(2)
    again = "\n".join([prose(10), *[f"{passage} {prose(4)}" for _ in range(5)]])
    rows = [(i, prose(rng.randint(10, 60)), "en", "s") for i in range(200)]
    rows += [(200, f"{rows[0][1]}\n{rows[0][1][:59]}\n", "en", "s"), (1000, dull, "en", "s"), (1001, again, "en", "s")]
    found = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert found[200].n_dup_lines == 1 and not found[1000].base_failed and not found[1000].kept
    # Within the base rule, so only the distance can tell.
    assert found[1001].base_failed or not found[1001].kept
    assert all(found[i].kept for i in range(201))
    limit = outliers.chi2_limit(1 - outliers.Rules().tail, len(outliers.VECTOR))
    floors = dict(zip(outliers.VECTOR, outliers.Rules().floors, strict=True))
    most = outliers.vector((1000, 5000, 0, 950, 300, 1000, 0, 0, 0))
    assert all((most[outliers.VECTOR.index(x)] / outliers.UNIT / floors[x]) ** 2 > limit for x in ("dup_lines", "repeats"))


def test_mcd_equals_the_estimate_in_numpy(spark):
    rng = np.random.default_rng(3)
    p = len(outliers.VECTOR)
    x = np.rint(256 * rng.normal(size=(400, p)) @ np.diag([1, 2, 1, 0.5, 1, 1, 3])).astype(int)
    x[:60] += 5000
    rules = outliers.Rules(steps=3)
    frame = spark.createDataFrame([("c", *map(int, v)) for v in x], "cell string, " + ", ".join(f"x{i} long" for i in range(p)))
    got = outliers.mcd(frame, rules).first()
    values = x / 256

    def estimate(part, share):
        scatter = outliers._consistency(share) * np.cov(part.T, bias=True) + np.diag(np.square(rules.floors))
        return part.mean(axis=0), scatter

    def far(centre, scatter):
        away = values - centre
        return np.einsum("ij,jk,ik->i", away, np.linalg.inv(scatter), away)

    median = np.median(values, axis=0)
    mad = np.median(np.abs(values - median), axis=0) * 1.4826
    ends = []
    for centre, scatter in ((median, np.diag(mad**2 + np.square(rules.floors))), estimate(values, 1.0)):
        for _ in range(rules.steps):
            classes = np.floor(16 * np.log2(1 + 16 * far(centre, scatter)))
            counts = {c: int((classes < c).sum()) for c in set(classes)}
            inside = [counts[c] < (len(values) + p + 1) / 2 for c in classes]
            centre, scatter = estimate(values[inside], 0.5)
        ends.append((np.linalg.slogdet(scatter)[1], centre, scatter))
    _, centre, scatter = min(ends, key=lambda e: e[0])
    centre, scatter = estimate(values[far(centre, scatter) <= outliers.chi2_limit(0.975, p)], 0.975)
    assert np.allclose(got.centre, centre) and np.allclose(np.array(got.inverse).reshape(p, p), np.linalg.inv(scatter))
    assert np.abs(centre).max() < 0.5


def test_outliers_of_awkward_rows(docs, rows, none):
    found = outliers.judge(docs, outliers.Rules(least_rows=20)).collect()
    assert order((r.doc_id, r.n_words) for r in found) == order((r[0], len(words(r[1]))) for r in rows)
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 20)
    assert outliers.judge(none).count() == 0


# --- top k --------------------------------------------------------------------------------


def test_top_k_equals_all_products(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(v) for v in rng.integers(-3, 4, 6) / 16]) for i in range(300)]
    vectors += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (None, [1.0] * 6)]
    vectors += [(305, [0.0] * 6), (306, [1.0, 2.0]), (307, [3.0, 1.0]), (20, vectors[20][1])]
    df = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, rank string, score int")
    ints = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all()]
    sound = topk.quantised(df)
    got = [tuple(r) for r in topk.top_k(sound, sound.where("vec_id % 20 = 0 OR vec_id > 300"), k=5, candidates=64, per_block=7).collect()]
    expected = []
    for q, a in {i: v for i, v in ints if i % 20 == 0 or i > 300}.items():
        scored = sorted(((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in ints if i != q and len(a) == len(b)))
        expected += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert sorted(got) == sorted(expected)
    assert topk.top_k(sound.limit(0), sound.limit(0)).count() == 0


def test_threshold_with_exactly_k_candidates_met():
    # Sixteen rows lead each list, twelve of them both: exactly 20 are met, the last of them a high one.
    parts = np.zeros((200, 2), np.int64)
    parts[:12] = 50
    parts[12:16], parts[16:20] = (60, 0), (0, 120)
    parts[20:] = 45
    block = topk.Lists(np.arange(200), parts)
    rows, scores = block.search(np.array([1, 1]), -1, 20)
    assert sorted(scores, reverse=True) == sorted(parts.sum(axis=1), reverse=True)[:20]


def test_threshold_stops_before_the_lists_end():
    rng = np.random.default_rng(5)
    parts = rng.integers(-5, 6, (5000, 3))
    parts[:30] = 60
    lists = topk.Lists(np.arange(5000), parts)
    read = []
    scores = lists._scores
    lists._scores = lambda new, query: read.extend(new) or scores(new, query)
    lists.search(np.array([3, 2, 1]), own=-1, k=20)
    assert len(read) < 1000


# --- packing ------------------------------------------------------------------------------


def test_binary_pieces():
    assert packing.pieces_of(4096 * 2 + 5, 4096) == [(0, 4096), (4096, 4096), (8192, 4), (8196, 1)]
    assert packing.pieces_of(1, 4096) == [(0, 1)] and packing.pieces_of(0, 4096) == []


def test_packing_of_awkward_rows(spark, docs, rows, none, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["it's <|endoftext|>x İI ΑΣ é ́e a b c 12 !!!a", "tab\tform\fline\x0bend\x1cfs", "ﬁ ½ 한국어 日本語"]
    more = docs.union(spark.createDataFrame([(900 + i, t, "en", "a", 1, 1, "x", None) for i, t in enumerate(odd)], DOCS))
    pieces = packing.pack(more, path)
    tokenizer = Tokenizer.from_file(path)
    expected = sorted(
        str((d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for d, t in [(r[0], r[1]) for r in rows] + [(900 + i, t) for i, t in enumerate(odd)]
    )
    whole, length = [], 0
    # A document's pieces are neighbours in the order of the sequences.
    for p in sorted(pieces.collect(), key=lambda p: p.sequence_id):
        current = packing.unpacked(p.ids) if p.start == 0 else current + packing.unpacked(p.ids)
        assert len(packing.unpacked(p.ids)) == p.length
        if len(current) == p.doc_tokens:
            whole.append(str((p.doc_id, current)))
    assert sorted(whole) == expected
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets")).count() == pieces.count()
    assert packing.pack(none, path).count() == 0


# --- mixing -------------------------------------------------------------------------------


def water_fill(sizes, weights, share, epochs):
    order_ = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order_)}
    want, capped = share * sum(sizes.values()), set()
    while True:
        open_ = [s for s in order_ if s not in capped]
        level = (want - sum(epochs * sizes[s] for s in capped)) / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > epochs * sizes[s]}
        if not above:
            return {s: epochs * sizes[s] if s in capped else weight[s] * level for s in order_}
        capped |= above


def test_mixing_of_awkward_rows(docs, rows, none):
    found = mixing.repetitions(docs)
    assert found.columns == [*docs.columns, "size_", "source_size", "target", "times_"]
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    targets = water_fill(sizes, (5, 2, 1), 1.5, 2.0)
    taken = dict.fromkeys(sizes, 0)
    got = found.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["size_"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]]) and 0 <= r["times_"] <= 2
        taken[r["source"]] += r["size_"] * r["times_"]
    longest = {s: max(len(words(r[1])) for r in rows if r[3] == s) for s in sizes}
    for source in sizes:
        # Documents are taken whole, so one that is most of its source may miss by half.
        assert abs(taken[source] - targets[source]) <= max(60, longest[source] / 2)
    assert order(map(str, mixing.repetitions(docs.repartition(7)).collect())) == order(map(str, got))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times_"] for r in got)
    assert mixing.mixed(none).count() == 0


# --- archive ------------------------------------------------------------------------------


def test_archive_gives_back_every_record(spark, tmp_path):
    pages = [(1, "http://a", "<p>x</p>"), (2, "http://b\r\nX: y", "<p>x</p>"), (3, None, None), (4, "u", ""), (None, "n", "<p>x</p>"), (5, "u", "é" * 300_000), (0, "u", "only"), (7, "u", "only"), (7, "u", "only")]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, digest string, payload int")
    store = archive.Archive(str(tmp_path / "w"), least_bytes=0)
    archive.write(df, store)
    records = archive.read(spark, store).collect()
    assert len(records) == len(pages)
    payload = {p[0]: (p[2] or "").encode() for p in pages}
    import base64

    for r in records:
        assert r.payload == payload[r.page_id] and r.payload_bytes == len(r.payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
        block = b"" if r.record_type == "revisit" else r.payload
        assert bytes(r.record) == bytes(r.header) + block + b"\r\n\r\n"
        assert f"Content-Length: {len(block)}\r\n".encode() in r.header and b"\nX: y" not in r.header
    kind = {r.page_id: (r.record_type, r.refers_to) for r in records}
    assert kind == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("revisit", 3), None: ("revisit", 1), 5: ("response", None), 0: ("response", None), 7: ("revisit", 0)}
    assert archive.payloads(spark, store).count() == 4
    large = archive.Archive(str(tmp_path / "l"), least_bytes=5)
    archive.write(df, large)
    assert {r.page_id: r.record_type for r in archive.read(spark, large).collect()}[7] == "response"
    archive.write(df.limit(0), archive.Archive(str(tmp_path / "e")))
    assert archive.read(spark, archive.Archive(str(tmp_path / "e"))).count() == 0


def test_archive_notices_damage(spark, tmp_path):
    store = archive.Archive(str(tmp_path / "w"))
    archive.write(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"), store)
    import zstandard

    bad = spark.read.parquet(store.payloads).withColumn("packed", F.lit(zstandard.compress(b"other"))).collect()
    spark.createDataFrame(bad, "digest string, packed binary").write.mode("overwrite").parquet(store.payloads)
    with pytest.raises(Exception, match="does not match its digest"):
        archive.read(spark, store).collect()


# --- languages ----------------------------------------------------------------------------


def test_mixture_finds_both_languages(spark):
    rng = random.Random(6)
    say = {"a": ["bado", "kedo", "lido", "moda"], "b": ["strumpf", "schrank", "pflug", "zwerg"]}
    def text(lang, n):
        return " ".join(rng.choices(say[lang], k=n))
    df = spark.createDataFrame([(text(lang, 50), lang) for lang in "ab" for _ in range(30)] + [(None, "a"), ("", "b"), ("12 34", "b"), ("bado", None)], "text string, lang string")
    model = languages.train(df)
    assert model.names == ("a", "b")
    both = languages.infer((text("a", 140) + " " + text("b", 60)).encode(), model)
    assert list(both) and set(both) == {"a", "b"} and 0.1 < both["b"] < 0.9
    assert languages.infer(text("a", 100).encode(), model) == {"a": 1.0}
    assert languages.infer(b"12 ... !", model) == {} and languages.infer(None, model) == {} and languages.infer("日本".encode(), model)


def test_languages_of_awkward_rows(docs, rows, none):
    model = languages.train(docs)
    found = languages.identify(docs, model, into="times").select("doc_id", "text", "times.lang", "times.score").collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.lang == "und") == (not any(map(str.isalpha, r.text or ""))) and 0 <= r.score <= 1
    assert languages.train(none).names == () and languages.identify(none, model).count() == 0
    assert languages.without_unidentified(docs, model, -np.inf).count() == sum(r.lang != "und" for r in found)


def test_many_values_of_lang_stop_nothing(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def speech(i, n=60):
        own = random.Random(i)
        vocabulary = ["".join(own.choices(letters, k=own.randint(3, 8))) for _ in range(40)]
        return " ".join(rng.choices(vocabulary, k=n))

    rows = [(k, speech(k % 600), f"l{k % 600:03}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.train(docs)
    assert len(model.names) == 600
    assert sum(next(iter(languages.infer(speech(i).encode(), model))) == f"l{i:03}" for i in range(0, 600, 20)) == 30
    mixed = languages.infer(" ".join(speech(i, n) for i, n in ((5, 160), (205, 120), (405, 120))).encode(), model)
    assert set(mixed) == {"l005", "l205", "l405"} and next(iter(mixed)) == "l005"
    # Beyond the bound, the values that most documents have are learned.
    often = docs.union(docs.where("lang < 'l010'"))
    assert languages.train(often, languages.Settings(languages=10)).names == tuple(f"l{i:03}" for i in range(10))
    # Languages that cannot be told apart all stay candidates.
    same = spark.createDataFrame([(i, "the same words", f"s{i:03}") for i in range(130)], "doc_id long, text string, lang string")
    assert next(iter(languages.infer(b"the same words", languages.train(same)))) in {f"s{i:03}" for i in range(130)}


# --- line dedup ---------------------------------------------------------------------------


def test_recurring_templates_equal_plain_loops(spark):
    rng = random.Random(7)
    prose = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta"]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choices(prose, k=rng.randint(1, 12))) for _ in range(6)]
        lines.insert(rng.randint(0, 6), f"Page served at {rng.randint(0, 99)}:00 for user {rng.choice(['ann', 'bob', 'cy'])}{rng.randint(0, 9)} from our main site")
        if i % 3 == 0:
            lines.append(f"Posted by {rng.choice(prose)}{'x' * i} in the weekly news of this town")
        if i % 2:
            lines.append("All rights reserved.")
        rows.append((i, "\n".join(lines)))
    rows += [(None, rows[0][1]), rows[1], (70, None), (71, ""), (72, "\n\n"), (73, "  All   rights\treserved. ")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, emptied string")
    tree = templates.Tree(documents=4)
    expected = template_lines(rows, tree)
    got = templates.recurring_lines(df, tree).collect()
    text_of = {}
    for r in df.select("doc_id", F.xxhash64("text").alias("h"), "text").collect():
        text_of[r.doc_id, r.h] = r.text
    assert {((r.id, text_of[r.id, r.hash]), r.line_no) for r in got} == expected.keys()
    assert len({(r.id, r.hash, r.line_no) for r in got if r.first}) == len(set(expected.values()))
    dropped = {((r.id, text_of[r.id, r.hash]), r.line_no) for r in got if not r.first}
    out = templates.drop_recurring(df, tree)
    assert out.columns == ["doc_id", "text", "emptied", "lines_dropped", "emptied_"]
    result = [(r.doc_id, r.text) for r in out.collect()]
    plain = [
        (d, None if t is None else "\n".join(line for i, line in enumerate(t.split("\n")) if ((d, t), i) not in dropped)) for d, t in rows
    ]
    assert order(result) == order(plain)


def test_line_dedup_keeps_one_of_many_copies(spark, none):
    text = "one two three four five six\nseven eight nine ten eleven twelve"
    out = templates.drop_recurring(spark.createDataFrame([(i, text) for i in range(30)], "doc_id long, text string")).collect()
    assert [r.doc_id for r in out if r.text == text] == [0]
    assert all(r.emptied and r.lines_dropped == 2 for r in out if r.doc_id)
    assert templates.drop_recurring(none).count() == 0


@pytest.mark.parametrize("n", [100, 1000, 10_000])
def test_word_fields_are_fields_at_every_size(spark, n):
    rng = random.Random(n)
    letters = "abcdefghij"
    values = [f"{a}{b}" for a in letters for b in letters]

    def line(i):
        # One document in twenty has a smaller template, which shares leaf and field values with the large one.
        by = "courier today" if i % 20 == 0 else "mail again"
        return f"The weekly report for {rng.choice(values)}town was sent to {rng.choice(values)}son by {by}"

    rows = [(i, f"{line(i)}\nnote{chr(97 + i % 26)} {'x' * (i % 50)}") for i in range(n)]
    got = templates.recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, r.line_no) for r in got} == {(i, 0) for i in range(n)}
    assert sum(r.first for r in got) == 2


def test_lines_with_digits_recur_alike(spark):
    table = " ".join(str(i * i) for i in range(30)) + " sum of squares"
    alike = ["Licensed under CC BY-NC 4.0.", "Page 3 of 10", table]
    rows = [(i, "\n".join([f"own{'x' * i} words", *alike, f"Chapter {i} of 10"])) for i in range(5)]
    rows += [(10 + i, f"own{'y' * i} words\nPage 4 of 10") for i in range(4)]
    got = templates.recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, r.line_no) for r in got} == {(i, k) for i in range(5) for k in (1, 2, 3)}
    assert {(r.id, r.line_no) for r in got if r.first} == {(0, 1), (0, 2), (0, 3)}


def test_long_lines_recur_from_two_documents_on(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    short = " ".join(passage.split()[:49])
    rows = [(1, f"one own line\n{passage}\n{short}"), (2, f"  {passage}\nother own text\n{short}"), (3, f"{passage} 1"), (4, f"{passage} 2")]
    rows += [(5, f"whole copies {passage}"), (6, f"whole copies {passage}")]
    out = templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string"))
    changed = {r.doc_id: r.text for r in out.collect() if r.lines_dropped}
    assert changed == {2: f"other own text\n{short}"}


# --- neighbours ---------------------------------------------------------------------------


def test_neighbours_separate_labels(spark, docs, none):
    rng = random.Random(8)
    good = [(i, " ".join(rng.choices(["stone", "river", "meadow", "cloud"], k=40)), 1) for i in range(60)]
    bad = [(100 + i, " ".join(rng.choices(["BUY!!", "NOW!!", "CHEAP!!"], k=40)), 0) for i in range(30)]
    df = spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in good[::2] + bad[::2]] + [(1, None), (None, 1), (999, 0), (2, 7)], "doc_id long, quality int")
    model = neighbours.fit(df, labels, neighbours.Settings(per_label=20))
    assert len(model.labels) <= 40
    found = neighbours.scored(df, model).collect()
    assert all((r.quality_score >= 0.5) == (r.doc_id < 100) for r in found)
    awkward = neighbours.scored(docs, model, into="times").collect()
    prior = float(model.weights @ model.labels)
    assert all(r.times == pytest.approx(prior) for r in awkward if not words(r.text)) and all(0 <= r.times <= 1 for r in awkward)
    empty = neighbours.fit(df, labels.limit(0))
    assert {r.quality_score for r in neighbours.scored(df, empty).collect()} == {0.5}
    assert neighbours.scored(none, model).count() == 0


def test_blocked_products_equal_single_ones(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["aa", "bb", "cc", "dd", "ee", "FF"], k=30))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    model = neighbours.fit(df, labels)
    texts = [t.encode() for _, t in rows]
    together = neighbours.scores(texts, model)
    assert np.allclose(together, [neighbours.scores([t], model)[0] for t in texts], atol=1e-4)


def test_repeated_keys_do_not_widen_the_sample(spark):
    texts = [(1, f"good words number {i}", ) for i in range(5000)] + [(i, f"bad stuff {i}") for i in range(2, 40)]
    labels = [(1, 1)] * 5000 + [(i, 0) for i in range(2, 40)] + [(2, 1), (2, 0)]
    docs, marks = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = neighbours.fit(docs, marks, neighbours.Settings(per_label=10))
    assert len(model.vectors) <= 20 and sorted(set(model.labels)) == [0.0, 1.0]
    # Votes still stand for all rows of their label.
    assert model.weights[model.labels == 1].sum() == pytest.approx(5001 / 5040)


# --- Jaccard join -------------------------------------------------------------------------


@pytest.mark.parametrize("join", [jaccard.Join(), jaccard.Join(words=5, percent=80), jaccard.Join(words=1, percent=60), jaccard.Join(rare=2, small=1, block=3)])
def test_jaccard_of_awkward_rows(spark, rows, docs, join):
    found = [tuple(r) for r in jaccard.linked(docs, join).collect()]
    assert order(found) == order(jaccard_components([r[:2] for r in rows], join.words, join.percent))


@pytest.mark.parametrize("rare", [2, 8, 256])
@pytest.mark.parametrize(("words_", "percent"), [(3, 90), (5, 80)])
def test_jaccard_of_near_copies(spark, rare, words_, percent):
    rng = random.Random(10 * rare + percent)
    vocabulary = ["".join(rng.choices("abcdefg", k=5)) for _ in range(200)]
    rows = []
    for n in (12, 40, 150, 700):
        base = rng.choices(vocabulary, k=n)
        for _ in range(25):
            rows.append((rng.randrange(10**6), near_copies(rng, base, rng.randint(0, max(1, n // 60)))))
            rows.append((rng.randrange(10**6), " ".join([*base[: n // 2], *rng.choices(vocabulary, k=n // 2)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    join = jaccard.Join(words=words_, percent=percent, rare=rare, small=rare, block=7)
    found = [tuple(r) for r in jaccard.linked(df, join).collect()]
    expected = jaccard_components(rows, words_, percent)
    assert order(found) == order(expected)
    assert len({r[2] for r in expected}) < len(expected) - 40
    stays = [r.doc_id for r in jaccard.one_of_each(df, join).collect()]
    assert sorted(stays) == sorted({r[2] for r in expected})


def test_block_links_hold_together_what_all_links_do():
    rng = np.random.default_rng(11)
    base = rng.integers(0, 10**9, 60)
    sets = [np.unique(np.concatenate([rng.choice(base, 55, replace=False), rng.integers(0, 10**9, rng.integers(0, 6))])) for _ in range(40)]
    alike = {(i, j) for i in range(40) for j in range(40) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}

    def groups(edges, nodes):
        root = {n: n for n in nodes}
        for a, b in list(edges) * len(nodes):
            root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(jaccard.holding_links(sets, None, 85), range(40)) == groups(alike, range(40))
    across = {(i, j) for i, j in alike if i < 25 <= j}
    found = jaccard.holding_links(sets[:25], sets[25:], 85)
    assert set(found) <= across and groups(found, range(40)) == groups(across, range(40)) and len(found) < 40


def test_large_buckets_of_documents_that_only_share_a_passage(spark, monkeypatch):
    rng = random.Random(5)
    own = lambda n: ["".join(rng.choices("abcdefghij", k=7)) for _ in range(n)]
    passage = own(140)
    rows = [(i, " ".join([*passage, *own(100)])) for i in range(60)]
    rows += [(100 + i, f"{rows[0][1]} {i}") for i in range(20)]
    read, stored = {}, jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, name: (out := stored(df, name), read.update({name: out.count()}))[0])
    found = [tuple(r) for r in jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert order(found) == order(jaccard_components(rows, 3, 90))
    # Whole sets are only compared of the copies; the other documents share their large buckets, and no more.
    assert read["sets"] == 21 and read["blocks"] == 1


@pytest.mark.parametrize("percent", [90, 60])
def test_sketches_never_part_similar_sets(percent):
    rng, join = np.random.default_rng(percent), jaccard.Join(percent=percent)
    for n in (1, 7, 60, 1500):
        base = [rng.integers(0, 1 << 64, n, np.uint64) for _ in range(3)]
        sets = [np.unique(np.concatenate([b[rng.permutation(n)[k // 2 :]], rng.integers(0, 1 << 64, k, np.uint64)])) for b in base for k in range(0, n // 3 + 1, n // 25 + 1)]
        sketches = [jaccard.sketch(s, join) for s in sets]
        words = min(map(len, sketches))
        root = jaccard.hanging_together(np.array([len(s) for s in sets]), np.array([jaccard._folded(s, words) for s in sketches]), join)
        alike = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= percent * len(np.union1d(sets[i], sets[j]))]
        assert all(root[i] == root[j] for i, j in alike)
        assert len(set(root)) >= 3 or n < 7


def test_one_of_each_with_repeated_rows(docs, rows, none):
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    expected = jaccard_components([r[:2] for r in rows], 3, 90)
    assert sorted(i for i in ids if i is not None) == sorted({r[2] for r in expected if r[2] is not None})
    assert jaccard.one_of_each(none).count() == 0 and jaccard.linked(none).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 100)] + [(900, 901), (901, 900), (900, 900)]
    random.Random(1).shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(500, 600), 500), 900: 900, 901: 900}


# --- sharding -----------------------------------------------------------------------------


def test_interleaving_of_awkward_rows(docs, rows, none):
    found = sharding.interleave(docs.select("doc_id", "source", "text", "size"), 8, cells=16).collect()
    counts, slots = {}, {}
    for r in found:
        counts.setdefault(r.shard, []).append(r.source)
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in counts.values()]
    assert len(found) == len(rows) and sorted(counts) == list(range(8)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    for source in {r[3] for r in rows}:
        own = [v.count(source) for v in counts.values()]
        assert max(own) - min(own) <= 2
    again = sharding.interleave(docs.select("doc_id", "source", "text", "size").repartition(5), 8, cells=4096).collect()
    assert order(map(str, again)) == order(map(str, found))
    assert sharding.interleave(none, 8).count() == 0
    assert {r.shard for r in sharding.interleave(docs.limit(3), 8).collect()} == {0, 2, 5}


def test_many_small_sources_are_ranked_in_even_ranges(spark):
    # All rows of one-row sources have the same place; one source holds a third of all rows.
    rows = [(i, f"site {i % 20_000}" if i < 20_000 else "hot", "x", i) for i in range(30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, cell_ string, n_ int")
    found = sharding.interleave(frame, shards=8, range_rows=3000)
    assert found.columns == ["doc_id", "source", "cell_", "n_", "draw", "shard", "slot"]
    got = found.collect()
    assert sorted(r.doc_id for r in got) == list(range(30_000)) and all(r.cell_ == "x" and r.n_ == r.doc_id for r in got)
    for shard in range(8):
        own = [r for r in got if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(3750))
    # The hot source lies evenly along the order; the places of the others are all in the middle.
    assert [sum(r.source == "hot" for r in got if r.shard == shard) for shard in (0, 1, 6, 7)] == [3750, 1250, 1250, 3750]
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert max(s["count"] for s in sizes) < 3 * 3000


class _Counted:
    """A pattern that counts its calls."""

    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def findall(self, text):
        self.calls += 1
        return self.pattern.findall(text)


def test_plain_words_are_cut_many_at_once():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    texts = [" ".join(f"Wörd{i * j}ing,n{j}" for j in range(40)) for i in range(50)] + ["it's 日本 plain", None, "ÉÀ -- 'tis <b> Σ", ""]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for kept in (400_000, 3, 0):
        ids = packing.WordIds(path, kept)
        counted = ids._pattern = _Counted(ids._pattern)
        assert [i.tolist() for i in ids(pa.array(texts))] == want and len(ids._place) <= kept
        # About 2,000 words, and one call.
        assert counted.calls == 1
    # A pattern that would take a line's end into a part is not used.
    ids = packing.WordIds(path)
    ids._pattern = re.compile(r"[^a]+|\n")
    assert [i.tolist() for i in ids(pa.array(texts))] == want

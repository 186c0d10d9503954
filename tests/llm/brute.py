"""Small tables with every awkward case, and slow versions of the operators in plain Python."""

from __future__ import annotations

import math
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, size long, shard int, times string, node string"


def words(text):
    return WORD.findall(text or "")


def awkward_documents(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty and very long texts, equal texts, repeated rows, extra columns."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéöñ", k=rng.randint(1, 7))) for _ in range(80)]
    rows = []

    def add(doc_id, text, lang="en", source="a"):
        rows.append((doc_id, text, lang, source, 5, 1, "x", None))

    for i in range(60):
        add(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60))), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "ß", None]))
    add(60, None)
    add(61, "")
    add(62, " \t\n ")
    add(None, "a text without a key")
    add(None, rows[3][1])
    add(63, rows[3][1])
    add(64, "\n".join(" ".join(rng.choices(vocabulary, k=30)) for _ in range(600)), "fr", "b")
    add(65, rows[5][1].upper(), None, None)
    rows += [rows[7], rows[7]]
    return rows


def jaccard_components(rows: list[tuple], n_words: int, percent: int) -> list[tuple]:
    """(doc_id, shingles, component) of ``rows`` of (doc_id, text), all pairs compared."""
    sets = []
    for _, text in rows:
        found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(text)]
        sets.append({tuple(found[i : i + n_words]) for i in range(max(1, len(found) - n_words + 1))} if found else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        key = (doc_id is None, doc_id or 0)
        best[find(i)] = min(best.get(find(i), key), key)
    return [
        (doc_id, len(sets[i]), doc_id if not sets[i] else (None if best[find(i)][0] else best[find(i)][1]))
        for i, (doc_id, _) in enumerate(rows)
    ]


def near_copies(rng: random.Random, base: list[str], edits: int) -> str:
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = "".join(rng.choices("xyzw", k=6))
    return " ".join(out)


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def trigrams(text, bits):
    """{class: count} of the byte trigrams of a text in lower case, blanks at its ends."""
    plain = bytes(32 if 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in b" " + text.encode() + b" ")
    counts = {}
    for a, b, c in zip(plain, plain[1:], plain[2:]):
        at = (a * 65536 + b * 256 + c) * 2654435761 % 2**32 >> 32 - bits
        counts[at] = counts.get(at, 0) + 1
    return counts


def learned_languages(rows, bits):
    """{language: ({class: chance}, chance of all others)} from (text, language)."""
    sums = {}
    for text, lang in rows:
        if lang is not None and any(map(str.isalpha, text or "")):
            counts, own = trigrams(text, bits), sums.setdefault(lang, {})
            for at, n in counts.items():
                own[at] = own.get(at, 0) + n / sum(counts.values())
    learned = {}
    for lang, own in sums.items():
        more = 1e-4 * sum(own.values()) / 2**bits
        total = sum(own.values()) + more * 2**bits
        learned[lang] = ({at: (x + more) / total for at, x in own.items()}, more / total)
    return learned


def language_mixture(text, learned, bits, rounds, penalty, least_share):
    """{language: proportion} by expectation-maximisation, the set by penalised likelihood."""
    if not any(map(str.isalpha, text or "")):
        return {}
    counts = trigrams(text, bits)
    n = sum(counts.values())

    def maximised(langs, rounds):
        shares = dict.fromkeys(langs, 1 / len(langs))
        rows = [(count, [learned[lang][0].get(at, learned[lang][1]) for lang in langs]) for at, count in counts.items()]
        for _ in range(rounds):
            new = [0.0] * len(langs)
            for count, chances in rows:
                parts = [shares[lang] * p for lang, p in zip(langs, chances)]
                whole = sum(parts)
                new = [x + count * part / whole for x, part in zip(new, parts)]
            shares = {lang: x / n for lang, x in zip(langs, new)}
        return shares, sum(count * math.log(sum(shares[lang] * p for lang, p in zip(langs, chances))) for count, chances in rows)

    shares, _ = maximised(sorted(learned), rounds)
    ranked = sorted(shares, key=lambda lang: -shares[lang])
    cost = penalty * math.log(n + 1)
    best, likelihood = maximised(ranked[:1], 0)
    likelihood -= cost
    for k in range(2, len(ranked) + 1):
        if shares[ranked[k - 1]] < least_share:
            break
        own, more = maximised(ranked[:k], rounds)
        if more - k * cost <= likelihood:
            break
        best, likelihood = own, more - k * cost
    return best


def template_lines(rows, tree):
    """Recurring lines of (doc_id, text): {((doc_id, text), line number): template}, by plain loops."""
    lines, docs_of_leaf = [], {}
    for doc in {(r[0], r[1]) for r in rows if r[1] is not None}:
        for i, line in enumerate(doc[1].split("\n")):
            raw = tuple(words(line))
            if len(raw) >= tree.fixed:
                masked = tuple("<*>" if re.search("[0-9]", t) else t for t in raw)
                leaf = (len(raw), masked[: tree.depth])
                lines.append((doc, i, raw, masked, leaf))
                docs_of_leaf.setdefault(leaf, set()).add(doc)
    shared = [line for line in lines if len(docs_of_leaf[line[4]]) >= tree.documents]
    docs_of = {}
    for doc, _, _, masked, _ in shared:
        docs_of.setdefault(masked, set()).add(doc)

    def leaf_of(masked):
        return len(masked), masked[: tree.depth]

    def proposals(masked, have, least):
        n = len(masked)
        parts = {p: have[leaf_of(masked), p, t] for p, t in enumerate(masked) if t != "<*>" and have[leaf_of(masked), p, t] >= least}
        needed = max(tree.fixed_of_fields, math.ceil(tree.share * n))
        cuts = [tree.documents]
        if len(parts) >= needed:
            measure = sorted(parts.values(), reverse=True)[needed - 1]
            cuts = [tree.even * measure, measure, tree.documents]
        elif len(parts) < n:
            return []
        out = []
        for cut in cuts:
            fixed = {p for p, count in parts.items() if count >= cut}
            template = (leaf_of(masked), tuple(t if p in fixed else "<*>" for p, t in enumerate(masked)))
            if (len(fixed) >= needed or len(fixed) == n) and template not in out:
                out.append(template)
        return out

    template_of, rest, least = {}, set(docs_of), tree.documents
    while rest:
        have = {}
        for masked in rest:
            for p, t in enumerate(masked):
                have[leaf_of(masked), p, t] = have.get((leaf_of(masked), p, t), 0) + len(docs_of[masked])
        proposed = {masked: proposals(masked, have, least) for masked in rest}
        docs_of_template = {}
        for masked, templates in proposed.items():
            for template in templates:
                docs_of_template.setdefault(template, set()).update(docs_of[masked])
        recurring = {t for t, docs in docs_of_template.items() if len(docs) >= tree.documents} | set(template_of.values())
        chosen = {m: next(t for t in ts if t in recurring) for m, ts in proposed.items() if recurring & set(ts)}
        template_of |= chosen
        moved = set(map(leaf_of, chosen))
        rest = {m for m, ts in proposed.items() if ts and m not in chosen and leaf_of(m) in moved}
        least = 1

    found = {(doc, i): template_of[masked] for doc, i, _, masked, _ in shared if masked in template_of}
    alike, long = {}, {}
    for doc, i, raw, masked, _ in shared:
        if raw != masked and (doc, i) not in found:
            alike.setdefault(raw, []).append((doc, i))
    for doc, i, raw, _, _ in lines:
        if len(raw) >= tree.long:
            long.setdefault(raw, []).append((doc, i))
    for raw, at in alike.items():
        if len({doc for doc, _ in at}) >= tree.documents:
            found |= {place: ("alike", raw) for place in at}
    for raw, at in long.items():
        if len({doc[1] for doc, _ in at}) >= tree.long_documents:
            found = {place: ("alike", raw) for place in at} | found
    return found

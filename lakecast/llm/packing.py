"""Packing by power-of-two decomposition.

A document's ids are cut into full sequences and, for what is left, one piece for each binary
digit of its length. Every piece is a sequence of its own whose length is a power of two, so
no sequence crosses documents and none holds padding; batches are made of equal lengths.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEQUENCE = 4096
END_ID = 2
#: Words a worker remembers with their ids, and bytes of text it encodes at once; they bound its memory.
WORDS_KEPT = 400_000
TEXT_AT_ONCE = 2 * 1024 * 1024

# Plain words: printable ASCII but for the apostrophe and angle brackets, and the letters of Latin-1.
_PLAIN = regex.compile(r"[!-&(-;=?-~À-ÖØ-öø-ÿ]+")
_PLAIN_LINES = regex.compile(r"[!-&(-;=?-~À-ÖØ-öø-ÿ\n]+")

#: What stands for a line's end among ids; no tokenizer has as many.
_NO_ID = np.uint32(0xFFFFFFFF)
_LINE_END = _NO_ID.tobytes()

# Byte-level models name each byte by a letter: printable ones by themselves, the others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_BYTE_LETTERS = {c: "".join(_LETTER[b] for b in chr(c).encode()) for c in range(33, 256)}

SCHEMA = "{key} {key_type}, start long, length long, doc_tokens long, ids binary"


def pieces_of(n: int, longest: int = SEQUENCE) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` ids: full sequences, then falling powers of two."""
    out = [(i * longest, longest) for i in range(n // longest)]
    start = len(out) * longest
    for bit in range(longest.bit_length() - 2, -1, -1):
        if n % longest >> bit & 1:
            out.append((start, 1 << bit))
            start += 1 << bit
    return out


class WordIds:
    """Ids of whole texts from ids of their words.

    For tokenizers that drop white space and never merge across it: the ids of a text are then
    those of its words in turn. The first ``words_kept`` distinct words are remembered, so frequent ones are
    encoded once; any other word is encoded once for each batch of texts.

    Words of plain Latin letters, digits and marks are cut by the tokenizer's own pattern, and their parts,
    which many words share, go straight to its model; that is what the tokenizer does with them after
    a normalisation that only changes their case. All other words take the tokenizer's whole way.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._pattern = _plain_pattern(path)
        self._words_kept = words_kept
        self._parts: dict[str, bytes] = {}
        self._place: dict[str, int] = {}
        self._ids = np.empty(1 << 16, np.uint32)
        self._starts = np.zeros(1 << 16, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Ids of words that are not remembered, from the end of the remembered ones on; as many as there is room for are remembered."""
        # In small parts, as the tokenizer's results are many times as large as their ids.
        for first in range(0, len(words), 4096):
            self._learn_part(words[first : first + 4096], len(self._place) + first)
        kept = max(0, self._words_kept - len(self._place))
        self._place.update(zip(words[:kept], range(len(self._place), len(self._place) + kept)))

    def _learn_part(self, words: list[str], first: int) -> None:
        ids, counts = self._encoded(words)
        used = int(self._starts[first])
        ends = used + np.cumsum(counts)
        total = int(ends[-1])
        if total > len(self._ids):
            self._ids = np.concatenate([self._ids[:used], np.empty(2 * total, np.uint32)])
        self._ids[used:total] = ids
        if first + len(words) >= len(self._starts):
            self._starts = np.concatenate([self._starts, np.empty(len(self._starts) + len(words), np.int64)])
        self._starts[first + 1 : first + 1 + len(words)] = ends

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids one after another, and how many each has."""
        if self._pattern is None:
            return self._by_tokenizer(words)
        if _PLAIN_LINES.fullmatch("\n".join(words)):
            return self._by_parts(words)
        plain = np.fromiter((_PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        counts = np.empty(len(words), np.int64)
        some, counts[plain] = self._by_parts(list(compress(words, plain)))
        others, counts[~plain] = self._by_tokenizer(list(compress(words, ~plain)))
        of_plain = np.repeat(plain, counts)
        ids = np.empty(len(of_plain), np.uint32)
        ids[of_plain], ids[~of_plain] = some, others
        return ids, counts

    def _by_tokenizer(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), np.uint32, int(counts.sum())), counts

    def _by_parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``_encoded`` for plain words: all are cut at once, one a line, and each distinct part is looked up or encoded once."""
        found = self._pattern.findall("".join(f"{w}\n" for w in words).lower())
        if found.count("\n") != len(words):
            # A pattern that takes a line's end into a part cannot cut lines.
            return self._by_tokenizer(words)
        if len(self._parts) > self._words_kept // 4:
            self._parts.clear()
        parts, tokenize = self._parts, self._tokenizer.model.tokenize
        parts["\n"] = _LINE_END
        for part in set(found).difference(parts):
            letters = part if part.isascii() else part.translate(_BYTE_LETTERS)
            parts[part] = array("I", [t.id for t in tokenize(letters)]).tobytes()
        ids = np.frombuffer(b"".join(map(parts.__getitem__, found)), np.uint32)
        ends = np.flatnonzero(ids == _NO_ID)
        return ids[ids != _NO_ID], np.diff(ends, prepend=-1) - 1

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; a null text has none."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        ends = words.offsets.to_numpy()
        coded = words.values[ends[0] : ends[-1]].dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        place = np.fromiter(map(self._place.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(place < 0)
        if len(unknown):
            # Learnt words stand after the remembered ones, in order.
            place[unknown] = np.arange(len(self._place), len(self._place) + len(unknown))
            self._learn([distinct[i] for i in unknown.tolist()])
        at = place[coded.indices.to_numpy()]
        first = self._starts[at]
        count = self._starts[at + 1] - first
        upto = np.concatenate([[0], np.cumsum(count)])
        ids = self._ids[np.arange(upto[-1]) + np.repeat(first - upto[:-1], count)]
        return np.split(ids, upto[ends[1:-1] - ends[0]])


def _plain_pattern(path: str):
    """The tokenizer's pattern, if plain words need only lower case, that pattern and its byte letters; else None."""
    with open(path) as file:
        spec = json.load(file)
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    normalizers = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    if normalizers != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        return None
    split, letters = steps
    kept_parts = split["behavior"] == "Removed" and split["invert"]
    special = any(_PLAIN.fullmatch(t["content"]) for t in spec["added_tokens"])
    if not kept_parts or letters["use_regex"] or letters["add_prefix_space"] or special:
        return None
    # Words hold no white space: in many of them, one a line, a line's end is to be a part of its own.
    return regex.compile(rf"{split['pattern']['Regex']}|\n")


@lru_cache(maxsize=2)
def word_ids(path: str, words_kept: int = WORDS_KEPT) -> WordIds:
    """One per worker, which lives longer than a task."""
    return WordIds(path, words_kept)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in parts of about ``TEXT_AT_ONCE``."""
    rows = max(1, batch.num_rows * TEXT_AT_ONCE // max(1, batch.nbytes))
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def pack(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", longest: int = SEQUENCE, end_id: int = END_ID, words_kept: int = WORDS_KEPT
) -> DataFrame:
    """One row per piece: ``key, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` are packed unsigned 32-bit little-endian numbers (``unpacked`` reads them),
    ``doc_tokens`` counts the document's ids with the end id. ``length`` is the bucket: rows of
    equal length make a batch without padding. ``sequence_id`` is unique, ``offset`` 0, as a
    sequence is one piece. Texts are encoded whole. A worker remembers the ids of ``words_kept`` words.

    Nulls: a null or empty text has the end id alone; a null key stays null. Repeated rows are
    packed as often as they occur. Very long texts give many full sequences. An empty table
    gives an empty result. Other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text_"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = word_ids(tokenizer, words_kept), np.array([end_id], np.uint32)
        for batch in chain.from_iterable(map(_slices, batches)):
            keys, block, size = batch.column(0), [], 0
            for row, ids in enumerate(ids_of(batch.column(1))):
                ids = np.concatenate([ids, end])
                for start, length in pieces_of(len(ids), longest):
                    block.append((row, start, length, len(ids), ids[start : start + length].tobytes()))
                    size += length
                if size > 1 << 20:
                    yield _piece_batch(keys, block)
                    block, size = [], 0
            if block:
                yield _piece_batch(keys, block)

    def _piece_batch(keys: pa.Array, block: list[tuple]) -> pa.RecordBatch:
        rows, starts, lengths, totals, ids = zip(*block, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(rows)),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=[key, "start", "length", "doc_tokens", "ids"],
        )

    pieces = out.mapInArrow(encode, SCHEMA.format(key=f"`{key}`", key_type=kind))
    # Numbered by task and row: no shuffle of the ids.
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def unpacked(ids: bytes) -> list[int]:
    """The ids of a piece."""
    return np.frombuffer(ids, "<u4").tolist()


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Pieces as Parquet, a folder per length, so that a reader makes batches of equal lengths."""
    pieces.write.mode("overwrite").partitionBy("length").parquet(path)

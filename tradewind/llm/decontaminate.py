"""Benchmark decontamination by a broadcast set of test n-grams (operator 12).

Words are runs of digits, letters and everything beyond ASCII, with A to Z in lower case. Every ``window`` consecutive
words of a benchmark item are a gram; an item of fewer words is one gram, an item without words none. The
hashes of all grams are a sorted array that every task gets; the hashes of all windows of a text are looked up in
it at once, and each hit is verified by its words. Words inside any verified window are hit.

The set is broadcast only if the benchmark's texts have at most ``most_bytes`` in all, which is counted first. A larger
benchmark stays distributed: a Bloom filter of ``FILTER_BITS`` bits, whatever the benchmark's size, is broadcast instead, the
windows that pass it are joined with the grams by their hash, and verified there. Both ways give the same rows.

Null texts and texts without words have no hits, and windows go over line breaks. Items without an id hit words, but are not
listed; items of equal id are one item. Rows of equal text are treated alike. Equal grams of many items are one entry of the
set with several items. An empty benchmark hits nothing, empty documents give no rows. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import column, fresh_name
from tradewind.llm.hashing import mixed
from tradewind.operators.lineage import written

WINDOW = 10
# Bytes of a benchmark whose set is broadcast; the set has some six times as many.
MOST_BYTES = 8 << 20
FILTER_BITS = 1 << 26
# Bytes of a text that are worked on at once; a piece ends between words, so a longer word makes a longer piece.
PIECE = 1 << 20
REPORT = "struct<n_words: bigint, n_hit: bigint, items: array<string>, text: string>"
GRAM = "id string, hash long, words int, gram binary"
HIT = "v1 long, v2 long, first int, words int, hash long, gram binary"

# Each byte in lower case, or 0 if it is not part of a word.
_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_BASE = 0x9E3779B97F4A7C15


class Words:
    """The words of a text: normalised bytes (0 between words), where words start and end, and a hash of each."""

    def __init__(self, data: bytes | None):
        self.bytes = _LETTER[np.frombuffer(data or b"", dtype=np.uint8)]
        inside = np.zeros(len(self.bytes) + 2, dtype=np.int8)
        inside[1:-1] = self.bytes != 0
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        parts = [self._hashes(*part) for part in self._pieces()]
        self.hash = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def _pieces(self) -> Iterator[tuple[int, int]]:
        """First and last word, about a ``PIECE`` of bytes at a time."""
        first = 0
        while first < len(self):
            last = max(first + 1, int(np.searchsorted(self.end, self.start[first] + PIECE, side="right")))
            yield first, last
            first = last

    def _hashes(self, first: int, last: int) -> np.ndarray:
        """Each word's bytes as digits of a number, added up from powers that all words of the piece share."""
        begin, stop = self.start[first], self.end[last - 1]
        symbols = self.bytes[begin:stop].astype(np.uint64)
        start, size = self.start[first:last] - begin, self.end[first:last] - self.start[first:last]
        # The place of each byte in its word: powers stay those of short exponents, and no inverse is needed.
        place = np.arange(len(symbols)) - np.repeat(start, np.diff(np.append(start, len(symbols))))
        power = np.cumprod(np.full(int(size.max()) + 1, _BASE, dtype=np.uint64))
        place = np.minimum(place, len(power) - 1)
        sums = np.add.reduceat(symbols * power[place], start)
        return mixed(sums + size.astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """A hash of every ``size`` consecutive words."""
        count = max(0, len(self) - size + 1)
        state = np.full(count, size, dtype=np.uint64)
        for k in range(size if count else 0):
            state = mixed(state * np.uint64(0xD6E8FEB86659FD93) + self.hash[k:k + count])
        return state

    def gram(self, first: int, size: int) -> bytes:
        """Words as bytes, 0 between them."""
        return b"\0".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[first:first + size], self.end[first:first + size]))


def _grams(data: bytes | None, window: int) -> Iterator[tuple[int, int, bytes]]:
    """Hash, number of words and bytes of each gram of an item."""
    words = Words(data)
    size = min(window, len(words))
    if size:
        for first, hash_ in enumerate(words.windows(size).view(np.int64).tolist()):
            yield hash_, size, words.gram(first, size)


class GramSet:
    """Grams with the items they are from, found by hash: some 28 bytes for each gram of an item, and the words."""

    def __init__(self, rows: list[tuple[str | None, bytes]], window: int):
        self.ids = sorted({id_ for id_, _ in rows if id_ is not None})
        number = {id_: k for k, id_ in enumerate(self.ids)}
        parts, texts, at = [], [], 0
        for id_, data in rows:
            words = Words(data)
            size = min(window, len(words))
            if not size:
                continue
            hashes = words.windows(size).view(np.int64)
            ends = at + np.cumsum(words.end - words.start + 1) - 1
            starts = ends - (words.end - words.start)
            parts.append((hashes, starts[:len(hashes)], ends[size - 1:], np.full(len(hashes), size), np.full(len(hashes), number.get(id_, -1))))
            texts += [words.gram(0, len(words)), b"\0"]
            at = int(ends[-1]) + 1
        self.text = b"".join(texts)
        columns = [np.concatenate(c) for c in zip(*parts)] or [np.zeros(0, dtype=np.int64)] * 5
        order = np.argsort(columns[0], kind="stable")
        hashes, starts, ends, sizes, items = (c[order] for c in columns)
        # One entry for grams of equal words, in a row; words of equal hash that differ are sorted first.
        new = np.diff(hashes, prepend=hashes[:1] - 1) != 0
        border = np.append(np.flatnonzero(new), len(hashes))
        for first, last in zip(border[:-1][np.diff(border) > 1], border[1:][np.diff(border) > 1]):
            grams = [self.text[a:b] for a, b in zip(starts[first:last], ends[first:last])]
            if len(set(grams)) > 1:
                by_words = first + np.array(sorted(range(len(grams)), key=grams.__getitem__))
                for c in (starts, ends, sizes, items):
                    c[first:last] = c[by_words]
                grams.sort()
                new[first + 1:last] = [a != b for a, b in zip(grams, grams[1:])]
        entry = np.flatnonzero(new)
        self.hashes, self.starts, self.ends = hashes[entry], starts[entry], ends[entry].astype(np.int32)
        self.first, self.items = np.append(entry, len(items)), items.astype(np.int32)
        self.sizes = sorted(set(sizes.tolist()))

    def hits(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """First word, number of words and items (by place among the ids) of each window that is a gram."""
        for size in self.sizes:
            hashes = words.windows(size).view(np.int64)
            for first in np.flatnonzero(_among(hashes, self.hashes)).tolist():
                here = words.gram(first, size)
                entry = int(np.searchsorted(self.hashes, hashes[first]))
                while entry < len(self.hashes) and self.hashes[entry] == hashes[first]:
                    if self.text[self.starts[entry]:self.ends[entry]] == here:
                        yield first, size, self.items[self.first[entry]:self.first[entry + 1]]
                    entry += 1


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _report(data: bytes | None, words: Words, spans: list[tuple[int, int]], items: list[str], cut: bool) -> tuple:
    """Numbers and items of a text, and the text without its hit words and what is between them."""
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for first, size in spans:
        step[first] += 1
        step[first + size] -= 1
    hit = np.cumsum(step[:-1]) > 0
    left = data
    if cut and hit.any():
        edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
        begin, end = words.start[np.flatnonzero(edge == 1)], words.end[np.flatnonzero(edge == -1) - 1]
        left = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)]))
    return len(words), int(hit.sum()), items, left.decode() if cut and left is not None else None


def _reports(rows: list[tuple]) -> pa.StructArray:
    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "text": pa.string()}
    return pa.StructArray.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], names=list(kinds))


def _by_set(text: Column, known: Any, cut: bool) -> Column:
    """Reports from the broadcast set."""
    @F.arrow_udf(REPORT)
    def report(texts: pa.Array) -> pa.Array:
        rows = []
        for value in texts:
            data = value.as_py()
            words = Words(data)
            hits = list(known.value.hits(words))
            items = np.unique(np.concatenate([h[2] for h in hits])) if hits else ()
            rows.append(_report(data, words, [h[:2] for h in hits], [known.value.ids[k] for k in items if k >= 0], cut))
        return _reports(rows)

    return report(text.cast("string").cast("binary"))


def _by_hits(text: Column, hits: Column, cut: bool) -> Column:
    """Reports from verified hits that were joined to each text."""
    @F.arrow_udf(REPORT)
    def report(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for value, hit in zip(texts, found):
            data = value.as_py()
            hits = hit.as_py() or []
            items = sorted({h["id"] for h in hits} - {None})
            rows.append(_report(data, Words(data), [(h["first"], h["words"]) for h in hits], items, cut))
        return _reports(rows)

    return report(text.cast("string").cast("binary"), hits)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the Bloom filter per hash."""
    found = hashes.view(np.uint64)
    return (found % np.uint64(bits)).astype(np.int64), (mixed(found) % np.uint64(bits)).astype(np.int64)


def _bloom(grams: DataFrame, bits: int) -> np.ndarray:
    """The grams' Bloom filter, as bytes of eight bits; tasks send words of 64 bits, so its size is its bound."""
    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.unique(np.concatenate(_places(batch["hash"].to_numpy(dtype=np.int64), bits)))
            word, mask = place >> 6, np.left_shift(np.uint64(1), (place & 63).astype(np.uint64))
            first = np.flatnonzero(np.diff(word, prepend=-1))
            yield pd.DataFrame({"word": word[first], "mask": np.bitwise_or.reduceat(mask, first).view(np.int64)} if len(word)
                               else {"word": [], "mask": []})

    words = grams.select("hash").mapInPandas(marked, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    out = np.zeros(bits >> 6, dtype=np.int64)
    for row in words.toLocalIterator():  # at most bits / 64 rows
        out[row["word"]] = row["mask"]
    return out.view(np.uint8)


def _joined_hits(docs: DataFrame, text: str, grams: DataFrame, window: int, bits: int) -> DataFrame:
    """``(v1, v2, hits)``: verified hits by a text's two hashes, when the benchmark is too large to broadcast."""
    sizes = [r["words"] for r in grams.select("words").distinct().collect()]  # 1 to ``window``
    known = docs.sparkSession.sparkContext.broadcast(_bloom(grams, bits))

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for v1, v2, data in batch.itertuples(index=False):
                words = Words(data)
                for size in sizes:
                    hashes = words.windows(size).view(np.int64)
                    ok = np.ones(len(hashes), dtype=bool)
                    for place in _places(hashes, bits):
                        ok &= (known.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    at = np.flatnonzero(ok)
                    if not len(at):
                        continue
                    yield pd.DataFrame({"v1": v1, "v2": v2, "first": at, "words": size, "hash": hashes[at],
                                        "gram": [words.gram(k, size) for k in at.tolist()]})

    texts = docs.select(*_versions(column(text)), column(text).cast("string").cast("binary").alias("text")).filter("text IS NOT NULL")
    found = written(texts.mapInPandas(candidates, HIT), "gram-candidates")
    # Both sides are read from files, so the partition of a hot gram can be split.
    hit = F.struct("first", "words", "id")
    return found.join(grams, ["hash", "words", "gram"]).groupBy("v1", "v2").agg(F.collect_set(hit).alias("hits"))


def _versions(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("v1"), F.xxhash64(F.lit(1), text).alias("v2")]


def _text_bytes(benchmark: DataFrame, item_id: str, item_text: str) -> int:
    size = F.octet_length(column(item_text).cast("string")) + F.coalesce(F.octet_length(column(item_id).cast("string")), F.lit(0))
    return benchmark.agg(F.sum(size)).first()[0] or 0


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, most_bytes: int = MOST_BYTES, filter_bits: int = FILTER_BITS,
                  cut: bool = False) -> tuple[DataFrame, str]:
    """``docs`` and the name of a further column ``(n_words, n_hit, items, text)``: words, hit words, ids of the items
    whose grams occur (as text, sorted), and, if ``cut``, the text without its hit words."""
    spark, name = docs.sparkSession, fresh_name(docs, "contamination")
    items = benchmark.select(column(item_id).cast("string").alias("id"), column(item_text).cast("string").cast("binary").alias("text"))
    items = items.filter("text IS NOT NULL")
    if _text_bytes(benchmark, item_id, item_text) <= most_bytes:
        known = spark.sparkContext.broadcast(GramSet([(r["id"], bytes(r["text"])) for r in items.collect()], window))
        return docs.withColumn(name, _by_set(column(text), known, cut)), name

    def cut_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for id_, data in batch.itertuples(index=False):
                yield pd.DataFrame([(id_, *gram) for gram in _grams(data, window)], columns=["id", "hash", "words", "gram"])

    grams = written(items.mapInPandas(cut_grams, GRAM).distinct(), "grams")
    hits = written(_joined_hits(docs, text, grams, window, filter_bits), "gram-hits")
    of = fresh_name(docs, "hits_of")
    same = (F.xxhash64(column(text)) == column(of)["v1"]) & (F.xxhash64(F.lit(1), column(text)) == column(of)["v2"])
    joined = docs.join(hits.select(F.struct("v1", "v2", "hits").alias(of)), same, "left")
    return joined.withColumn(name, _by_hits(column(text), column(of)["hits"], cut)).drop(column(of)), name


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", text: str = "text", **more: Any) -> DataFrame:
    """``docs`` without the passages of the benchmark (``remove="spans"``: hit words and what is between them go; other
    columns stay as they are) or without the documents that have any (``"documents"``)."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"unknown remove {remove!r}")
    found, name = contamination(docs, benchmark, text, cut=remove == "spans", **more)
    if remove == "documents":
        return found.filter(column(name)["n_hit"] == 0).drop(column(name))
    kind = docs.schema[text].dataType
    left = column(name)["text"] if isinstance(kind, T.StringType) else column(name)["text"].cast(kind)
    return found.withColumn(text, F.when(column(name)["n_hit"] > 0, left).otherwise(column(text))).drop(column(name))

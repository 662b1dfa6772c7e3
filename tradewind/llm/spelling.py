"""Spelling variants grouped under their most frequent form (operator 11).

Words of a vocabulary are near if they differ by exactly one inserted, deleted or replaced code point. The
sorted list of words is scanned as a tree of prefixes: where adjacent words stop sharing a prefix (their longest
common prefix, LCP) a range ends, and the row of the edit matrix of a prefix is computed once for the whole range
that shares it. Only the band of the three diagonals that one edit can reach is kept, and a range is left as
soon as every number of its row exceeds one. Rows of all words of a list that are still open are held as
numpy arrays and go down one letter at a time.

No list holds the whole vocabulary. One edit lies in the front or in the back half of the shorter word, so two
near words share the other half, and words are dealt by either half and by the length of the shorter word. A
list of more than ``MOST_WORDS`` words, or ``MOST_CELLS`` code points, is dealt again by more of what its words
share, half of the places an edit may be at on either side, until it is short enough or one place is left, where
no more words than letters can meet. Each pair is found in one list only: the one of the place where the two first differ.

A word's form is its near word of the largest count, if that is ``ratio`` times its own at least (ties: the
smallest word in code-point order), so chains of forms rise and end; their ends, the roots, are found by
doubling steps, in rounds that grow with the logarithm of the longest chain.

Null texts and texts without words have no words. Null ids count as empty when misspellings are planted. Words
of any length take part, very long ones as well; equal words count together wherever they come from. Null words
and null counts take no part, repeated words of a vocabulary add up. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import whole_groups
from tradewind.llm.common import column
from tradewind.operators.lineage import written

# Letters of a word, and the ones that have a lower case here.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A list beyond these is dealt again.
MOST_WORDS, MOST_CELLS = 4096, 1 << 22
# Rows of the edit matrices that go down at once.
MOST_OPEN = 1 << 18
LIST = ("c", "lo", "hi", "shared")
NEAR = "word string, n_near long, form string, form_n long"


def runs(text: Column) -> Column:
    """Maximal runs of letters, A to Z in lower case."""
    def lower(run: Column) -> Column:
        # Other letters keep their case; lower() is far cheaper where there are none.
        plain = F.octet_length(run) == F.length(run)
        return F.when(plain, F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))

    return F.transform(F.regexp_extract_all(text.cast("string"), F.lit(RUN), F.lit(0)), lower)


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3,
               misspell: int | None = None) -> DataFrame:
    """``(word, n)``: runs of at least ``min_length`` code points that occur ``min_count`` times over all texts.

    ``misspell`` plants misspellings to be found again: a run loses the code point ``h % length`` if ``misspell``
    divides h, the CRC-32 of ``<id>:<run>``.
    """
    id_ = F.coalesce(column(id_column).cast("string"), F.lit(""))
    found = docs.select(id_.alias("id"), F.explode(runs(column(text))).alias("run"))
    word = F.col("run")
    if misspell is not None:
        # A run must be long enough after it lost a letter or not, so shorter ones need no checksum.
        found = found.filter(F.length("run") >= min_length).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        word = F.when(F.col("h") % misspell == 0, less).otherwise(F.col("run"))
    return (
        found.select(word.alias("word")).filter(F.length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def _lists(rows: DataFrame) -> DataFrame:
    """Rows ``(c, word, n, lo, hi)`` with what the words of their list share, and what is between.

    Lists are for pairs whose shorter word has ``c`` code points and that first differ at a place from ``lo`` on and
    before ``hi``: both words have the same ``lo`` code points in front and ``c - hi`` at their end.
    """
    end = F.greatest(F.col("c") - F.col("hi"), F.lit(0))
    inner = F.length("word") - F.col("lo") - end
    return rows.select(
        "c", "lo", "hi",
        F.concat(F.substr("word", F.lit(1), F.col("lo")), F.when(end > 0, F.right("word", end)).otherwise("")).alias("shared"),
        F.substr("word", F.col("lo") + 1, inner).alias("inner"), "n")


def _halves(lo: Column, hi: Column) -> Column:
    half = F.floor((lo + hi) / 2).cast("int")
    both = F.array(F.struct(lo.alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), hi.alias("hi")))
    return F.explode(F.filter(both, lambda part: part["lo"] < part["hi"]))


def _first_lists(words: DataFrame, shortest: int) -> DataFrame:
    """Each word as the shorter and as the longer one of a pair, dealt by either half."""
    length = F.length("word")
    c = F.explode(F.filter(F.array(length, length - 1), lambda x: x >= shortest)).alias("c")
    rows = words.select(c, "word", "n")
    return _lists(rows.select("c", "word", "n", _halves(F.lit(0), F.col("c") + 1).alias("places")).select("c", "word", "n", "places.*"))


def _dealt_again(rows: DataFrame) -> DataFrame:
    word = F.concat(F.substr("shared", F.lit(1), F.col("lo")), "inner", F.substr("shared", F.col("lo") + 1))
    halves = rows.select("c", word.alias("word"), "n", _halves(F.col("lo"), F.col("hi")).alias("places"))
    return _lists(halves.select("c", "word", "n", "places.*"))


def _code_points(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """One row per word, -1 behind its end, and the lengths."""
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    # Two more columns: the band looks that far behind the longest word.
    table = np.full((len(words), int(size.max(initial=0)) + 2), -1, dtype=np.int32)
    table[np.arange(table.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.int32)
    return table, size


def _common_prefixes(table: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Code points that each word shares with the one before; -1 where a list begins."""
    common = np.full(len(table), -1, dtype=np.int64)
    if len(table) > 1:
        differs = table[1:] != table[:-1]
        common[1:] = np.where(group[1:] == group[:-1], np.where(differs.any(axis=1), differs.argmax(axis=1), table.shape[1]), -1)
    return common


def _pieces(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of at most ``most`` in all, or of one item."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, end)
        start = end


def near_pairs(words: Sequence[str], group: np.ndarray, span: np.ndarray, longer: np.ndarray,
               most: int = MOST_OPEN) -> tuple[np.ndarray, np.ndarray]:
    """Ordered pairs of places of words of a list that are one edit apart.

    Lists follow each other and are sorted. Pairs that share ``span`` code points in front are left out, as are
    pairs of two ``longer`` ones: other lists have them.
    """
    table, size = _code_points(words)
    common = _common_prefixes(table, group)
    begins = np.flatnonzero(common < 0)
    which = np.searchsorted(begins, np.arange(len(words)), side="right") - 1
    one = np.ones(len(words), dtype=np.int8)
    # A range of words with the same ``depth`` code points, the word that is compared, and the band of its row.
    todo = [(0, begins[which], np.append(begins[1:], len(words))[which], np.arange(len(words)), one, one * 0, one)]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while todo:
        depth, start, end, word, left, middle, right = todo.pop()
        ended = size[start] == depth  # only the first word of a range can end where the prefix does
        at = np.flatnonzero(ended)
        off = size[word[at]] - depth
        edits = np.select([off == -1, off == 0, off == 1], [left[at], middle[at], right[at]], 2)
        fits = at[(edits == 1) & ~(longer[word[at]] & longer[start[at]])]
        found.append((word[fits], start[fits]))

        borders = np.flatnonzero(common <= depth)
        first, last = np.searchsorted(borders, start + ended), np.searchsorted(borders, end)
        for part in _pieces(last - first, most):
            count = (last - first)[part]
            total = int(count.sum())
            if not total:
                continue
            pair = np.repeat(np.arange(part.start, part.start + len(count)), count)
            child = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + first[pair]
            low, letter = borders[child], table[borders[child], depth]
            mine, was_left, was_middle, was_right = word[pair], left[pair], middle[pair], right[pair]
            differs = [(table[mine, depth + k] != letter).astype(np.int8) if depth + k >= 0 else np.int8(1) for k in (-1, 0, 1)]
            to_left = np.minimum(was_left + differs[0], was_middle + 1)
            to_middle = np.minimum(np.minimum(was_middle + differs[1], was_right + 1), to_left + 1)
            to_right = np.minimum(was_right + differs[2], to_middle + 1)
            least = np.minimum(np.minimum(to_left, to_middle), to_right)
            stay = np.flatnonzero((least <= 1) & ~((to_middle == 0) & (span[mine] == depth + 1)))
            if len(stay):
                high = np.append(borders, len(words))[child[stay] + 1]
                todo.append((depth + 1, low[stay], np.minimum(high, end[pair[stay]]), mine[stay],
                             to_left[stay], to_middle[stay], to_right[stay]))
    return tuple(np.concatenate(side) for side in zip(*found))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Near words of each word of sorted lists: their number, and the most frequent of them."""
    for lists in whole_groups(batches, list(LIST)):
        new = (lists[list(LIST)] != lists[list(LIST)].shift()).any(axis=1).to_numpy()
        group = np.cumsum(new) - 1
        alone = np.bincount(group)[group] == 1
        if alone.all():
            continue
        lists, group = lists[~alone].reset_index(drop=True), group[~alone]
        sizes = np.bincount(group, minlength=1)[np.unique(group)]
        width = lists["inner"].str.len().to_numpy()
        starts = np.cumsum(sizes) - sizes
        cells = sizes * np.maximum.reduceat(width, starts)
        # So few lists at once that neither their words nor their code points are many.
        for part in _pieces(np.maximum(cells, sizes * (MOST_CELLS // MOST_WORDS)), MOST_CELLS):
            rows = slice(int(starts[part][0]), int(starts[part][-1] + sizes[part][-1]))
            some = lists.iloc[rows]
            c, lo, hi = (some[x].to_numpy() for x in LIST[:3])
            words = [s[:k] + i + s[k:] for s, k, i in zip(some["shared"], lo, some["inner"])]
            longer = np.fromiter(map(len, words), dtype=np.int64) > c
            word, near = near_pairs(some["inner"].tolist(), group[rows], hi - lo, longer)
            if not len(word):
                continue
            place = np.empty(len(words), dtype=np.int64)
            place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
            n = some["n"].to_numpy()
            order = np.lexsort((place[near], -n[near], word))
            word, near = word[order], near[order]
            best = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            yield pd.DataFrame({
                "word": [words[k] for k in word[best]], "n_near": np.diff(np.append(best, len(word))),
                "form": [words[k] for k in near[best]], "form_n": n[near[best]]})


def _near_words(words: DataFrame, most_words: int, most_cells: int) -> DataFrame:
    """``(word, n_near, form, form_n)`` per list in which a word has near ones."""
    shortest = words.agg(F.min(F.length("word"))).first()[0]
    todo, ready = _first_lists(words, shortest or 0), []
    while True:
        todo = written(todo, "word-lists")
        long_ = written(
            todo.groupBy(*LIST).agg(F.count(F.lit(1)).alias("words"))
            .filter((F.col("words") > most_words) | (F.col("words") * F.col("c") > most_cells))
            .filter("hi - lo > 1").drop("words"), "long-lists")
        if long_.isEmpty():
            ready.append(todo)
            break
        # Both sides are read from files, so a long list's partition can be split.
        ready.append(todo.join(long_, list(LIST), "left_anti"))
        todo = _dealt_again(todo.join(long_, list(LIST), "left_semi"))
    found = [rows.repartition(*LIST).sortWithinPartitions(*LIST, "inner").mapInPandas(_scan, NEAR) for rows in ready]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: the end of the chain that starts at each word of the links ``(word, form)``. A word has one
    form at most, and chains have no cycles."""
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        # Links are read from files on both sides, so a common root's partition can be split.
        links = written(links.join(on, "root", "left").select("word", "root", "further"), "chains")
        done = links.filter("further IS NOT NULL").isEmpty()
        links = links.select("word", F.coalesce("further", "root").alias("root"))
        if done:
            return links


def group_variants(words: DataFrame, ratio: float = 2, most_words: int = MOST_WORDS, most_cells: int = MOST_CELLS) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every word of a vocabulary ``(word, n)``."""
    words = written(words.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n")), "vocabulary")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    near = _near_words(words, most_words, most_cells).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    found = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= F.col("n") * ratio, F.col("best")).alias("best")
    ).select("word", "n", "n_near", "best.form", (-F.col("best.less")).alias("form_n")), "near-words")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

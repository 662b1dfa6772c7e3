"""Spelling variants, decontamination and whitening against brute force, on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL, prose
from tradewind.llm import decontaminate, spelling, whitening
from tradewind.llm.queries import QUERIES


# Spelling ------------------------------------------------------------------------------------------

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) == len(short) + 1 and any(long_[:k] + long_[k + 1:] == short for k in range(len(long_)))


def variants(counts, ratio=2):
    form, near = {}, {}
    for word, n in counts.items():
        found = [other for other in counts if one_edit(word, other)]
        best = min(found, key=lambda w: (-counts[w], w), default=None)
        near[word], form[word] = len(found), best if best is not None and counts[best] >= ratio * n else None

    def root(word):
        return word if form[word] is None else root(form[word])

    return {w: (n, near[w], form[w], counts.get(form[w]), root(w)) for w, n in counts.items()}


def counted(rows):
    """Words of ``(id, text)`` rows with misspellings planted, without short and rare ones."""
    found = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def grouped(spark, counts, **more):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {r["word"]: tuple(r[c] for c in ("n", "n_near", "form", "form_n", "root")) for r in spelling.group_variants(words, **more).collect()}


def random_words(seed, letters, lengths, count):
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list(letters), rng.integers(*lengths))) for _ in range(count)}
    return {w: int(rng.integers(1, 80)) for w in sorted(words)}


# The second limit makes every list with an edge be dealt again, down to single places.
@pytest.mark.parametrize("letters, lengths, limits", [
    ("ab", (1, 9), {}), ("abcé", (3, 7), {"most_words": 2}), ("abcé", (1, 5), {"most_cells": 30}), ("aà😀", (0, 6), {})], ids=str)
def test_variants_of_random_words(spark, letters, lengths, limits):
    counts = random_words(len(letters), letters, lengths, 250)
    assert grouped(spark, counts, **limits) == variants(counts)


def test_variants_of_one_long_list_that_shares_its_ends(spark):
    """A third of the vocabulary has the same beginning and end; the list is dealt by what is between."""
    counts = {f"sharedbeginning{a}{b}{c}thesameend": 1 + (a * 7 + b * 3 + c) % 50 for a in range(9) for b in range(9) for c in range(9)}
    counts |= random_words(5, "abcdefgh", (5, 12), 800)
    assert grouped(spark, counts, most_words=40) == variants(counts)


def test_variants_of_very_long_words(spark):
    base = "abcdefghij" * 400
    counts = {base: 9, base[:2000] + base[2001:]: 3, base[:-1] + "x": 4, "x" + base: 1, base + base: 5, "y" + base[1:]: 20}
    assert grouped(spark, counts) == variants(counts)
    assert grouped(spark, counts, most_cells=100) == variants(counts)


def test_near_pairs_do_not_depend_on_how_many_go_down_at_once():
    words = sorted(random_words(3, "abc", (1, 7), 200))
    none = np.zeros(len(words), dtype=np.int64)
    found = [sorted(zip(*spelling.near_pairs(words, none, none + 99, none > 0, most=most))) for most in (1, 50, 1 << 18)]
    assert found[0] == found[1] == found[2]
    assert {(words[a], words[b]) for a, b in found[0]} == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_chains_of_forms_end_at_their_root(spark):
    counts = {"aaaaa" + "b" * k: 3 * 2 ** k for k in range(12)}
    found = grouped(spark, counts)
    assert {r[4] for r in found.values()} == {"aaaaa" + "b" * 11} and found == variants(counts)


def test_ties_take_the_smallest_word(spark):
    counts = {"words": 2, "wordé": 9, "wordz": 9, "swords": 9, "word": 9}
    assert grouped(spark, counts)["words"] == (2, 4, "swords", 9, "swords")
    assert grouped(spark, counts) == variants(counts)


def test_variants_of_awkward_rows(spark, awkward, awkward_rows, nothing):
    rows = [(r[0], r[1]) for r in awkward_rows] + [(k, "Straße STRASSE straße÷x Ünder ünder ABCDÉ abcdé abcdÉ " * 3) for k in range(3)]
    docs = awkward.select("doc_id", "text", "quality", "n_words").unionByName(
        spark.createDataFrame(rows[len(awkward_rows):], "doc_id long, text string").withColumns({"quality": F.lit(1).cast("string"), "n_words": F.lit("w")}))
    words = spelling.vocabulary(docs, misspell=97)
    found = {r["word"]: tuple(r[c] for c in ("n", "n_near", "form", "form_n", "root")) for r in spelling.group_variants(words).collect()}
    assert found == variants(counted(rows)) and len(found) > 5
    assert spelling.group_variants(spelling.vocabulary(nothing)).count() == 0
    odd = spark.createDataFrame([(None, 3), ("word", None), ("word", 2), ("word", 5), ("", 4), ("a", 1)], "word string, n long")
    assert {r["word"]: (r["n"], r["n_near"], r["root"]) for r in spelling.group_variants(odd).collect()} == {
        "word": (7, 0, "word"), "": (4, 1, ""), "a": (1, 1, "")}


# Decontamination -----------------------------------------------------------------------------------

def test_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


test_words.__test__ = False


def hits(text, items, window=10):
    """Words, hit words and items of one text."""
    words, hit, ids = test_words(text), set(), set()
    for id_, item in items:
        item = test_words(item)
        size = min(window, len(item))
        for at in range(len(item) - size + 1) if size else ():
            for k in range(len(words) - size + 1):
                if words[k:k + size] == item[at:at + size]:
                    hit.update(range(k, k + size))
                    ids.add(id_)
    return len(words), len(hit), sorted(str(x) for x in ids - {None})


PASSAGE = prose(40, 25)


@pytest.fixture(scope="module")
def leaking():
    """Documents and items: leaks in other case and punctuation, short items, equal grams and ids, nulls."""
    inside = PASSAGE.split()
    items = [(1, PASSAGE), (2, "Only, three... words"), (10, PASSAGE), (3, None), (4, "?!"), (None, prose(41, 14)), (5, prose(42, 12)),
             (5, prose(43, 11)), (6, "émigré naïve"), (7, " ".join(inside[3:15]) + " tail")]
    texts = [
        (1, prose(1, 40) + "\n" + PASSAGE.upper() + "! " + prose(2, 30)), (2, "-- ".join(inside[5:16])), (3, " ".join(inside[5:14])), (4, None), (5, ""),
        (6, "only three words and only-three-words"), (7, prose(41, 14)), (8, prose(42, 12) + " x " + prose(43, 11)), (9, "Émigré naïve émigré NAÏVE"),
        (9, PASSAGE), (9, PASSAGE), (None, PASSAGE), (11, prose(3, 4000, 5000) + " " + PASSAGE + " " + prose(4, 30000, 900)), (12, prose(5, 60)),
        (13, "only three" + "\0" + "words\x7f12"), (14, "y" * 3000 + " only three words"),
    ]
    return items, texts


def frames(spark, leaking):
    items, texts = leaking
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3).withColumns(
        {"contamination": F.lit("own"), "hits_of": F.lit("own"), "n_words": F.lit(0)})
    return docs, spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))


# All in one broadcast set, or joined behind filters of two sizes, one of which lets nearly everything pass.
WAYS = [{}, {"most_bytes": 0}, {"most_bytes": 0, "filter_bits": 64}]


@pytest.mark.parametrize("way", WAYS, ids=str)
def test_contamination(spark, leaking, way):
    docs, benchmark = frames(spark, leaking)
    found, name = decontaminate.contamination(docs, benchmark, **way)
    assert found.columns == [*docs.columns, name]
    got = Counter((r["doc_id"], r["text"], r[name]["n_words"], r[name]["n_hit"], tuple(r[name]["items"])) for r in found.collect())
    expected = Counter()
    for id_, text in leaking[1]:
        n, hit, ids = hits(text, leaking[0])
        expected[id_, text, n, hit, tuple(ids)] += 1
    assert got == expected and sum(k[3] > 0 for k in expected) == 10


@pytest.mark.parametrize("way", WAYS, ids=str)
def test_decontamination_removes_spans_or_documents(spark, leaking, way):
    docs, benchmark = frames(spark, leaking)
    spans = decontaminate.decontaminate(docs, benchmark, **way)
    assert spans.columns == docs.columns and spans.count() == len(leaking[1])
    left = Counter((r["doc_id"], r["text"]) for r in spans.collect())
    untouched = Counter((i, t) for i, t in leaking[1] if not hits(t, leaking[0])[1])
    assert untouched <= left
    assert all(PASSAGE not in (t or "").lower() for _, t in left) and left[7, ""] == 1 and left[6, " and "] == 1
    first = prose(1, 40) + "\n" + "! " + prose(2, 30)
    assert left[1, first] == 1
    clean = decontaminate.decontaminate(docs, benchmark, remove="documents", **way)
    assert clean.columns == docs.columns and Counter((r["doc_id"], r["text"]) for r in clean.collect()) == untouched
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark, remove="rows")


@pytest.mark.parametrize("way", WAYS[:2], ids=str)
def test_nothing_to_decontaminate(spark, awkward, nothing, way):
    items = spark.createDataFrame([], "item_id long, text string")
    found, name = decontaminate.contamination(awkward, items, **way)
    assert found.filter(F.col(name)["n_hit"] > 0).count() == 0 and found.count() == awkward.count()
    assert decontaminate.contamination(nothing, items, **way)[0].count() == 0
    assert decontaminate.decontaminate(nothing, frames(spark, ([(1, "a b")], [(1, "x")]))[1], **way).count() == 0


def test_equal_hashes_of_other_words_are_no_hit():
    known = decontaminate.GramSet([("1", b"one two"), ("2", b"one two"), ("3", b"red blue")], 10)
    assert [i.tolist() for _, _, i in known.hits(decontaminate.Words(b"a One-two"))] == [[0, 1]]
    both = decontaminate.GramSet.__new__(decontaminate.GramSet)
    both.__dict__ = {**known.__dict__, "hashes": np.full(2, int(decontaminate.Words(b"one two").windows(2).view(np.int64)[0]))}
    assert [i.tolist() for _, _, i in both.hits(decontaminate.Words(b"one two"))] == [[0, 1]]


def test_a_texts_words_do_not_depend_on_its_pieces(monkeypatch):
    data = (prose(9, 3000) + " É" + "x" * 500 + " end").encode()
    whole = decontaminate.Words(data)
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    pieces = decontaminate.Words(data)
    assert (whole.hash == pieces.hash).all() and len(whole) == len(test_words(data.decode()))


def test_decontamination_query_digest(spark):
    for row in QUERIES["op12_decontaminate"](spark, SMALL).filter("n_items = 0").limit(1).collect():
        assert row["items_sha256"] == hashlib.sha256(b"").hexdigest() and not row["contaminated"]


# Whitening -----------------------------------------------------------------------------------------

def expected_whitening(vectors, components=16):
    """Numbers per usable vector, by eigenvectors of the covariance."""
    out = defaultdict(list)
    for id_, v in vectors:
        if v and all(c is not None and math.isfinite(c) and abs(c * 64) <= 2 ** 53 for c in v):
            out[len(v)].append((id_, [math.floor(64 * c) + 1_000_000 for c in v]))
    rows = {}
    for rows_of in out.values():
        fit = np.array(sorted({tuple(x) for _, x in rows_of}), dtype=object)
        n, sums = len(fit), fit.sum(axis=0)
        off = ((n * fit - sums) / n).astype(float)
        values, axes = np.linalg.eigh(off.T @ off / n)
        order = [k for k in np.argsort(-values) if values[k] > 1e-11 * max(values.max(), 1e-300)][:components]
        for id_, x in rows_of:
            whole = n * np.array(x, dtype=object) - sums
            y = (whole / n).astype(float)
            rows.setdefault(id_, []).append((n, int((whole ** 2).sum()), [y @ axes[:, k] / math.sqrt(values[k]) for k in order], (values / values.sum())[order]))
    return rows


def vectors_frame(spark, vectors, kind="double"):
    return spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>").repartition(4)


def whitened(frame):
    found = defaultdict(lambda: defaultdict(list))
    for r in frame.collect():
        found[r["vec_id"]][r["component"]].append(r)
    return found


@pytest.mark.parametrize("dim, count", [(5, 200), (24, 90), (20, 7), (1, 30)])
def test_whitening(spark, dim, count):
    rng = np.random.default_rng(dim)
    spread = rng.normal(size=(dim, dim)) * np.geomspace(1, 0.05, dim)
    vectors = [(k, (rng.normal(size=dim) @ spread).tolist()) for k in range(count)] + [(1000 + k, [0.5] * dim) for k in range(400)]
    expected, found = expected_whitening(vectors), whitened(whitening.whiten(vectors_frame(spark, vectors)))
    assert found.keys() == expected.keys()
    components = len(expected[0][0][2])
    assert components == min(16, dim, count)
    errors = {r["identity_error"] for by in found.values() for rows in by.values() for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9
    for k in range(components):
        ours = np.array([found[i][k + 1][0]["whitened"] for i in sorted(found)])
        theirs = np.array([expected[i][0][2][k] for i in sorted(found)])
        assert np.abs(ours - np.sign(ours @ theirs) * theirs).max() < 1e-6
    for id_, by in found.items():
        assert all(r["n"] == expected[id_][0][0] and r["deviation"] == expected[id_][0][1] for rows in by.values() for r in rows)
        assert np.allclose([by[k + 1][0]["explained"] for k in range(components)], expected[id_][0][3], rtol=1e-8)


def test_whitening_query(spark):
    """The registered query on its whole table."""
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected, found = expected_whitening(vectors), whitened(QUERIES["op13_whitening"](spark, SMALL))
    assert found.keys() == expected.keys() and all(sorted(by) == list(range(1, 17)) for by in found.values())
    for k in range(16):
        ours = np.array([found[i][k + 1][0]["whitened"] for i in sorted(found)])
        theirs = np.array([expected[i][0][2][k] for i in sorted(found)])
        assert np.abs(ours - np.sign(ours @ theirs) * theirs).max() < 1e-8
    for id_, by in found.items():
        assert all((r["n"], r["deviation"]) == expected[id_][0][:2] and r["identity_error"] < 1e-4 for rows in by.values() for r in rows)
        assert np.allclose([by[k + 1][0]["explained"] for k in range(16)], expected[id_][0][3], rtol=1e-8)


def test_whitening_of_awkward_vectors(spark):
    some = [(k, [k / 3.0, (k * k) % 7 / 2.0, -k / 5.0]) for k in range(12)]
    other = [(100 + k, [float(k % 3), k / 64.0]) for k in range(9)]
    odd = [(50, None), (51, [1.0, None, 2.0]), (52, [float("nan")] * 3), (53, [float("inf"), 0.0, 0.0]), (54, []), (55, [1e300, 0.0, 0.0]), (56, [1.0] * 7)]
    repeated = [(3, some[3][1]), (3, some[4][1]), (None, some[5][1])]
    vectors = some + other + odd + repeated
    frame = vectors_frame(spark, vectors).withColumns({"n": F.lit("own"), "w": F.lit(1), "dim": F.lit(2), "component": F.lit(3)})
    expected, found = expected_whitening(vectors), whitened(whitening.whiten(frame))
    del expected[56]  # one vector of its length: no component
    assert found.keys() == expected.keys()
    for id_, by in found.items():
        assert all(sorted(r["deviation"] for r in rows) == sorted(e[1] for e in expected[id_]) for rows in by.values())
        assert len(by) == len(expected[id_][0][2])
    assert len({rows[0]["identity_error"] for by in found.values() for rows in by.values()}) == 2
    for empty in (vectors_frame(spark, odd), vectors_frame(spark, []), vectors_frame(spark, [(k, [1.0, 2.0]) for k in range(5)])):
        assert whitening.whiten(empty).count() == 0


def test_whitening_keeps_large_numbers_apart(spark):
    """Differences of one step beside entries of 2 ** 40, and deviations that fit no long."""
    vectors = [(k, [2.0 ** 40, 2.0 ** 46 + (k % 4) / 64, k / 64]) for k in range(16)] + [(99, [2.0 ** 40, 2.0 ** 46, 2.0 ** 44])]
    found, expected = whitened(whitening.whiten(vectors_frame(spark, vectors))), expected_whitening(vectors)
    assert all(r["deviation"] is None for rows in found[99].values() for r in rows) and expected[99][0][1] >= 2 ** 63
    near = [(k, [2.0 ** 40, 2.0 ** 46 + (k % 4) / 64, k / 64]) for k in range(16)]
    found, expected = whitened(whitening.whiten(vectors_frame(spark, near))), expected_whitening(near)
    for id_, by in found.items():
        assert all(r["deviation"] == expected[id_][0][1] for rows in by.values() for r in rows)
        assert np.allclose([abs(by[k + 1][0]["whitened"]) for k in range(2)], np.abs(expected[id_][0][2]), atol=1e-9)


def test_matrices_are_added_up_whatever_a_pack_or_task_holds(spark, monkeypatch):
    rows = spark.createDataFrame([(k, 2, [k % 5, k % 3]) for k in range(40)], "id long, dim int, x array<long>").repartition(4)
    x = np.array([r["x"] for r in rows.collect()])
    sums = x.sum(axis=0).tolist()
    for pack, held in ((1, 1), (6, 8), (1 << 16, 1 << 22)):
        monkeypatch.setattr(whitening, "PACK", pack)
        monkeypatch.setattr(whitening, "MOST_HELD", held)
        packs = whitening.packed(rows, rows.schema["id"].dataType)
        assert packs.agg(F.max(F.size("x"))).first()[0] in {1: (2,), 6: (6,), 1 << 16: range(20, 81)}[pack]
        packs = packs.crossJoin(spark.createDataFrame([(40, sums)], "n long, sums array<long>"))
        lines = sorted((r["line"], r["sums"]) for r in whitening._lines(packs, lambda p: whitening._scatter(p["y"])).collect())
        off = x - x.mean(axis=0)
        assert np.allclose([s for _, s in lines], off.T @ off)


def test_factor_and_rotations():
    rng = np.random.default_rng(0)
    for dim, rank in ((1, 1), (2, 1), (7, 7), (30, 12), (33, 33)):
        half = rng.normal(size=(dim, rank)) * np.geomspace(1, 1e-4, rank)
        matrix = half @ half.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape == (dim, rank) and np.allclose(factor @ factor.T, matrix)
        pivots = [int(np.flatnonzero(factor[:, k] == np.abs(factor[:, k]).max())[0]) for k in range(rank)]
        assert (np.triu(factor[pivots], 1) == 0).all()  # triangular in the order of the pivots
        rotated = whitening.jacobi_columns(factor)
        assert np.allclose(rotated.T @ rotated, np.diag(np.sort(np.linalg.eigvalsh(matrix))[::-1][:rank]), atol=1e-13 * np.trace(matrix))
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)

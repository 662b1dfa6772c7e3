"""WARC, search, URL filters, components and the helpers under them, against plain versions."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from plain import groups, shingles, words
from pyspark.sql import functions as F

from tradewind.llm import topk, urls, warc
from tradewind.llm.batches import whole_groups
from tradewind.llm.components import components
from tradewind.llm.hashing import PIECE, shingle_hashes, word_hashes
from tradewind.session import scratch_path

PAGES = "page_id long, url string, html string, judged string, digest string"
BIG, OTHER = "<p>" + "same " * 400, "<p>" + "é" * 500


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "own", "own") for r in rows], PAGES).repartition(3)


def test_warc_round_trip(spark):
    rows = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (5, None, BIG), (5, "http://a/5", BIG), (None, "http://a/n", BIG),
            (3, "http://a/3", "small"), (4, "http://a/4", "small"), (6, "http://a/\r\nX: 1", None), (7, "", ""),
            (None, "http://a/m", OTHER), (8, "http://a/8", "x\r\n\r\nWARC/1.1\r\n" * 90), (9, "http://a/9", "é" * 3_000_000)]
    index = warc.write_archives(pages_of(spark, rows))
    found = Counter(
        (r["id"], r["record_type"], r["refers_to"], r["payload_bytes"], None if r["payload"] is None else bytes(r["payload"]))
        for r in warc.read_records(index).collect())
    expected = Counter()
    for id_, _, html in rows:
        again = html == BIG and id_ != 5
        body = (html or "").encode()
        expected[id_, "revisit" if again else "response", 5 if again else None, len(body), None if again else body] += 1
    assert found == expected
    some = warc.read_records(index.filter("id IN (2, 9)"), with_payload=False).collect()
    assert sorted((r["id"], r["payload"]) for r in some) == [(2, None), (9, None)]
    assert {r["url"] for r in index.collect()} == {r[1] for r in rows}


def test_warc_of_nothing(spark):
    index = warc.write_archives(pages_of(spark, []))
    assert index.count() == 0 and warc.read_records(index).count() == 0


def test_reading_tasks_follow_the_archives_bytes(spark, monkeypatch):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://p.com/', id) AS url", "repeat(sha2(string(id), 512), 20) AS html")
    index = warc.write_archives(pages)
    size = index.selectExpr("sum(length)").first()[0]
    monkeypatch.setattr(warc, "TASK_BYTES", size // 7)
    records = warc.read_records(index)
    assert records.select(F.spark_partition_id()).distinct().count() in (7, 8) and records.count() == 400


def test_ranges_are_joined_up_to_their_limits():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + warc.GAP_BYTES, 5), ("a", 21 + 2 * warc.GAP_BYTES, 5), ("b", 0, 5),
            ("b", 5, warc.READ_BYTES), ("b", 5 + warc.READ_BYTES, 1)]
    assert [len(run) for run in warc._ranges(rows)] == [3, 1, 1, 1, 1]


def best(vectors, k, every):
    """Plain search over ``(id, vector)``."""
    usable = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in vectors
              if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for place, (query, q) in enumerate(usable):
        if query is None or query % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0) for at, (i, v) in enumerate(usable)
                        if at != place and len(v) == len(q))
        for rank, (score, null, id_) in enumerate(scored[:k], 1):
            out[query, rank, None if null else id_, -score] += 1
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 7)])
def test_search(spark, blocks):
    random_ = np.random.default_rng(5)
    rows = [(k, random_.normal(size=8).tolist()) for k in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(30)]  # ties
    rows += [(20, rows[3][1]), (20, rows[3][1]), (None, rows[0][1]), (None, None), (40, None), (60, [1.0, None]), (80, [float("nan")] * 8),
             (100, [float("inf")] * 8), (300, [1.0, 2.0]), (301, [0.5, -2.0]), (320, []), (340, [1e3] * 8), (360, [1e8] * 8)]
    vectors = spark.createDataFrame([(i, v, "own") for i, v in rows], "vec_id long, embedding array<double>, vector string")
    found = topk.search(vectors.repartition(4), k=20, query_block=blocks[0], block=blocks[1])
    assert Counter((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect()) == best(rows, 20, 20)


def test_search_of_nothing(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_bounds_hold():
    random_ = np.random.default_rng(6)
    a, b = random_.integers(-50, 50, (40, 11)), random_.integers(-50, 50, (60, 11))
    scores = topk._scores(a, b)
    assert (scores == a @ b.T).all()
    last = np.inf
    for segments in topk.RESOLUTIONS:
        bound = topk._features(a, segments) @ topk._features(b, segments).T
        assert (bound >= scores - 1e-6).all()
        assert bound.mean() <= last
        last = bound.mean()
    bar = np.sort(scores, axis=1)[:, -3]
    stay = topk._survivors(a, b, bar)
    assert set(np.flatnonzero((scores >= bar[:, None]).any(axis=0))) <= set(stay)


def test_url_rules_and_aliases(spark):
    link = '<html><link rel="canonical" href="{}"></html>'.format
    rows = [
        (1, "http://x.net/a", None), (2, "http://en.Example.NET/en/x?q#f", ""), (3, "https://example.com/de/", ""), (4, "https://example.com/den", ""),
        (5, "http://a.org/fr/1", ""), (6, "http://borg/fr/1", ""), (7, None, link("http://x.net/")), (8, "no url", link("http://x.net/")), (9, "", ""),
        (10, "http://p.com/1", link("http://p.com/2")), (11, "http://p.com/2#top", '<meta http-equiv="refresh" content="0; url=http://bad.net/x">'),
        (12, "http://q.com/1", "<LINK href='/2' REL='canonical'>"), (13, "http://q.com/2", link("//m.net/z")),
        (14, "http://q.com/3/", link("../2")), (14, "http://r.com/a/b", link("c&amp;d")), (15, "http://r.com/a/c&d", link("http://s.net/y")),
        (16, "http://r.com/a/d", link("http://a.org/fr/2")), (17, "http://S.net/y", link("http://r.com/a/d")), (18, "http://h.com", link("#x")),
        (19, "http://t.com/?a=1", link("?a=2")), (20, "http://t.com/?a=2", link("http://w.net")), (20, "http://t.com/?a=2", link("http://w.net")),
        (21, "http://u.com/1", '<link rel="stylesheet" href="http://x.net/">'), (22, "ftp://V.net:80/Path;p?x=/", "")]
    judged, name = urls.judge_urls(pages_of(spark, rows))
    found = {(r["page_id"], r["url"]): tuple(r[name]) for r in judged.collect()}
    assert judged.columns[:5] == ["page_id", "url", "html", "judged", "digest"] and judged.count() == len(rows)
    verdicts = {key: value[3] for key, value in found.items()}
    assert {k for k, _ in (key for key, v in verdicts.items() if v == "block")} == {1, 3, 10, 11, 12, 13, 17, 19, 20}
    assert found[2, "http://en.Example.NET/en/x?q#f"] == ("en.example.net", "/en/x", "example.net/en/", "allow")
    assert found[22, "ftp://V.net:80/Path;p?x=/"] == ("v.net:80", "/Path;p", None, "allow")  # the port is part of the host
    assert found[7, None] == ("", "", None, "allow") == found[8, "no url"]
    assert found[5, "http://a.org/fr/1"][2] == "org/fr/" and found[6, "http://borg/fr/1"][2] is None
    # One alias is allowed by a rule, so the rule for another does not reach those without one.
    assert verdicts[14, "http://r.com/a/b"] == verdicts[15, "http://r.com/a/c&d"] == "allow"


def test_unquoted_refresh_and_further_rel_tokens(spark):
    tags = {
        1: "<meta http-equiv=refresh content=0;url=http://x.net/>", 2: "<META content=5;URL=http://x.net/a http-equiv=refresh>",
        3: '<link rel="nofollow canonical" href="http://x.net/">', 4: "<link href=http://x.net/ rel='alternate\tCANONICAL x'>",
        5: "<link rel=nofollow href=http://x.net/canonical>", 6: '<link rel="nofollow" title="a canonical" href="http://x.net/">',
        7: "<meta http-equiv=refresh content=5>", 8: "<link rel='x-canonical' href=http://x.net/>",
        9: "<meta http-equiv=refresh content='0; url=http://x.net/'>", 10: "<link rel=canonical href=http://x.net/>"}
    judged, name = urls.judge_urls(pages_of(spark, [(k, f"http://p{k}.com/", tag) for k, tag in tags.items()]))
    found = {r["page_id"]: r[name]["verdict"] for r in judged.collect()}
    assert {k for k, v in found.items() if v == "block"} == {1, 2, 3, 4, 9, 10}


def test_more_redirects(spark):
    more = spark.createDataFrame([("http://a.com/1", "http://z.net/"), (None, "http://a.com/2")], "a string, b string")
    rows = [(1, "http://a.com/1", ""), (2, "http://a.com/2", "")]
    judged, name = urls.judge_urls(pages_of(spark, rows), more_edges=more)
    assert {r["page_id"]: r[name]["verdict"] for r in judged.collect()} == {1: "block", 2: "allow"}
    assert urls.judge_urls(pages_of(spark, []))[0].count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random", "nothing"])
def test_components(spark, shape):
    random_ = random.Random(4)
    edges = {"path": [(k, k + 1) for k in range(60)], "star": [(30, k) for k in range(60)] + [(100, 101), (100, 101), (7, 7)],
             "random": [(random_.randrange(80), random_.randrange(80)) for _ in range(60)] + [(None, 3)], "nothing": []}[shape]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    root = groups(110, real)
    assert found == {k: root[k] for pair in real for k in pair}


def test_word_hashes_follow_the_words():
    texts = ["", " ", "a", "a b a", "b\ta\n\n c", "é é \x0b\x0c\x1c x", "word " * 40_000 + "end", "x" * (PIECE + 5) + " y"]
    known = {}
    for text in texts:
        hashes = word_hashes(text.encode())
        assert len(hashes) == len(words(text))
        for word, hash_ in zip(words(text), hashes.tolist()):
            assert known.setdefault(word, hash_) == hash_
        if len(hashes) < 100:
            assert len(shingle_hashes(hashes, 5)) == len(shingles(text))
    assert len(set(known.values())) == len(known)
    assert len(word_hashes(None)) == 0


def test_whole_groups_are_not_cut():
    keys = [1] * 5 + [2] + [3] * 9 + [4, 4]
    frames = [pd.DataFrame({"k": keys[at:at + 2], "v": range(at, min(at + 2, len(keys)))}) for at in range(0, len(keys), 2)]
    out = list(whole_groups(iter([frames[0].iloc[:0], *frames]), ["k"]))
    assert [v for frame in out for v in frame["v"]] == list(range(len(keys)))
    seen = [set(frame["k"]) for frame in out]
    assert sum(map(len, seen)) == len(set().union(*seen))


def test_index_names_files_in_the_given_folder(spark):
    folder = scratch_path(spark, "archives")
    index = warc.write_archives(pages_of(spark, [(1, "http://a/", "x")]), folder)
    assert index.filter(F.col("file").startswith(folder)).count() == 1

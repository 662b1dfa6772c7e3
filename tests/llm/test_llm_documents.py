"""Operators on documents against plain versions, on awkward rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from plain import base_numbers, copies, cut_lines, groups, keeps, lm_log_prob, similar_pairs, targets, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SMALL, prose
from tradewind.llm import bpe, jaccard, lines, lm, mixing, quality, tokens
from tradewind.llm.hashing import word_hashes

BYTES, LOWER = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def kept_columns(before, after):
    assert after.columns[:len(before.columns)] == before.columns


def by_row(df, *columns):
    return Counter((r["doc_id"], r["text"], *[r[c] for c in columns]) for r in df.collect())


def test_quality(awkward, awkward_rows, nothing):
    judged, name = quality.judge(awkward)
    kept_columns(awkward, judged)
    flat = judged.select("doc_id", "text", *[F.col(name)[m].alias(m) for m in quality.BASE],
                         (~F.col(name)["base_failed"] & F.col(name)["reason"].isNull()).alias("kept"))
    assert by_row(flat, *quality.BASE, "kept") == Counter((r[0], r[1], *base_numbers(r[1]), keeps(r[1])) for r in awkward_rows)
    assert quality.judge(nothing)[0].count() == 0


def test_quality_keeps_good_rows_whole(awkward, awkward_rows, nothing):
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns
    assert by_row(kept) == Counter((r[0], r[1]) for r in awkward_rows if keeps(r[1]))
    assert quality.keep_good(nothing).count() == 0


def test_order_of_rules_does_not_change_the_verdict(awkward):
    rules = quality.BASE_RULES + quality.RULES
    first = by_row(quality.keep_good(awkward, rules))
    assert by_row(quality.keep_good(awkward, rules[::-1], sample_rows=1)) == first


def test_rules_are_ordered_by_rejections_per_cost(spark):
    docs = spark.createDataFrame([(k, prose(k, 80)) for k in range(300)], "doc_id long, text string")
    never = quality.Rule("never", lambda m: m["n_repeat_words"] < 0)
    always = quality.Rule("always", lambda m: m["n_words"] > 0)
    assert [r.name for r in quality.order_rules(docs, [never, always])] == ["always", "never"]


def test_mixing(awkward, awkward_rows, nothing):
    planned, name = mixing.mix_plan(awkward)
    kept_columns(awkward, planned)
    rows = [(r[0], r[1], r[3]) for r in awkward_rows]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(words(text))
    wanted = targets(dict(sizes))
    got = by_row(planned.select("doc_id", "text", "source", f"{name}.*"), "source", "size", "source_size", "target", "copies")
    assert got == Counter(
        (i, t, s, len(words(t)), sizes[s], wanted[s], n) for (i, t, s), n in zip(rows, copies(rows)))
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    again = Counter()
    for (i, t, _), n in zip(rows, copies(rows)):
        again[i, t] += n
    assert by_row(mixed) == +again
    assert mixing.mix(nothing).count() == 0


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("same words in every one of them").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    planned, name = mixing.mix_plan(docs)
    for row in planned.groupBy("source").agg(
            F.sum(F.col(name)["size"] * F.col(name)["copies"]).alias("taken"), F.first(f"{name}.target").alias("target")).collect():
        assert abs(row["taken"] / row["target"] - 1) < 0.12


def test_line_dedup(awkward, awkward_rows, nothing):
    cut = lines.dedup_lines(awkward, removed="n_removed")
    kept_columns(awkward, cut)
    texts = cut_lines([(r[0], r[1]) for r in awkward_rows])
    expected = Counter(zip((r[0] for r in awkward_rows), texts))
    assert by_row(cut) == expected
    gone = {(r[0], t): len((r[1] or "").split("\n")) - len(t.split("\n")) if t else len((r[1] or "").split("\n"))
            for r, t in zip(awkward_rows, texts) if r[1] and t != r[1]}
    assert {(r["doc_id"], r["text"]): r["n_removed"] for r in cut.filter("n_removed > 0").collect()} == gone
    assert lines.dedup_lines(nothing).count() == 0


def test_line_dedup_keeps_the_first_occurrence_whole(spark):
    brackets, seven = "}\n}\n}\n}\nsome other line here", "\n".join("x" * 7)
    docs = spark.createDataFrame([(1, brackets), (2, seven), (3, "y\n}\n}\n}\nz")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in lines.dedup_lines(docs).collect()} == {1: brackets, 2: "x\nx\nx", 3: "y\nz"}


def test_jaccard_join(awkward, awkward_rows, nothing):
    texts = [r[1] for r in awkward_rows]
    pairs = similar_pairs(texts)
    group = groups(len(texts), pairs)
    links = Counter(k for pair in pairs for k in pair)
    smallest = {}
    for k, row in enumerate(awkward_rows):
        if row[0] is not None:
            smallest[group[k]] = min(row[0], smallest.get(group[k], row[0]))
    expected = Counter((r[0], smallest.get(group[k]), links[k]) for k, r in enumerate(awkward_rows))
    found = jaccard.near_duplicates(awkward)
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in found.collect()) == expected
    assert jaccard.near_duplicates(nothing).count() == 0


def test_keeping_one_of_each_group(awkward, awkward_rows, nothing):
    kept = jaccard.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[1] == 1 and not ids[2] and not ids[3] and ids[9] == 1 and not ids[10]
    assert ids[5] == ids[6] == ids[4] == ids[19] == 1
    assert jaccard.keep_one(nothing).count() == 0


@pytest.mark.parametrize("slices", [(256, 128, 400_000), (4, 3, 400_000), (256, 128, 500)])
def test_jaccard_loses_no_link_of_a_large_group(spark, slices):
    """Near copies of one text, some of them copies of each other, whole or in cells."""
    base = prose(11, 200, 5000).split()
    texts = []
    for k in range(40):
        copy = list(base)
        for at in range(k % 5):
            copy[(k * 37 + at * 41) % 200] = f"x{k}"
        texts.append(" ".join(copy))
    texts += [prose(100 + k, 150, 5000) for k in range(20)] + texts[3:6]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    forest = jaccard.Forest(node_slice=slices[0], group_slice=slices[1], slice_shingles=slices[2])
    pairs = similar_pairs(texts)
    links = Counter(k for pair in pairs for k in pair)
    group = groups(len(texts), pairs)
    for row in jaccard.near_duplicates(docs, forest=forest).collect():
        assert (row["n_links"], row["class_id"]) == (links[row["id"]], group[row["id"]])


def test_prefixes_are_shortened_until_the_target():
    forest = jaccard.Forest()
    depth = forest.first_depth()
    assert forest.chance(0.8, depth) >= 0.999 > forest.chance(0.8, depth + 1)
    assert jaccard.Forest(target_recall=1.0).first_depth() == 1


def test_token_counts(awkward, awkward_rows, nothing):
    library = Tokenizer.from_file(BYTES)
    counted = awkward.withColumn("n", tokens.token_count(F.col("text"), BYTES))
    assert by_row(counted, "n") == Counter(
        (r[0], r[1], len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in awkward_rows)
    assert nothing.withColumn("n", tokens.token_count(F.col("text"), BYTES)).count() == 0


def test_encoding_and_decoding(awkward, awkward_rows, nothing):
    library = Tokenizer.from_file(LOWER)
    library.no_padding()
    library.no_truncation()
    coded = awkward.withColumn("ids", bpe.encode(F.col("text"), LOWER)).withColumn("back", bpe.decode(F.col("ids"), LOWER))
    expected = Counter()
    for r in awkward_rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        expected[r[0], r[1], tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r["doc_id"], r["text"], tuple(r["ids"]), r["back"]) for r in coded.collect()) == expected
    assert nothing.withColumn("ids", bpe.encode(F.col("text"), LOWER)).count() == 0


def test_words_in_use_outlive_a_full_table(monkeypatch):
    """A table of known words stays in bounds, and a word met all the time is encoded once."""
    monkeypatch.setattr(bpe, "KNOWN_RUNS", 50)
    library, coder, encoded = Tokenizer.from_file(LOWER), bpe.Transducer(LOWER), Counter()
    short = coder._short_word
    monkeypatch.setattr(coder, "_short_word", lambda word: encoded.update([word]) or short(word))
    for k in range(60):
        text = " ".join(f"often often, {a}{b}{k % 7}x-{a}{b}" for a in "abcde" for b in "fghij"[:1 + k % 5])
        assert coder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder.known) <= 50 and len(coder.earlier) <= 50
    assert encoded["often"] == 1


def test_different_words_take_steps_together(monkeypatch):
    """Short words are not encoded one by one, and long ones, special strings and blocks make no difference."""
    random_ = random.Random(4)
    letters = "abcdeilnorst'sé€ﬁ0._<|>\x1c\x85 \n" * 2 + "AΣöß日😀"
    texts = ["".join(random_.choices(letters, k=random_.randint(0, 400))) for _ in range(150)]
    texts[7:7] = ["", " \n", "<|endoftext|>", "a<|ENDOFTEXT|>b<|endoftext|><|startoftext|>c", "x" * 127 + " " + "y" * 128 + " " + "ab" * 900, "don't I'LL ''s"]
    library, coder, alone = Tokenizer.from_file(LOWER), bpe.Transducer(LOWER), []
    library.no_padding()
    library.no_truncation()
    word = coder._word
    monkeypatch.setattr(coder, "_word", lambda one: alone.append(one) or word(one))
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts]
    for block, together in ((bpe.BLOCK, True), (3000, False), (1, False)):
        monkeypatch.setattr(bpe, "BLOCK", block)
        alone.clear()
        values, ends = coder.encoded([*texts, None])
        assert [values[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [*expected, []]
        assert not together or all(len(one.encode()) >= 128 for one in alone)


def test_encoding_with_decoding_is_one_encoding(spark, awkward, capsys):
    """The query and the pipeline's stage encode a text once for its ids and its decoded text."""
    import corpus_pipeline
    from tradewind.llm.queries import QUERIES

    for df in (QUERIES["op6_bpe"](spark, SMALL), corpus_pipeline.encode_documents(spark, awkward, SMALL)):
        capsys.readouterr()
        df.explain("formatted")
        plan = capsys.readouterr().out
        assert plan.count("coded(") == 1 and "pythonUDF1" not in plan, plan
    both = awkward.select("text", bpe.encode_and_decode(F.col("text"), LOWER).alias("coded")).select("text", "coded.*")
    ids = bpe.encode(F.col("text"), LOWER)
    apart = awkward.select("text", ids.alias("ids"), bpe.decode(ids, LOWER).alias("back"))
    assert Counter(map(str, map(tuple, both.collect()))) == Counter(map(str, map(tuple, apart.collect())))


def test_token_pairs_that_share_a_place(monkeypatch):
    """What is known of pairs stays right when nearly every pair takes another's place."""
    monkeypatch.setattr(bpe, "KNOWN_FITS", 3)
    library, coder = Tokenizer.from_file(LOWER), bpe.Transducer(LOWER)
    text = " ".join(prose(k, 20) for k in range(20)) + " " + " ".join(f"word{chr(97 + k % 26)}ing{chr(97 + k // 26)}s" for k in range(400))
    for _ in range(2):
        assert coder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_decoding_of_awkward_lists(spark):
    rows = [(1, [5, 900, 40]), (2, []), (3, None), (4, [10**9]), (5, [77] * 9000)]
    ids = spark.createDataFrame(rows, "id long, ids array<int>").coalesce(1)
    got = {r["id"]: r["text"] for r in ids.select("id", bpe.decode(F.col("ids"), LOWER).alias("text")).collect()}
    machine = bpe.Decoder(LOWER)
    assert got == {id_: machine.text(list_ or ()) for id_, list_ in rows} and got[2] == got[3] == ""


def test_lm_scores(awkward, awkward_rows, nothing):
    shape = lm.Shape(classes=4, places=8, width=3, hidden=5, batch=64, replica_words=500)
    scored, name = lm.score_documents(awkward, shape=shape)
    kept_columns(awkward, scored)
    net = lm._views(shape, lm.train(awkward, shape=shape))
    for row in scored.collect():
        around, found = lm.examples(shape, (row["text"] or "").encode())
        assert row[name]["n_words"] == len(words(row["text"]))
        assert (row[name]["mean_log_prob"] is None) == (len(found) == 0)
        if len(found):
            one = float(lm._forward(shape, net, around, found).sum())
            assert abs(row[name]["log_prob"] - one) < 1e-3 * abs(one)
    assert lm.score_documents(nothing, shape=shape)[0].count() == 0


def test_lm_scores_word_by_word(awkward):
    shape = lm.Shape(classes=4, places=8, width=3, hidden=5, batch=64, replica_words=500)
    weights = lm.train(awkward, shape=shape)
    short = awkward.filter("text IS NULL OR length(text) < 20000")
    scored, name = lm.score_documents(short, awkward, shape=shape)
    for row in scored.select("text", name).distinct().collect():
        buckets = [int(word_hashes(w.encode())[0]) % shape.buckets for w in words(row["text"])]
        one = lm_log_prob(buckets, weights, 4, 8, 2, 3, 5)
        assert abs(row[name]["log_prob"] - one) <= 1e-4 * abs(one)


def test_lm_hashes_short_texts_together(awkward_rows, monkeypatch):
    """The words and neighbours of consecutive texts are those of each alone, and short texts share a call."""
    texts, calls, together = [r[1] for r in awkward_rows] * 3, [], lm.text_hashes
    monkeypatch.setattr(lm, "text_hashes", lambda some: calls.append(len(some)) or together(some))
    shape, column = lm.Shape(side=3), pa.array([t if t is None else t.encode() for t in texts], pa.binary())
    for size in (1 << 18, 1):
        monkeypatch.setattr(lm, "TOGETHER", size)
        calls.clear()
        around, found, counts = [], [], []
        for hashes, some in lm._hashed(column):
            counts += some.tolist()
            for whole, part in zip((around, found), lm._examples(shape, hashes, some)):
                whole.append(part)
        assert counts == [len(words(t)) for t in texts] and sum(calls) == len(texts)
        assert size == 1 or len(calls) <= len(texts) / 5
        one = [lm.examples(shape, (t or "").encode()) for t in texts]
        assert (np.concatenate(around) == np.concatenate([a for a, _ in one])).all()
        assert (np.concatenate(found) == np.concatenate([f for _, f in one])).all()
        assert all(f.tolist() == (word_hashes((t or "").encode()) % np.uint64(shape.buckets)).tolist() for t, (_, f) in zip(texts, one))


def test_lm_finds_common_words_by_leading_bits():
    random_ = np.random.default_rng(2)
    close = np.arange(40, dtype=np.uint64) * np.uint64(3) + np.uint64(2**40)  # all of the same leading bits
    some = np.unique(np.concatenate([random_.integers(0, 2**64, 500, dtype=np.uint64), close]))
    asked = np.concatenate([some, some + np.uint64(1), random_.integers(0, 2**64, 500, dtype=np.uint64), np.array([0, 2**64 - 1], dtype=np.uint64)])
    for known in (some, some[:1], some[-1:], close, np.append(some, np.uint64(2**64 - 1)), some[:0]):
        at, found = lm.Known(known, np.zeros(len(known)), np.zeros(1)).places(asked)
        assert (found == np.isin(asked, known)).all() and (not len(known) or (known[at[found]] == asked[found]).all())


def test_lm_shares_hold_all_texts(spark):
    docs = spark.range(1000).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS text")
    for tasks, rounds in ((1, 7), (3, 7), (16, 7), (7, 7), (5, 1)):
        shares = [[r["text"] for r in s.collect()] for s in lm._shares(docs.repartition(tasks), rounds)]
        assert len(shares) == rounds and sorted(x for s in shares for x in s) == sorted(str(k).encode() for k in range(1000))


def test_lm_shares_are_cut_finely(spark):
    """A round's share of a few large tasks has a file for each replica, so that no core waits for another."""
    docs = spark.range(1200).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS text")
    for tasks, rounds, pieces in ((4, 3, 12), (5, 4, 16), (2, 3, 9), (8, 3, 9)):
        shares = list(lm._shares(docs.repartition(tasks), rounds, pieces))
        found = [[r["text"] for r in s.collect()] for s in shares]
        assert len(shares) == rounds and sorted(x for s in found for x in s) == sorted(str(k).encode() for k in range(1200))
        assert all(len(s.inputFiles()) >= min(tasks, pieces // rounds) for s in shares)
        assert max(map(len, found)) <= 2 * min(map(len, found))


def test_lm_deals_files_by_replicas(spark, monkeypatch):
    """Training asks for as many files as there are replicas to train."""
    asked, shares = [], lm._shares
    monkeypatch.setattr(lm, "_shares", lambda texts, rounds, pieces: asked.append((rounds, pieces)) or shares(texts, rounds, pieces))
    docs = spark.createDataFrame([(k, "a b c d e f g h i j") for k in range(80)], "doc_id long, text string").repartition(3)
    lm.train(docs, shape=lm.Shape(classes=2, places=4, batch=16, replica_words=50))
    assert asked == [(4, 16)]


def test_lm_large_weights():
    """Logits whose exponentials would not fit, or just fit, score as in plain Python."""
    shape = lm.Shape(classes=3, places=4, width=2, hidden=3)
    random = np.random.default_rng(6)
    around, found = random.integers(0, 13, (40, 4)), random.integers(0, 12, 40)
    for factor in (1, 30, 100, 1000):
        weights = (lm.start(shape) + random.normal(0, 0.5, shape.size)).astype(np.float32) * np.float32(factor)
        net = lm._views(shape, weights)
        learn = lm._views(shape, np.zeros(shape.size, dtype=np.float32))
        exact = lm._forward(shape, {k: v.astype(np.float64) for k, v in net.items()}, around, found)
        for got in (lm._forward(shape, net, around, found), lm._forward(shape, net, around, found, learn)):
            assert np.allclose(got, exact, rtol=1e-4, atol=1e-4 * factor)
        assert all(np.isfinite(g).all() for g in learn.values())
    buckets = found.tolist()
    text_around = np.array([[buckets[p] if 0 <= p < 40 else 12 for p in (k - 2, k - 1, k + 1, k + 2)] for k in range(40)])
    one = lm_log_prob(buckets, weights, 3, 4, 2, 2, 3)
    assert abs(lm._forward(shape, net, text_around, found).sum() - one) <= 1e-3 * abs(one)


def test_words_end_at_blanks_only():
    blanks = {byte for byte in range(256) if len(word_hashes(b"a" + bytes([byte]) + b"a")) == 2}
    assert blanks == {0x20, *range(0x09, 0x0E)}


def test_lm_gradients():
    shape = lm.Shape(classes=3, places=4, width=2, hidden=3)
    random = np.random.default_rng(0)
    weights = lm.start(shape).astype(np.float64)
    weights += random.normal(0, 0.3, len(weights))
    around, found = random.integers(0, 13, (50, 4)), random.integers(0, 12, 50)
    gradient = np.zeros(len(weights))
    lm._forward(shape, lm._views(shape, weights), around, found, lm._views(shape, gradient))
    loss = lambda w: -lm._forward(shape, lm._views(shape, w), around, found).mean()
    step = 1e-5
    for k in random.choice(len(weights), 60, replace=False):
        one = np.zeros(len(weights))
        one[k] = step
        assert abs((loss(weights + one) - loss(weights - one)) / (2 * step) - gradient[k]) < 1e-6


def test_lm_prefers_held_out_text_in_order(spark):
    """Words that follow a rule score better in order than shuffled, in texts not trained on."""
    random = np.random.default_rng(3)

    def sentence():
        at = int(random.integers(50))
        return [f"w{(at + 7 * k) % 50}" for k in range(60)]

    training = [(k, " ".join(sentence())) for k in range(400)]
    held = [sentence() for _ in range(30)]
    tests = [(k, " ".join(s)) for k, s in enumerate(held)] + [(100 + k, " ".join(random.permutation(s))) for k, s in enumerate(held)]
    schema, shape = "doc_id long, text string", lm.Shape(classes=8, places=16, batch=256)
    scored, name = lm.score_documents(
        spark.createDataFrame(tests, schema), spark.createDataFrame(training, schema).coalesce(2), shape=shape)
    found = {r["doc_id"]: r[name]["mean_log_prob"] for r in scored.collect()}
    better = sum(found[k] > found[100 + k] for k in range(30))
    assert better >= 27 and np.mean([found[k] for k in range(30)]) > -np.log(128)


def test_lm_tells_the_words_of_a_bucket_apart(awkward, awkward_rows, nothing):
    shape = lm.Shape(classes=3, places=7, width=3, hidden=5, batch=64)
    scored, name = lm.score_words(awkward, shape=shape, common=40)
    kept_columns(awkward, scored)
    assert scored.columns == [*awkward.columns, name]
    net = lm._views(shape, lm.train(awkward, shape=shape))
    counts = Counter(w for r in awkward_rows for w in words(r[1]))
    bucket = {w: int(word_hashes(w.encode())[0]) % shape.buckets for w in counts}
    totals = Counter()
    for word, n in counts.items():
        totals[bucket[word]] += n
    got = scored.collect()
    assert len(got) == len(awkward_rows)
    for row in got:
        around, found = lm.examples(shape, (row["text"] or "").encode())
        inside = sum(np.log(counts[w] / (totals[bucket[w]] + 1)) for w in words(row["text"]))
        one = float(lm._forward(shape, net, around, found).sum()) + inside if len(found) else 0.0
        assert row[name]["n_words"] == len(found) and abs(row[name]["log_prob"] - one) <= 1e-3 * abs(one)
        assert (row[name]["mean_log_prob"] is None) == (len(found) == 0)
    assert lm.score_words(nothing, shape=shape)[0].count() == 0


def test_lm_scores_of_unknown_words(spark):
    """A word that was not trained on shares its bucket's one extra place; the bucket's words are likelier."""
    schema, shape = "doc_id long, text string", lm.Shape(classes=1, places=1)
    seen, asked = [(1, "a a a b b c")], [(1, "a"), (2, "b"), (3, "c"), (4, "new"), (5, "a"), (6, None)]
    scored, name = lm.score_words(
        spark.createDataFrame(asked, schema), spark.createDataFrame(seen, schema), shape=shape, common=0)
    found = {r["doc_id"]: r[name]["log_prob"] for r in scored.collect()}
    assert [round(np.exp(found[k]) * 7, 6) for k in range(1, 7)] == [3, 2, 1, 1, 3, 7]


def test_lm_learns_more_from_more_input(spark):
    """Held-out text in the order of a rule gets likelier with the words that are trained on, and rounds grow."""
    random = np.random.default_rng(5)

    def sentence():
        at = int(random.integers(50))
        return " ".join(f"w{(at + 7 * k) % 50}" for k in range(60))

    schema, shape = "doc_id long, text string", lm.Shape(classes=8, places=16, batch=256, replica_words=2000)
    training = spark.createDataFrame([(k, sentence()) for k in range(2400)], schema).coalesce(2)
    held = [lm.examples(shape, sentence().encode()) for _ in range(30)]
    found = []
    for n in (40, 600, 2400):
        net = lm._views(shape, lm.train(training.filter(f"doc_id < {n}"), shape=shape))
        found.append(np.mean([lm._forward(shape, net, *one).mean() for one in held]))
    assert found[1] > 0.7 * found[0] and found[2] > 0.7 * found[1], found
    assert [lm.rounds_of(lm.Shape(), n) for n in (0, 2_000_000, 8_000_000, 5_000_000_000)] == [1, 1, 2, 50]

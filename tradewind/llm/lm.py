"""LM scoring by masked pseudo-likelihood (operator 3).

A small window network predicts every word of a text from the words on both sides of it. The words' hash
buckets have a class and a place in the class, so a prediction is two short softmaxes. A document's score is
the sum of the conditional log-probabilities of its words; the mean compares documents of different length.

``score_documents`` scores the words' buckets. ``score_words`` tells the words of a bucket apart as well: it
adds the log-probability of each word within its bucket, from the counts of all words that were trained on.
With ``n`` occurrences of a word among the ``m`` of its bucket that is ``n / (m + 1)``, and ``1 / (m + 1)`` for
all unknown words together. Words and texts are told apart by 64 bits of hash. The counts of the commonest
words are broadcast, of the others joined.

Training reads all documents once, in rounds over successive shares of them; rounds and replicas a round both
grow with the square root of the number of words. In a round each task trains replicas from one state, each on
the next ``replica_words`` words of its documents. Their states (weights, and sums of squares for the step sizes)
are averaged by words, block by block, and the next round starts from the average. Only the averaged state,
whose size is fixed, passes the driver.

Null and empty texts have no words, score 0 and mean null; whole texts are read, at the ends padding takes
the place of words. Repeated rows are trained on as often as they occur and score alike. Without any
word the network is its start. An empty table gives no rows. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import column, fresh_name, importable, word_count
from tradewind.llm.hashing import text_hashes
from tradewind.operators.lineage import written
from tradewind.session import scratch_path

# Words whose counts are broadcast, at most: a megabyte at any size of the input.
COMMON = 65_536
# Words that are counted at once.
BLOCK = 1 << 20
# Leading bits of hashes by which common words are looked up.
LEADING = 17
# Bytes of texts whose words are hashed at once.
TOGETHER = 1 << 18
# Logits up to which sums of exponentials and of their products stay far within the numbers of 32 bits.
EXPONENT = 60


def _hold_memory() -> None:
    """Let each step use the memory of the step before. glibc gives freed memory back to the system beyond limits
    that it raises to the largest block freed so far, if that is not over 32 MB."""
    np.empty(30 << 20, dtype=np.uint8)


@dataclass(frozen=True)
class Shape:
    """Size of the network and of its training."""
    classes: int = 32
    places: int = 128
    side: int = 2
    width: int = 8
    hidden: int = 16
    rate: float = 0.1
    batch: int = 8192
    replica_words: int = 2_000_000
    blocks: int = 16

    @property
    def buckets(self) -> int:
        return self.classes * self.places

    @property
    def parts(self) -> dict[str, tuple[int, ...]]:
        span = 2 * self.side * self.width
        return {
            "embedding": (self.buckets + 1, self.width), "inner": (span, self.hidden), "inner_bias": (self.hidden,),
            "to_class": (self.hidden, self.classes), "class_bias": (self.classes,),
            "to_place": (self.classes, self.hidden, self.places), "place_bias": (self.classes, self.places)}

    @property
    def size(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts.values())


def start(shape: Shape) -> np.ndarray:
    """The weights the first round's replicas start from."""
    random = np.random.default_rng(1)
    pieces = [
        np.zeros(dims) if name.endswith("bias") else random.normal(0, 0.1 if name == "embedding" else dims[-2] ** -0.5 / 2, dims)
        for name, dims in shape.parts.items()]
    return np.concatenate([p.reshape(-1) for p in pieces]).astype(np.float32)


def _views(shape: Shape, weights: np.ndarray) -> dict[str, np.ndarray]:
    views, at = {}, 0
    for name, dims in shape.parts.items():
        count = int(np.prod(dims))
        views[name] = weights[at:at + count].reshape(dims)
        at += count
    return views


def examples(shape: Shape, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Each word's neighbours, and the words, as buckets."""
    return _examples(shape, *text_hashes([text or b""]))


def _examples(shape: Shape, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``examples`` of several texts, which have so many words each."""
    words = (hashes % np.uint64(shape.buckets)).astype(np.int32)
    # Padding stands before the first text, between the texts and behind the last.
    at = np.arange(len(words)) + np.repeat(shape.side * np.arange(len(counts)), counts)
    padded = np.full(len(words) + shape.side * (len(counts) + 1), shape.buckets, dtype=np.int32)
    padded[at + shape.side] = words
    around = np.empty((len(words), 2 * shape.side), dtype=np.int32)
    for k in range(2 * shape.side):
        around[:, k] = padded[at + k + (k >= shape.side)]
    return around, words


def _hashed(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the words of consecutive texts, and the number of words of each; some texts at a time, so that
    short ones do not cost a call each."""
    held, waiting = [], 0
    for value in texts:
        held.append(value.as_py() or b"")
        waiting += len(held[-1])
        if waiting >= TOGETHER:
            yield text_hashes(held)
            held, waiting = [], 0
    if held:
        yield text_hashes(held)


def _exponentials(logits: np.ndarray, bound: float, target: np.ndarray, picked: np.ndarray, total: np.ndarray) -> None:
    """Of each row of logits, none of which is further from 0 than ``bound``: the one at its target (a place in
    the flattened logits), and the total of the exponentials that the logits become."""
    if not bound < EXPONENT:
        logits -= logits.max(axis=1)[:, None]
    np.take(logits, target, out=picked, mode="clip")
    np.exp(logits, out=logits)
    np.matmul(logits, np.ones(logits.shape[1], dtype=logits.dtype), out=total)


def _with_bias(weights: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights with their bias as one more row, and how far from 0 sums of them can be whose factors are
    between -1 and 1."""
    both = np.concatenate((weights, bias[..., None, :]), axis=-2)
    return both, np.abs(both).sum(axis=-2).max(axis=-1)


def _forward(shape: Shape, net: dict[str, np.ndarray], around: np.ndarray, words: np.ndarray,
             learn: dict[str, np.ndarray] | None = None) -> np.ndarray:
    """Log-probability of each word; with ``learn`` also the gradients of their mean, written there.

    Words are sorted by class, so that a class is a slice. Biases are weights of a last hidden value that is 1,
    and exponentials are divided by their totals only where they have been summed up to fewer numbers.
    """
    count, learning = len(words), learn is not None
    class_, place = np.divmod(words, shape.places)
    # The sort of small integers takes linear time.
    order = np.argsort(class_.astype(np.uint16 if shape.classes > 256 else np.uint8), kind="stable")
    around, class_, place = around.take(order, axis=0), class_.take(order), place.take(order)
    ends = np.searchsorted(class_, np.arange(shape.classes + 1))
    at = np.arange(count)
    target_class, target_place = at * shape.classes + class_, (at - ends[class_]) * shape.places + place
    inputs = net["embedding"].take(around, axis=0).reshape(count, -1)
    hidden = np.empty((shape.hidden + 1, count), dtype=inputs.dtype)
    state = np.matmul(net["inner"].T, inputs.T, out=hidden[:-1])
    state += net["inner_bias"][:, None]
    np.tanh(state, out=state)
    hidden[-1] = 1
    to_class, bound = _with_bias(net["to_class"], net["class_bias"])
    to_place, bounds = _with_bias(net["to_place"], net["place_bias"])
    (picked, picked_place), (total, total_place) = (np.empty((2, count), dtype=inputs.dtype) for _ in range(2))
    by_class = hidden.T @ to_class
    _exponentials(by_class, bound, target_class, picked, total)
    if learning:
        by_class.reshape(-1)[target_class] -= total
        grown_class, grown = (hidden / total) @ by_class, np.zeros_like(to_place)
        back, back_place = net["to_class"] @ by_class.T, np.empty_like(state)
        back /= total
    for c, (start_, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        if start_ == end:
            continue
        seen, target, own = hidden[:, start_:end], target_place[start_:end], total_place[start_:end]
        by_place = seen.T @ to_place[c]
        _exponentials(by_place, bounds[c], target, picked_place[start_:end], own)
        if learning:
            by_place.reshape(-1)[target] -= own
            np.matmul(seen / own, by_place, out=grown[c])
            np.matmul(net["to_place"][c], by_place.T, out=back_place[:, start_:end])
    scores = (picked - np.log(total)).astype(np.float64)
    scores += picked_place - np.log(total_place)
    if learning:
        learn["to_class"][:], learn["class_bias"][:] = grown_class[:-1], grown_class[-1]
        learn["to_place"][:], learn["place_bias"][:] = grown[:, :-1], grown[:, -1]
        back_place /= total_place
        back += back_place
        state *= state
        np.subtract(1, state, out=state)
        back *= state
        learn["inner"][:] = inputs.T @ back.T
        learn["inner_bias"][:] = back.sum(axis=1)
        deep, at = (net["inner"] @ back).reshape(-1, shape.width, count).transpose(1, 0, 2), around.T.reshape(-1).astype(np.intp)
        for k, part in enumerate(np.ascontiguousarray(deep, dtype=np.float64).reshape(shape.width, -1)):
            learn["embedding"][:, k] = np.bincount(at, weights=part, minlength=shape.buckets + 1)
        for gradient in learn.values():
            gradient /= count
    out = np.empty(count)
    out[order] = scores
    return out


class Replica:
    """A network in training, with step sizes that shrink per weight (Adagrad)."""

    def __init__(self, shape: Shape, state: np.ndarray):
        self.shape, self.state, self.words = shape, state.copy(), 0
        self.weights, self.squares = np.split(self.state, 2)
        self.gradient = np.zeros(len(self.weights), dtype=np.float32)
        self.net, self.learn = _views(shape, self.weights), _views(shape, self.gradient)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def feed(self, around: np.ndarray, words: np.ndarray) -> None:
        self.held.append((around, words))
        self.waiting += len(words)
        if self.waiting >= self.shape.batch:
            self.train()

    def train(self) -> None:
        """Learn what is held, a batch at a time."""
        if not self.waiting:
            return
        around, words = (np.concatenate(part) for part in zip(*self.held))
        self.held, self.waiting = [], 0
        for at in range(0, len(words), self.shape.batch):
            _forward(self.shape, self.net, around[at:at + self.shape.batch], words[at:at + self.shape.batch], self.learn)
            step = np.square(self.gradient)
            self.squares += step
            np.sqrt(self.squares, out=step)
            np.divide(np.multiply(self.gradient, self.shape.rate, out=self.gradient), step, out=step)
            self.weights -= step
        self.words += len(words)


REPLICAS = "block int, words long, state binary"


def _rows(replica: Replica) -> pa.RecordBatch:
    parts = np.array_split(replica.state, replica.shape.blocks)
    return pa.RecordBatch.from_pydict({
        "block": pa.array(range(len(parts)), pa.int32()), "words": pa.array([replica.words] * len(parts), pa.int64()),
        "state": pa.array([p.tobytes() for p in parts], pa.binary())})


def _trainer(shape: Shape, state):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hold_memory()
        begin = np.frombuffer(state.value, dtype=np.float32)
        replica = Replica(shape, begin)
        for batch in batches:
            for hashes, counts in _hashed(batch.column(0)):
                around, words = _examples(shape, hashes, counts)
                done = 0
                for end in np.cumsum(counts).tolist():
                    while done < end:  # a long text goes on in the next replica
                        upto = min(end, done + shape.replica_words - replica.words - replica.waiting)
                        replica.feed(around[done:upto], words[done:upto])
                        done = upto
                        if replica.words + replica.waiting >= shape.replica_words:
                            replica.train()
                            yield _rows(replica)
                            replica = Replica(shape, begin)
        replica.train()
        if replica.words:
            yield _rows(replica)
    return train


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per block of a task's rows; as many sums as blocks, however many rows."""
    sums: dict[int, np.ndarray] = {}
    words: dict[int, int] = {}
    for batch in batches:
        for block, count, state in zip(*(batch.column(k) for k in range(3))):
            block, count = block.as_py(), count.as_py()
            part = np.frombuffer(state.as_py(), dtype=np.float32).astype(np.float64) * count
            sums[block] = sums[block] + part if block in sums else part
            words[block] = words.get(block, 0) + count
    for block, total in sums.items():
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int32()), "words": pa.array([words[block]], pa.int64()),
            "state": pa.array([(total / words[block]).astype(np.float32).tobytes()], pa.binary())})


def rounds_of(shape: Shape, words: int) -> int:
    """Rounds for so many words: as many as there are replicas in each."""
    return max(1, ceil(sqrt(words / shape.replica_words)))


def _shares(texts: DataFrame, rounds: int, pieces: int = 1) -> Iterator[DataFrame]:
    """The texts, dealt to as many shares and written, so that a round reads its own only.

    Tasks are dealt in turn, so each writes one file; where there are fewer tasks than rounds or ``pieces``, their
    rows are dealt too. So there are that many files or more, as long as a share has one of each task at most, and
    a round is cut finely enough to keep all cores busy.
    """
    if rounds == 1:
        yield texts
        return
    spark, path = texts.sparkSession, scratch_path(texts.sparkSession, "lm-shares")
    each = ceil(max(rounds, pieces) / max(1, texts.rdd.getNumPartitions()))
    dealt = F.spark_partition_id() * each + F.pmod(F.monotonically_increasing_id(), F.lit(each))
    texts.withColumn("share", F.pmod(dealt, F.lit(rounds))).write.partitionBy("share").parquet(path)
    for share in [r["share"] for r in spark.read.parquet(path).select("share").distinct().orderBy("share").collect()]:
        yield spark.read.schema("text binary").parquet(f"{path}/share={share}")


def train(docs: DataFrame, text: str = "text", shape: Shape = Shape(), words: int | None = None) -> np.ndarray:
    """Weights of the network after reading all texts of ``docs``, which have so many ``words`` (counted if
    not given)."""
    context = importable(docs.sparkSession).sparkContext
    if words is None:
        words = docs.select(F.sum(word_count(column(text).cast("string")))).first()[0] or 0
    state = np.concatenate([start(shape), np.full(shape.size, 1e-6, dtype=np.float32)])
    texts = docs.select(column(text).cast("string").cast("binary").alias("text"))
    for share in _shares(texts, rounds_of(shape, words), ceil(words / shape.replica_words)):
        begin = context.broadcast(state.tobytes())
        replicas = share.mapInArrow(_trainer(shape, begin), REPLICAS)
        averaged = replicas.repartition(shape.blocks, "block").mapInArrow(_average, REPLICAS)
        blocks = {row["block"]: row["state"] for row in averaged.collect()}  # one state, of fixed size
        if blocks:
            state = np.concatenate([np.frombuffer(blocks[k], dtype=np.float32) for k in range(shape.blocks)])
        begin.unpersist()
    return state[:shape.size]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, step)``, written: hash and occurrences of every word, and a step that grows with ``n``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hold_memory()
        held, waiting = [], 0
        for hashes, _ in (some for batch in batches for some in _hashed(batch.column(0))):
            held.append(hashes)
            waiting += len(held[-1])
            if waiting >= BLOCK:
                yield rows(held)
                held, waiting = [], 0
        if waiting:
            yield rows(held)

    def rows(held: list[np.ndarray]) -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"word": words.view(np.int64), "n": n})

    texts = docs.select(column(text).cast("string").cast("binary").alias("text"))
    return written(
        texts.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .withColumn("step", F.floor(8 * F.log2("n"))), "word-counts")


@dataclass(frozen=True)
class Known:
    """Hashes of the commonest words in order, the logarithms of their counts, and by bucket the logarithm of
    all its words' count and one."""
    words: np.ndarray
    logs: np.ndarray
    totals: np.ndarray

    @cached_property
    def _firsts(self) -> np.ndarray:
        """How many words have smaller leading bits than each value of these."""
        return np.searchsorted(self.words >> np.uint64(64 - LEADING), np.arange(1 << LEADING, dtype=np.uint64)).astype(np.int32)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash would stand among the common words, and whether it does."""
        if not len(self.words):
            return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
        last = len(self.words) - 1
        # Hashes are spread evenly, so few words share their leading bits.
        at = np.minimum(self._firsts[hashes >> np.uint64(64 - LEADING)], last)
        before = np.flatnonzero(self.words[at] < hashes)
        while len(before):
            at[before] += 1
            before = before[at[before] <= last]
            before = before[self.words[at[before]] < hashes[before]]
        at = np.minimum(at, last)
        return at, self.words[at] == hashes

    def gained(self, hashes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of each word within its bucket, as if rare words had occurred once, and which are
        rare."""
        out = -self.totals[buckets]
        at, found = self.places(hashes)
        out[found] += self.logs[at[found]]
        return out, ~found


def _known(counts: DataFrame, shape: Shape, common: int) -> tuple[Known, DataFrame, int]:
    """What is broadcast of the counts, of bounded size, the others that are over one, and the sum of all."""
    over_one = counts.filter("n > 1")
    steps = {r["step"]: r["count"] for r in over_one.groupBy("step").count().collect()}
    least, taken = max(steps, default=0) + 1, 0
    for step in sorted(steps, reverse=True):
        taken += steps[step]
        if taken > common:
            break
        least = step
    table = over_one.filter(F.col("step") >= least).select("word", "n").toArrow()
    words = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    # Hashes are unsigned, Spark's longs are not.
    size, above = shape.buckets, F.when(F.col("word") < 0, F.lit((1 << 64) % shape.buckets)).otherwise(F.lit(0))
    totals = np.zeros(size, dtype=np.int64)
    bucket = F.pmod(F.pmod("word", F.lit(size)) + above, F.lit(size))
    for row in counts.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect():
        totals[row["bucket"]] = row["n"]
    known = Known(words[order], np.log(table["n"].to_numpy())[order], np.log1p(totals))
    return known, over_one.filter(F.col("step") < least), int(totals.sum())


def _held(shape: Shape, texts: pa.Array) -> Iterator[list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]:
    """Examples of consecutive texts with the text's place and the words' hashes, several batches at a time."""
    held, waiting, place = [], 0, 0
    for hashes, counts in _hashed(texts):
        around, words = _examples(shape, hashes, counts)
        held.append((around, words, np.repeat(np.arange(place, place + len(counts)), counts), hashes))
        waiting += len(words)
        place += len(counts)
        if waiting >= 8 * shape.batch:
            yield held
            held, waiting = [], 0
    if held:
        yield held


def _scores(net: dict[str, np.ndarray], shape: Shape, texts: pa.Array,
            known: Known | None = None) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Words of each text and the sum of their log-probabilities. With ``known`` words are told apart within
    their buckets, and the different rare words of the texts follow: their text's place, hash and number."""
    counts, sums, rare = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts)), []
    for held in _held(shape, texts):
        around, words, of, hashes = (np.concatenate(part) for part in zip(*held))
        for at in range(0, len(words), shape.batch):
            part = slice(at, at + shape.batch)
            scores = _forward(shape, net, around[part], words[part])
            if known is not None:
                gained, others = known.gained(hashes[part], words[part])
                scores += gained
                rare.append((of[part][others], hashes[part][others]))
            sums += np.bincount(of[part], scores, len(texts))
        counts += np.bincount(of, minlength=len(texts))
    if not rare:
        return counts, sums, (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    of, hashes = (np.concatenate(part) for part in zip(*rare))
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    first = np.ones(len(of), dtype=bool)
    first[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return counts, sums, (of[at], hashes[at], np.diff(np.append(at, len(of))))


def log_probability(text: Column, weights, shape: Shape) -> Column:
    """Number of words and the sum of their buckets' log-probabilities. ``weights`` is a broadcast network."""
    @F.arrow_udf("struct<n_words: bigint, log_prob: double>")
    def score(texts: pa.Array) -> pa.Array:
        counts, sums, _ = _scores(_views(shape, np.frombuffer(weights.value, dtype=np.float32)), shape, texts)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(sums, pa.float64())], names=["n_words", "log_prob"])

    return score(text.cast("string").cast("binary"))


MEASURED = "text long, n_words long, log_prob double, rare array<struct<word: long, times: long>>"


def _measured(docs: DataFrame, text: str, shape: Shape, weights, known) -> DataFrame:
    """``MEASURED`` of every row, written: hash of its text, the number of words, the sum of their
    log-probabilities as if rare words had occurred once, and its rare words. One pass over the texts."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _hold_memory()
        net = _views(shape, np.frombuffer(weights.value, dtype=np.float32))
        for batch in batches:
            counts, sums, (of, words, times) = _scores(net, shape, batch.column(1), known.value)
            ends = np.searchsorted(of, np.arange(len(counts) + 1)).astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(words.view(np.int64)), pa.array(times, pa.int64())], names=["word", "times"])
            yield pa.RecordBatch.from_pydict({
                "text": batch.column(0), "n_words": pa.array(counts), "log_prob": pa.array(sums),
                "rare": pa.ListArray.from_arrays(pa.array(ends), rare)})

    body = column(text).cast("string")
    return written(docs.select(F.xxhash64(body).alias("text"), body.cast("binary").alias("body")).mapInArrow(measure, MEASURED), "measured")


def _text_scores(measured: DataFrame, counts: DataFrame) -> DataFrame:
    """``(text, n_words, log_prob)``, written, one row per text: the log-counts of its rare words in ``counts``
    are added. Copies of a text add the same, so their sum is divided by their number."""
    found = measured.select("text", F.explode("rare").alias("rare")).select("text", "rare.*")
    gained = found.join(counts, "word").groupBy("text").agg(F.sum(F.col("times") * F.log("n")).alias("gained"))
    texts = measured.groupBy("text").agg(
        F.max("n_words").alias("n_words"), F.max("log_prob").alias("log_prob"), F.count(F.lit(1)).alias("copies"))
    gained_once = F.coalesce(F.col("gained") / F.col("copies"), F.lit(0.0))
    return written(
        texts.join(gained, "text", "left").select("text", "n_words", (F.col("log_prob") + gained_once).alias("log_prob")), "text-scores")


def _with_mean(found: Column, log_prob: Column) -> Column:
    return F.struct(
        found["n_words"].alias("n_words"), log_prob.alias("log_prob"),
        F.when(found["n_words"] > 0, log_prob / found["n_words"]).alias("mean_log_prob"))


def score_documents(docs: DataFrame, train_on: DataFrame | None = None, text: str = "text",
                    shape: Shape = Shape()) -> tuple[DataFrame, str]:
    """Every row of ``docs`` with a struct ``(n_words, log_prob, mean_log_prob)`` of its words' buckets, and its
    name. The network is trained on ``train_on``, or on ``docs`` itself."""
    context = importable(docs.sparkSession).sparkContext
    weights = context.broadcast(train(docs if train_on is None else train_on, text, shape).tobytes())
    name = fresh_name(docs, "lm")
    scored = docs.withColumn(name, log_probability(column(text), weights, shape))
    found = column(name)
    return scored.withColumn(name, _with_mean(found, found["log_prob"])), name


def score_words(docs: DataFrame, train_on: DataFrame | None = None, text: str = "text",
                shape: Shape = Shape(), common: int = COMMON) -> tuple[DataFrame, str]:
    """``score_documents`` with the words of a bucket told apart. Counts of ``common`` words are broadcast."""
    context = importable(docs.sparkSession).sparkContext
    read = docs if train_on is None else train_on
    broadcast, others, total = _known(word_counts(read, text), shape, common)
    known = context.broadcast(broadcast)
    weights = context.broadcast(train(read, text, shape, total).tobytes())
    name, key = (fresh_name(docs, n) for n in ("lm", "lm_text"))
    # Written, so that a text with many copies can be split.
    found = _text_scores(_measured(docs, text, shape, weights, known), others)
    of = found.select(F.col("text").alias(key), F.struct("n_words", "log_prob").alias(name))
    joined = docs.withColumn(key, F.xxhash64(column(text).cast("string"))).join(of, key)
    return joined.withColumn(name, _with_mean(column(name), column(name)["log_prob"])).drop(key), name

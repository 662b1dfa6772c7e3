"""N-gram Jaccard join by a MinHash LSH forest (operator 9).

Texts are sets of five-word shingles; two are linked if their sets have a Jaccard similarity of 0.8 or more.

* Equal sets form a class; only one representative goes on.
* Every class gets a signature of minimum hashes, cut into trees. In a tree, a signature is a path, and
  classes meet at the node of the prefix they share. From the whole path, the prefix is shortened until
  a pair at the threshold meets in some tree with the target probability. When links are known, the
  recall is estimated again from them (each found link stands for one over its probability to be found), and
  prefixes are shortened further if it misses the target.
* Nodes with the same members are one. The members of a node are compared by signature, and those far
  below the threshold part; what stays connected is a candidate group.
* All pairs inside a candidate group are verified with their whole shingle sets.

Nodes and groups of any size are cut into slices, and pairs of slices are cells of bounded size, so neither a
hot node nor a hot group meets in one task, and no pair is left out. A cell returns a spanning forest
and counts, not pairs.

Words are compared as written. A text of fewer than five words is one shingle; a text without words, and
a null text, links with nothing. Rows with equal texts are copies and linked, under whatever ids, null
among them; the smallest id of a class or group stands for it. An empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.batches import dealt, group_starts, whole_groups
from tradewind.llm.common import column, fresh_name, importable
from tradewind.llm.components import components
from tradewind.llm.hashing import mixed, shingle_hashes, word_hashes
from tradewind.operators.lineage import written


@dataclass(frozen=True)
class Forest:
    """Parameters of the join."""
    threshold: float = 0.8
    shingle: int = 5
    trees: int = 24
    depth: int = 8
    target_recall: float = 0.999
    # Pairs whose signatures agree this much less than the threshold (four deviations) part.
    margin: float = 0.12
    node_slice: int = 256
    group_slice: int = 128
    slice_shingles: int = 400_000

    def chance(self, similarity: np.ndarray | float, depth: int) -> np.ndarray | float:
        """Probability that a pair of this similarity shares a prefix of this length in some tree."""
        return 1 - (1 - similarity ** depth) ** self.trees

    def first_depth(self) -> int:
        depth = self.depth
        while depth > 1 and self.chance(self.threshold, depth) < self.target_recall:
            depth -= 1
        return depth


# Shingles whose minimum hashes are computed at once.
CHUNK = 2048


def _coefficients(count: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64))
    factors = (numbers >> np.uint64(32)).astype(np.uint32)
    return factors[:count] | np.uint32(1), factors[count:]


def signature(shingles: np.ndarray, forest: Forest) -> np.ndarray:
    """Minimum of each hash function over the shingles."""
    factor, shift = _coefficients(forest.trees * forest.depth)
    least = np.full(len(factor), np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    for start in range(0, len(short), CHUNK):
        part = short[start:start + CHUNK]
        np.minimum(least, (factor[:, None] * part[None, :] + shift[:, None]).min(axis=1), out=least)
    return least


def _sketch(text: Column, forest: Forest) -> Column:
    """Key of the shingle set (null without words), its size and its signature."""
    @F.arrow_udf("struct<key: binary, size: int, signature: binary>")
    def sketch(texts: pa.Array) -> pa.Array:
        keys, sizes, signatures = [], [], []
        for value in texts:
            shingles = shingle_hashes(word_hashes(value.as_py()), forest.shingle)
            sizes.append(len(shingles))
            if len(shingles):
                keys.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                signatures.append(signature(shingles, forest).tobytes())
            else:
                keys.append(None)
                signatures.append(None)
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary())],
            names=["key", "size", "signature"])

    return sketch(text.cast("binary"))


def _shingles(text: Column, size: int) -> Column:
    @F.arrow_udf("binary")
    def shingles(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_hashes(word_hashes(v.as_py()), size).tobytes() for v in texts], pa.binary())

    return shingles(text.cast("binary"))


def _paths(signature_: Column, forest: Forest, depth: int) -> Column:
    """One hash per tree of the signature's prefix there."""
    @F.arrow_udf("array<bigint>")
    def paths(values: pa.Array) -> pa.Array:
        flat = np.frombuffer(b"".join(v.as_py() for v in values), dtype=np.uint32)
        cut = flat.reshape(len(values), forest.trees, forest.depth)[:, :, :depth].astype(np.uint64)
        state = np.broadcast_to(np.arange(1, forest.trees + 1, dtype=np.uint64), cut.shape[:2])
        for level in range(depth):
            state = mixed(state * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, level])
        ends = np.arange(0, len(values) * forest.trees + 1, forest.trees, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(state.reshape(-1).view(np.int64)))

    return paths(signature_)


def _versions(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("v1"), F.xxhash64(F.lit(1), text).alias("v2")]


def _celled(members: DataFrame, group: str) -> DataFrame:
    """Members of a group of ``slices`` slices, once for every cell ``(r, c)`` their slice is in."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("other")
    return (
        members.withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")))
        .select("*", other)
        .withColumns({"r": F.least("slice", "other"), "c": F.greatest("slice", "other")})
        .withColumn("cell", F.concat_ws("/", F.hex(F.col(group)), "r", "c"))
        .drop("other", "slices", group))


def _pairs(frame: pd.DataFrame, block: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs to compare in whole cells, in blocks; off the diagonal, members of different
    slices only."""
    starts = group_starts(frame["cell"].to_numpy())
    part, crossing = frame["slice"].to_numpy(), (frame["r"] != frame["c"]).to_numpy()
    left, right, held = [], [], 0
    for start, end in zip(starts[:-1], starts[1:]):
        for i in range(start, end - 1):
            others = np.arange(i + 1, end)
            if crossing[start]:
                others = others[part[i + 1:end] != part[i]]
            left.append(np.full(len(others), i))
            right.append(others)
            held += len(others)
            if held >= block:
                yield np.concatenate(left), np.concatenate(right)
                left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place that each place is connected with."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            return root


def _candidates(forest: Forest):
    """Spanning edges between members of a cell whose signatures agree enough."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["cell"]):
            signs = np.frombuffer(b"".join(frame["signature"]), dtype=np.uint32).reshape(len(frame), -1)
            signs = signs.astype(np.uint16)
            least = (forest.threshold - forest.margin) * signs.shape[1]
            left, right = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for i, j in _pairs(frame):
                near = (signs[i] == signs[j]).sum(axis=1) >= least
                left.append(i[near])
                right.append(j[near])
            root = _roots(len(frame), np.concatenate(left), np.concatenate(right))
            joined = np.flatnonzero(root != np.arange(len(frame)))
            keys = frame["key"].to_numpy()
            yield pd.DataFrame({"a": keys[root[joined]], "b": keys[joined]})
    return compare


def _shared(shingles: Sequence[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    count = len(shingles)
    sizes = np.array([len(s) for s in shingles])
    _, place, often = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(count), sizes)
    common = often[place] > 1
    row, place = row[common], place[common]
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    place = np.cumsum(np.append(False, place[1:] != place[:-1])) if len(place) else place
    shared = np.zeros((count, count))
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        lo, hi = np.searchsorted(place, (start, start + columns))
        holds = np.zeros((count, min(columns, int(place[-1]) + 1 - start)), dtype=np.float32)
        holds[row[lo:hi], place[lo:hi] - start] = 1
        shared += holds @ holds.T
    return shared


VERIFIED = "key binary, root binary, texts long, documents long, found double, expected double"


def _verify(forest: Forest, depth: int):
    """Per member of a cell that is linked there: its links, the first member it is connected with, and
    the links that the found ones stand for."""
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, ["cell"]):
            frame = frame.drop_duplicates(["cell", "key"], ignore_index=True)
            starts = group_starts(frame["cell"].to_numpy())
            for start, end in zip(starts[:-1], starts[1:]):
                if end - start > 1:
                    yield _verified(frame.iloc[start:end], forest, depth)
    return verify


def _verified(cell: pd.DataFrame, forest: Forest, depth: int) -> pd.DataFrame:
    shingles = [np.frombuffer(s, dtype=np.uint64) for s in cell["shingles"]]
    sizes = np.array([len(s) for s in shingles], dtype=np.float64)
    shared = _shared(shingles)
    similarity = shared / (sizes[:, None] + sizes[None, :] - shared)
    linked = similarity >= forest.threshold
    np.fill_diagonal(linked, False)
    if cell["r"].iloc[0] != cell["c"].iloc[0]:
        part = cell["slice"].to_numpy()
        linked &= part[:, None] != part[None, :]
    left, right = np.nonzero(np.triu(linked))
    root = _roots(len(cell), left, right)
    some = np.flatnonzero(linked.any(axis=1))
    keys, copies = cell["key"].to_numpy(), cell["copies"].to_numpy(dtype=np.int64)
    expected = np.where(linked, 1 / forest.chance(np.where(linked, similarity, 1.0), depth), 0.0).sum(axis=1)
    return pd.DataFrame({
        "key": keys[some], "root": keys[root[some]], "texts": linked.sum(axis=1)[some],
        "documents": (linked @ copies)[some], "found": linked.sum(axis=1)[some].astype(float), "expected": expected[some]})


def _candidate_groups(classes: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """``(key, component)`` of the classes that may have links."""
    paths = classes.select("key", F.explode(_paths(F.col("signature"), forest, depth)).alias("node"))
    nodes = paths.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("y")).filter("n > 1")
    nodes = written(nodes.groupBy("n", "x", "y").agg(F.min("node").alias("node")).select("node", "n"), "nodes")
    members = (
        paths.join(nodes, "node").join(classes.select("key", "signature"), "key")
        .withColumn("slices", F.ceil(F.col("n") / forest.node_slice)).drop("n"))
    edges = dealt(_celled(members, "node"), "cell").mapInPandas(_candidates(forest), "a binary, b binary")
    return components(edges).select(F.col("node").alias("key"), "component")


def _links(docs: DataFrame, classes: DataFrame, groups: DataFrame, forest: Forest, depth: int) -> DataFrame:
    """Verified links inside the candidate groups, see ``_verify``. ``docs`` has ``id``, ``v1``, ``v2`` and
    ``text``."""
    placed = written(groups.join(classes.select("key", "size", "copies", "first"), "key"), "placed")
    sizes = written(
        placed.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
        .select("component", F.greatest(
            F.ceil(F.col("n") / forest.group_slice), F.ceil(F.col("shingles") / forest.slice_shingles)).alias("slices")),
        "group-sizes")
    wanted = written(placed.join(sizes, "component").select(
        "key", "component", "copies", "slices", F.col("first.id").alias("wanted"), F.col("first.v1").alias("v1"),
        F.col("first.v2").alias("v2")), "wanted")
    texts = docs.join(wanted.hint("merge"), ["v1", "v2"]).filter(F.col("id").eqNullSafe(F.col("wanted")))
    sets = texts.select("key", "component", "copies", "slices", _shingles(F.col("text"), forest.shingle).alias("shingles"))
    return written(dealt(_celled(sets, "component"), "cell").mapInPandas(_verify(forest, depth), VERIFIED), "links")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    forest: Forest = Forest()) -> DataFrame:
    """``(id, v1, v2, class_id, copy_id, n_copies, n_links, n_texts)`` for each row of ``docs``.

    ``class_id`` is the smallest id of all rows connected by links, ``copy_id`` the smallest one with an
    equal shingle set. ``n_links`` counts the rows linked with this one, its ``n_copies`` rows of equal
    sets among them without itself; ``n_texts`` counts the different sets linked with its own. ``v1``
    and ``v2`` are the text's hash; ids are as they were.
    """
    importable(docs.sparkSession)
    body = column(text).cast("string")
    sources = docs.select(column(id_column).alias("id"), *_versions(body), body.alias("text"))
    sketched = written(
        sources.select("id", "v1", "v2", _sketch(F.col("text"), forest).alias("s"))
        .select("id", "v1", "v2", "s.key", "s.size", "s.signature"), "sketches")
    classes = written(
        sketched.filter("key IS NOT NULL").groupBy("key").agg(
            F.max("size").alias("size"), F.max("signature").alias("signature"), F.count(F.lit(1)).alias("copies"),
            F.min("id").alias("copy_id"), F.min(F.struct("id", "v1", "v2")).alias("first")), "classes")
    depth = forest.first_depth()
    while True:
        links = _links(sources, classes, _candidate_groups(classes, forest, depth), forest, depth)
        seen = links.agg(F.sum("found").alias("found"), F.sum("expected").alias("expected")).first()
        if depth == 1 or not seen["expected"] or seen["found"] / seen["expected"] >= forest.target_recall:
            break
        depth -= 1
    counted = links.groupBy("key").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    joined = components(links.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = written(
        joined.select(F.col("node").alias("key"), "component").join(classes.select("key", "copy_id"), "key"), "joined")
    smallest = written(named.groupBy("component").agg(F.min("copy_id").alias("class_id")), "smallest-ids")
    linked = named.join(smallest, "component").select("key", "class_id").join(counted, "key")
    facts = written(
        classes.select("key", "copies", "copy_id").join(linked, "key", "left").select(
            "key", F.coalesce("class_id", "copy_id").alias("class_id"), "copy_id", F.col("copies").alias("n_copies"),
            (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("texts", F.lit(0).cast("long")).alias("n_texts")), "facts")
    zero = F.lit(0).cast("long")
    return sketched.select("id", "v1", "v2", "key").join(facts, "key", "left").select(
        "id", "v1", "v2", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce("n_links", zero).alias("n_links"), F.coalesce("n_texts", zero).alias("n_texts"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", forest: Forest = Forest()) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group; of rows with equal id and text one stays,
    of rows with equal id and different texts in one group all stay."""
    kept = written(
        near_duplicates(docs, id_column, text, forest).filter(F.col("id").eqNullSafe(F.col("class_id")))
        .select("id", "v1", "v2").distinct(), "kept")
    name, v1, v2 = (fresh_name(docs, n) for n in ("kept", "v1", "v2"))
    body = column(text).cast("string")
    keys = kept.select(F.struct("id", "v1", "v2").alias(name))
    versions = _versions(body)
    marked = docs.withColumns({v1: versions[0], v2: versions[1]})
    of = column(name)
    same = (column(v1) == of["v1"]) & (column(v2) == of["v2"]) & column(id_column).eqNullSafe(of["id"])
    return marked.join(keys, same, "left_semi").dropDuplicates([id_column, v1, v2]).drop(v1, v2)

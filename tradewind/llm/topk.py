"""Exact top-k search with multi-resolution segment statistics (operator 8).

Vectors are turned into integers, and the score is the inner product, so the most similar vectors have the
highest scores. Cut into segments, a vector has a mean and a deviation per segment, and the products
of two vectors' means and of their deviations bound their score from above (Cauchy and Schwarz on what is
left of each segment without its mean). Candidates are bounded with few segments first and with more
for those that stay; only the survivors are scored.

Queries and candidates are cut into blocks, every block of queries meets every block of candidates in a
cell of its own, and no cell grows with the input. A first pass scores each query against one block of
candidates; its k-th best score there is the bar for all other blocks, so a cell returns little more
than what ends among the best.

Vectors that are null or hold null or non-finite components take no part, as query or as candidate.
Only vectors of equal length are compared. Equal scores are ranked by id, null ids last; rows with equal
ids are candidates of their own. A query without candidates, and an empty table, give no rows. Scores are
64-bit integers. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.llm.batches import dealt, whole_groups
from tradewind.llm.common import column
from tradewind.operators.lineage import written

SCALE = 64
# Vectors of a block of queries and of candidates, on average.
QUERY_BLOCK, BLOCK = 1024, 4096
CELLS_PER_TASK = 4
# Segments of each resolution, coarse to fine.
RESOLUTIONS = (1, 4, 16)
FOUND = "row long, query_id long, id long, score long"
NO_BAR = -(1 << 63)
NO_ID = (1 << 63) - 1
# Up to here products of doubles are exact integers.
EXACT = float(1 << 53)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Components as integers; null for vectors that take no part."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * scale)))


def _features(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per segment the mean and the deviation, weighed so that the product of two rows bounds the score."""
    parts = np.array_split(np.arange(vectors.shape[1]), min(segments, max(vectors.shape[1], 1)))
    columns = []
    for part in parts:
        if len(part):
            piece, weight = vectors[:, part], math.sqrt(len(part))
            mean = piece.mean(axis=1)
            columns += [mean * weight, np.sqrt(((piece - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(columns, axis=1) if columns else np.zeros((len(vectors), 1))


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    most = np.abs(queries).max(initial=0).astype(float) * np.abs(vectors).max(initial=0) * max(queries.shape[1], 1)
    if most < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _survivors(queries: np.ndarray, vectors: np.ndarray, bar: np.ndarray) -> np.ndarray:
    """Which candidates may reach the bar of any query, by bounds from coarse to fine."""
    stay = np.arange(len(vectors))
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    slack = 1e-9 * (np.sqrt((q ** 2).sum(axis=1).max(initial=0)) * np.sqrt((v ** 2).sum(axis=1).max(initial=0)) + 1)
    for segments in RESOLUTIONS:
        bound = _features(q, segments) @ _features(v[stay], segments).T
        stay = stay[(bound + slack >= bar[:, None]).any(axis=0)]
        if not len(stay):
            break
    return stay


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, bar: np.ndarray, k: int) -> Iterator[tuple]:
    """Query place, id and score of each query's k best of these candidates that reach its bar; ``own``
    marks a query's own row."""
    for place, row in enumerate(scores):
        fit = np.flatnonzero((row >= bar[place]) & ~own[place])
        if len(fit) > k:
            order = np.lexsort((ids[fit], -row[fit]))
            fit = fit[order[:k]]
        for at in fit:
            yield place, ids[at], row[at]


def _searcher(k: int, first: bool):
    """Work on whole cells: rows of queries (``bar`` set) and of candidates."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in whole_groups(batches, ["cell"]):
            for _, cell in cells.groupby("cell", sort=False):
                asks = cell["asks"].to_numpy(dtype=bool)
                asking, given = cell[asks], cell[~asks]
                if not len(asking) or not len(given):
                    continue
                queries, vectors = (np.array(part["vector"].tolist(), dtype=np.int64).reshape(len(part), -1)
                                    for part in (asking, given))
                bar = asking["bar"].to_numpy(dtype=np.int64)
                stay = np.arange(len(vectors)) if first else _survivors(queries, vectors, bar)
                ids = given["id"].to_numpy(dtype=np.int64)[stay]
                own = asking["row"].to_numpy()[:, None] == given["row"].to_numpy()[stay][None, :]
                found = list(_best(_scores(queries, vectors[stay]), ids, own, bar, k))
                place, id_, score = map(list, zip(*found)) if found else ([], [], [])
                yield pd.DataFrame({
                    "row": asking["row"].to_numpy()[place], "query_id": asking["id"].to_numpy()[place],
                    "id": np.array(id_, dtype=np.int64), "score": np.array(score, dtype=np.int64)})
    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _in_cells(queries: DataFrame, candidates: DataFrame, k: int, first: bool, cells: int) -> DataFrame:
    columns = ("cell", "asks", "row", "id", "bar", "vector")
    cell = F.concat_ws("/", "dim", "query_block", "block").alias("cell")
    rows = (
        queries.select(cell, F.lit(True).alias("asks"), "row", "id", "bar", "vector")
        .unionByName(candidates.select(
            cell, F.lit(False).alias("asks"), "row", "id", F.lit(NO_BAR).alias("bar"), "vector")))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(cells / CELLS_PER_TASK))
    return dealt(rows.select(*columns), "cell", tasks).mapInPandas(_searcher(k, first), FOUND)


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id", vector: str = "embedding",
           scale: int = SCALE, query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` best candidates of each query. Queries are the rows whose
    id is divisible by ``every``; candidates are all rows but the query's own."""
    id_ = column(id_column).cast("long")
    base = written(
        vectors.select(id_.alias("id"), quantised(column(vector), scale).alias("vector"))
        .filter("vector IS NOT NULL")
        .select(F.monotonically_increasing_id().alias("row"), "id", "vector", F.size("vector").alias("dim")), "vectors")
    asking = (F.col("id") % every == 0).eqNullSafe(F.lit(True))
    counts = written(
        base.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(asking).alias("asking"))
        .select("dim", F.ceil(F.col("n") / block).alias("blocks"), F.ceil(F.col("asking") / query_block).alias("query_blocks"))
        .filter("query_blocks > 0"), "vector-counts")
    cells = counts.agg(F.sum(F.col("blocks") * F.col("query_blocks"))).first()[0] or 0
    # Written with a row number first, so the blocks are the same in every pass.
    placed = base.join(counts, "dim")
    candidates = placed.select(
        "dim", "row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "vector", "blocks", "query_blocks",
        F.pmod(F.xxhash64("row"), "blocks").alias("block"))
    queries = placed.filter(asking).select(
        "dim", "row", "id", "vector", "blocks", F.pmod(F.xxhash64(F.lit(1), "row"), "query_blocks").alias("query_block"))
    zero = F.lit(0).cast("long")

    trial = _in_cells(
        queries.withColumns({"block": F.pmod("query_block", "blocks"), "bar": F.lit(NO_BAR)}),
        candidates.filter("block < query_blocks").withColumn(
            "query_block", F.explode(F.sequence(F.col("block"), F.col("query_blocks") - 1, F.col("blocks")))),
        k, True, cells)
    bars = written(_ranked(trial, k).filter(F.col("rank") == k).select("row", F.col("score").alias("bar")), "bars")
    found = _in_cells(
        queries.join(bars, "row", "left").withColumn("bar", F.coalesce("bar", F.lit(NO_BAR)))
        .withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))),
        candidates.withColumn("query_block", F.explode(F.sequence(zero, F.col("query_blocks") - 1))),
        k, False, cells)
    return _ranked(found, k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != NO_ID, F.col("id")).alias("id"), "score")

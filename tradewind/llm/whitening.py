"""Embedding whitening by a pivoted Cholesky factor and one-sided Jacobi rotations (operator 13).

Components are turned into integers x = floor(scale * c) + offset. The fit list has every distinct x vector once. Its n, its
sums S and its scatter, the sum of the products of (n * x - S) / n, come from one pass each: tasks add up their own rows, and
the sums of the tasks are added by key, a line of the matrix being a key. The scatter matrix, whose size is set by the vectors' length
alone, is factored in one task: Cholesky with the largest remaining diagonal entry as pivot gives a triangular L, and plane
rotations of its columns make them orthogonal. Their squared norms over n are the eigenvalues of the covariance, the columns
over their norms its eigenvectors. The covariance of the whitened fit list is measured in the same way against the identity.
Vectors are packed some hundreds to a row, so what is joined to them, a model per length, is moved once for all of a pack.

Null vectors, those with a null or non-finite entry, empty ones, and those with an entry beyond ``LARGEST`` after scaling
(its double is no exact integer) take no part. Vectors of each length are a table of their own, with its own n, components and
error. A covariance of rank r has r components, so one vector, or many equal ones, give no rows. Equal eigenvalues come in
any order. ``deviation`` is null where it does not fit a long. Repeated rows and ids give repeated results, null ids stay;
an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import column
from tradewind.operators.lineage import written

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
LARGEST = float(1 << 53)
# A pivot this much smaller than the first one is rounding.
RANK_TOLERANCE = 1e-13
# Rotations end when no two columns' cosine is above this, or after so many sweeps.
ANGLE, SWEEPS = 1e-15, 60
# Numbers of a row of packed vectors, and those that a task adds up in memory before it sends them on.
PACK, MOST_HELD = 1 << 16, 1 << 22
LINES = "dim int, line int, sums array<double>"
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"
BASIS = "dim int, component int, direction array<double>, eigenvalue double, explained double"


def integers(vector: Column, scale: float = SCALE, offset: int = OFFSET) -> Column:
    """Entries as integers; null for vectors that take no part."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    doubles = F.transform(vector, lambda c: c.cast("double") * scale)
    usable = (F.size(vector) > 0) & F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    return F.when(usable, F.transform(scaled, lambda c: c + F.lit(offset).cast("long")))


def _arrays(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    ends = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)))


def packed(rows: DataFrame, id_type: T.DataType) -> DataFrame:
    """Vectors ``(id, dim, x)`` of a length side by side, at most ``PACK`` numbers or one vector to a row ``(dim, ids, x)``. What
    is joined to a row is then moved once for many vectors."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                some = batch.filter(pa.array(dims == dim))
                step = max(1, PACK // dim)
                for start in range(0, len(some), step):
                    part = some.slice(start, step)
                    ids, x = part.column("id"), part.column("x")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), _one(ids), _one(x.flatten())], names=["dim", "ids", "x"])

    schema = T.StructType().add("dim", T.IntegerType()).add("ids", T.ArrayType(id_type)).add("x", T.ArrayType(T.LongType()))
    return rows.select("dim", "id", "x").mapInArrow(pack, schema)


def _one(values: pa.Array) -> pa.Array:
    """All values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, Any]]:
    """Packed rows with ``x`` as a matrix, ``off`` as the exact n * x - S and ``y`` as off / n."""
    for batch in batches:
        for row in range(len(batch)):
            pack = {c: batch.column(c)[row] for c in batch.schema.names}
            dim, n = pack["dim"].as_py(), pack["n"].as_py()
            x = pack["x"].values.to_numpy(zero_copy_only=False).reshape(-1, dim)
            sums = [int(s) for s in pack["sums"].as_py()]
            fits = n * int(np.abs(x).max()) + max(map(abs, sums)) < 1 << 63
            kind = np.int64 if fits else object
            off = n * x.astype(kind) - np.array(sums, dtype=kind)
            yield {**pack, "dim": dim, "n": n, "off": off, "y": (off / n).astype(np.float64)}


def _deviation(off: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; null if it does not fit a long."""
    if float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0 ** 62:
        return (off.astype(np.int64) ** 2).sum(axis=1).tolist()
    exact = [sum(int(o) ** 2 for o in row) for row in off]
    return [e if e < 1 << 63 else None for e in exact]


def _whitened(pack: dict[str, Any]) -> np.ndarray:
    """Projections of the vectors on the components, over the roots of their eigenvalues."""
    basis = pack["basis"].as_py()
    directions = np.array([one["direction"] for one in basis])
    return pack["y"] @ directions.T / np.sqrt([one["eigenvalue"] for one in basis])


def _lines(packs: DataFrame, matrix: Callable[[dict[str, Any]], np.ndarray]) -> DataFrame:
    """``(dim, line, sums)``: the matrices made of all packs, added up per ``dim``."""
    def send(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for dim, made in held.items():
            step = max(1, PACK // made.shape[1])
            for start in range(0, len(made), step):
                part = made[start:start + step]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(part), dim, dtype=np.int32)), pa.array(np.arange(start, start + len(part), dtype=np.int32)),
                    _arrays(part)], names=["dim", "line", "sums"])

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for pack in _packs(batches):
            made, dim = matrix(pack), pack["dim"]
            held[dim] = held[dim] + made if dim in held else made
            if sum(m.size for m in held.values()) > MOST_HELD:
                yield from send(held)
                held = {}
        yield from send(held)

    def of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(batch.column("dim").to_pylist(), batch.column("line").to_pylist())
            for key, sums in zip(keys, batch.column("sums")):
                made = sums.values.to_numpy()
                held[key] = held[key] + made if key in held else made
        for (dim, line), sums in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([line], pa.int32()), _arrays(sums[None, :])], names=["dim", "line", "sums"])

    return packs.mapInArrow(of_task, LINES).repartition("dim", "line").mapInArrow(of_key, LINES)


def _scatter(rows: np.ndarray) -> np.ndarray:
    return rows.T @ rows


def pivoted_cholesky(matrix: np.ndarray, tolerance: float = RANK_TOLERANCE) -> np.ndarray:
    """L with ``L @ L.T`` equal to a positive semidefinite matrix, one column per pivot, until the largest
    remaining diagonal entry is rounding. With rows in the order of the pivots L is lower triangular."""
    left = np.array(matrix, dtype=np.float64)
    most = left.diagonal().max(initial=0.0)
    columns = []
    done = np.zeros(len(left), dtype=bool)
    while not done.all():
        diagonal = np.where(done, -np.inf, left.diagonal())
        pivot = int(diagonal.argmax())
        if diagonal[pivot] <= max(tolerance * most, 0.0):
            break
        one = np.where(done, 0.0, left[:, pivot]) / np.sqrt(diagonal[pivot])
        left -= np.outer(one, one)
        done[pivot] = True
        columns.append(one)
    return np.stack(columns, axis=1) if columns else np.zeros((len(left), 0))


def _rounds(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of pairs that share none: one stays, the others go round a table."""
    seats = list(range(count + count % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < count]
        if pairs:
            yield tuple(np.array(side) for side in zip(*pairs))
        seats = [seats[0], seats[-1], *seats[1:-1]]


def jacobi_columns(factor: np.ndarray) -> np.ndarray:
    """The columns rotated in planes until all are orthogonal to each other, longest first."""
    columns = np.array(factor, dtype=np.float64)
    for _ in range(SWEEPS):
        worst = 0.0
        for one, other in _rounds(columns.shape[1]):
            a, b = columns[:, one], columns[:, other]
            aa, bb, ab = ((x * y).sum(axis=0) for x, y in ((a, a), (b, b), (a, b)))
            size = np.sqrt(aa * bb)
            cosine = np.divide(np.abs(ab), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, float(cosine.max()))
            turn = cosine > ANGLE
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros_like(ab), where=turn)
            tangent = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, tangent)
            columns[:, one], columns[:, other] = cos * (a - tangent * b), cos * (tangent * a + b)
        if worst <= ANGLE:
            break
    return columns[:, np.argsort(-(columns ** 2).sum(axis=0), kind="stable")]


def _basis(lines: DataFrame, counts: DataFrame, components: int) -> DataFrame:
    """The eigenvectors of each length's covariance, from the lines of its scatter."""
    def factor(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("line")
        scatter, n = np.stack(rows["sums"].to_numpy()), int(rows["n"].iloc[0])
        rotated = jacobi_columns(pivoted_cholesky((scatter + scatter.T) / 2))[:, :components]
        norm = np.sqrt((rotated ** 2).sum(axis=0))
        return pd.DataFrame({
            "dim": np.full(len(norm), len(scatter), dtype=np.int32), "component": np.arange(1, len(norm) + 1, dtype=np.int32),
            "direction": pd.Series(list((rotated / norm).T), dtype=object), "eigenvalue": norm ** 2 / n, "explained": norm ** 2 / scatter.trace()})

    return lines.join(counts.select("dim", "n"), "dim").groupBy("dim").applyInPandas(factor, BASIS)


def _sums(fit: DataFrame) -> DataFrame:
    """``(dim, n, sums)``: vectors of the packed fit list and their exact sums."""
    entries = fit.select("dim", F.posexplode("x").alias("at", "v")).select("dim", (F.col("at") % F.col("dim")).alias("at"), "v")
    sums = entries.groupBy("dim", "at").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(28,0)")).alias("sum"))
    entry = F.struct("at", "sum")
    return sums.groupBy("dim").agg(
        F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(entry)), lambda s: s["sum"]).alias("sums"))


def _identity_error(fit: DataFrame) -> DataFrame:
    """``(dim, identity_error)``: largest entry, whatever its sign, of the whitened fit list's covariance minus the identity.
    ``fit`` has the packed fit list with its model."""
    means = written(
        _lines(fit, lambda pack: _whitened(pack).sum(axis=0, keepdims=True))
        .select("dim", F.col("sums").alias("totals")), "whitened-sums")

    def centred(pack: dict[str, Any]) -> np.ndarray:
        return _scatter(_whitened(pack) - np.array(pack["totals"].as_py()) / pack["n"])

    lines = _lines(fit.join(means, "dim"), centred).join(fit.groupBy("dim").agg(F.max("n").alias("n")), "dim")
    off = F.transform("sums", lambda s, at: F.abs(s / F.col("n") - (at == F.col("line")).cast("double")))
    return written(lines.groupBy("dim").agg(F.max(F.array_max(off)).alias("identity_error")), "identity-error")


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(<id>, component, n, deviation, whitened, explained, identity_error)`` for each row and component."""
    id_type = vectors.schema[id_column].dataType
    rows = (
        vectors.select(column(id_column).alias("id"), integers(column(vector), scale, offset).alias("x"))
        .filter("x IS NOT NULL").withColumn("dim", F.size("x")))
    # Equal vectors meet on the map side first, so however many there are, a task sends one.
    distinct = rows.select("dim", "x").distinct().withColumn("id", F.lit(None).cast(id_type))
    fit = written(packed(distinct, id_type), "fit")
    counts = written(_sums(fit), "fit-sums")
    # One small row per length of vectors, joined to packs.
    lines = _lines(fit.join(counts, "dim"), lambda pack: _scatter(pack["y"]))
    one = F.struct("component", "direction", "eigenvalue", "explained")
    basis = _basis(lines, counts, components).groupBy("dim").agg(F.sort_array(F.collect_list(one)).alias("basis"))
    model = written(counts.join(basis, "dim"), "whitening-model")
    model = model.join(_identity_error(fit.join(model, "dim")), "dim")

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in _packs(batches):
            made, basis = _whitened(pack), pack["basis"].as_py()
            each = pa.array(np.repeat(np.arange(len(made)), len(basis)))
            yield pa.RecordBatch.from_arrays([
                pack["ids"].values.take(each), pa.array(np.tile(np.arange(1, len(basis) + 1, dtype=np.int32), len(made))),
                pa.array(np.full(made.size, pack["n"])), pa.array(_deviation(pack["off"]), pa.int64()).take(each), pa.array(made.reshape(-1)),
                pa.array(np.tile([b["explained"] for b in basis], len(made))), pa.array(np.full(made.size, pack["identity_error"].as_py())),
            ], names=names)

    schema = T.StructType([T.StructField(id_column, id_type), *T.StructType.fromDDL(RESULT)])
    names = schema.fieldNames()
    return packed(rows, id_type).join(model, "dim").mapInArrow(results, schema)

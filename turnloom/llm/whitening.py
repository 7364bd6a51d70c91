"""Whiten vectors by the principal components of their covariance.

Equal vectors are grouped first: each distinct one is a row with its count as weight. The sums and
the centred products of distinct vectors, times their weights, give the covariance; each distinct
vector is whitened once and joined back to the rows that hold it. Per task one matrix of
dimensions x dimensions comes out, so what reaches the driver depends on the length of a vector
alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.operators.scale import cut_lineage, lookup_join

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
# Entries beyond this are held at it, so that sums of whole numbers stay exact.
LIMIT = 1 << 50
# A component whose eigenvalue is no more than this share of the trace is not there.
NOTHING = 1e-13
_LONG = (1 << 63) - 1


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exactly."""
    top = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if top > _LONG:
        x = x.astype(object)
    return n * x - np.array(sums, x.dtype)


def _squares(gap: np.ndarray) -> np.ndarray:
    """The sum of squares of each row, exactly; a value beyond a long stays at its limit."""
    top = int(np.abs(gap).max(initial=0))
    if gap.shape[1] * top * top > _LONG:
        whole = [min(_LONG, sum(int(v) ** 2 for v in row)) for row in gap]
        return np.array(whole, np.int64)
    return (gap * gap).sum(axis=1)


def _products(n: int, sums: list[int]):
    """Of each task: weighted products of the centred vectors, a row per dimension."""
    size = len(sums)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                centred = _deviations(_matrix(batch["x"]), n, sums).astype(np.float64) / n
                weight = batch["weight"].to_numpy().astype(np.float64)
                total += (centred * weight[:, None]).T @ centred
        yield pa.RecordBatch.from_pydict({"i": np.arange(size), "row": list(total)})

    return products


def _whitener(n: int, sums: list[int], projection: np.ndarray):
    """Of each distinct vector: its whitened form and the exact square of its deviation."""

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            gap = _deviations(_matrix(batch["x"]), n, sums)
            z = (gap.astype(np.float64) / n) @ projection
            flat = pa.array(z.ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["h1"],
                    batch["h2"],
                    batch["weight"],
                    pa.array(_squares(gap), pa.int64()),
                    pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], flat),
                ],
                ["h1", "h2", "weight", "deviation", "z"],
            )

    return whiten


def _covariance(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    size = len(sums)
    parts = distinct.select("x", "weight").mapInArrow(_products(n, sums), "i long, row array<double>")
    cells = (
        parts.select("i", F.posexplode("row").alias("j", "value"))
        .groupBy("i", "j")
        .agg(F.sum("value").alias("value"))
        .toArrow()
    )
    out = np.zeros((size, size))
    out[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["value"].to_numpy()
    return (out + out.T) / (2 * n)


def _components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and, as columns, their unit vectors; the largest entry is positive."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:count]
    values, vectors = values[order], vectors[:, order]
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values, vectors * np.where(turn == 0, 1, turn)


def _identity_error(whitened: DataFrame, n: int, there: list[int]) -> float | None:
    """The largest entry of the whitened vectors' weighted covariance minus the identity."""
    if not there:
        return None
    z = {i: F.get("z", i) for i in there}
    means = whitened.agg(*[F.sum(F.col("weight") * z[i]) / n for i in there]).first()
    centred = {i: z[i] - F.lit(float(m)) for i, m in zip(there, means)}
    pairs = [(i, j) for i in there for j in there if i <= j]
    cells = whitened.agg(*[F.sum(F.col("weight") * centred[i] * centred[j]) / n for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cells, pairs))


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: for each vector a
    row per component.

    Entries become whole numbers ``x = floor(scale * entry) + shift``. ``n`` is the number of
    vectors, ``deviation`` the sum over dimensions of ``(n * x - sum of x)^2``, ``whitened`` the
    centred vector on the component's unit vector over the root of its eigenvalue, ``explained``
    the eigenvalue's share of all, ``identity_error`` what the whitened vectors' covariance is off
    the identity. Components are numbered from 1 by falling eigenvalue; of a unit vector the
    largest entry is positive.

    Vectors that are null or empty or hold a null or a value that is not finite take no part, nor
    do those of another length than most vectors have (of equally frequent lengths the longest
    counts). Entries are held within 2^50 and deviations within a long. Repeated rows and rows
    without an id each count. Where a component has no variance, as with a single vector or more
    components than independent dimensions, ``whitened`` is null (and ``explained`` too where
    nothing varies). Other columns are not looked at. An empty table gives no rows.
    """
    spark = df.sparkSession
    out = (
        f"{id_col} long, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    )
    held = F.lit(float(LIMIT))
    rows = rows.select(
        "id",
        F.transform(
            "v", lambda c: F.floor(F.greatest(F.least(c * scale, held), -held)).cast("long") + shift
        ).alias("x"),
    ).withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")})
    distinct = cut_lineage(
        rows.groupBy("h1", "h2", "x").agg(F.count(F.lit(1)).alias("weight"))
    )
    sizes = distinct.groupBy(F.size("x").alias("size")).agg(F.sum("weight").alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], out)
    size, n = most
    distinct = distinct.filter(F.size("x") == size)
    at = distinct.select("weight", F.posexplode("x").alias("i", "x"))
    total = F.sum(F.col("x").cast("decimal(38,0)") * F.col("weight"))
    sums = [int(r.total) for r in at.groupBy("i").agg(total.alias("total")).orderBy("i").collect()]
    covariance = _covariance(distinct, n, sums)
    values, vectors = _components(covariance, components)
    trace = float(np.trace(covariance))
    there = [i for i, e in enumerate(values.tolist()) if e > NOTHING * trace]
    root = np.array([values[i] ** -0.5 if i in there else 0.0 for i in range(len(values))])
    whitened = cut_lineage(
        distinct.select("h1", "h2", "weight", "x").mapInArrow(
            _whitener(n, sums, vectors * root),
            "h1 long, h2 long, weight long, deviation long, z array<double>",
        )
    )
    error = _identity_error(whitened, n, there)
    shares = [float(e) / trace if trace > 0 else None for e in values]
    explained = F.array(*[F.lit(e).cast("double") for e in shares])
    real = F.array(*[F.lit(i in there) for i in range(len(values))])
    return (
        lookup_join(rows.select("id", "h1", "h2"), whitened.drop("weight"), ["h1", "h2"], "inner")
        .select("id", "deviation", F.posexplode("z").alias("i", "value"))
        .select(
            F.col("id").alias(id_col),
            (F.col("i") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            F.when(F.get(real, "i"), F.col("value")).alias("whitened"),
            F.get(explained, "i").alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )

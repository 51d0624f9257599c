"""Embedding whitening by matrix-free block subspace iteration.

The covariance V of the vectors is never formed. A block Q of orthonormal directions is held by the driver (dimensions
times block width, so its size doesn't depend on the rows); each Spark pass multiplies it by V as Xᵀ(XQ) on centred
rows, one partial product a task, added up in a tree. Rayleigh-Ritz in the span of Q gives eigenvalue and eigenvector
estimates with their residuals |Vy - ey|; QR makes the product the next block. It ends when the residuals of all wanted
components are at rounding error. Where the spectrum falls too slowly for the block's width, the block is widened: at
the width of all dimensions a single pass is exact, so the number of passes is bounded whatever the spectrum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vesselflow.llm import _common as C

COMPONENTS = 32
#: Entries become floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this many units count as this many, so that sums of up to 2**32 rows are exact.
MOST = 2**31 - 1
#: Rows of a block, and partial products that one task adds up.
ROWS, FAN_IN = 4096, 32
#: Residual at which a component is certified, as a share of the greatest eigenvalue.
TOLERANCE = 1e-13
#: A block that would need more passes than this is widened.
PASSES = 8
_PART = "part long, m binary"


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector is there, not empty and holds neither null nor non-finite entries."""
    odd = F.exists(vec, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    return vectors.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & ~odd)


def blocked(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding") -> tuple[DataFrame, int] | None:
    """The usable rows of the commonest length (the greatest of several) as a staged table of blocks (ids, x as 32-bit integers), and the length; None without any."""
    good = usable(vectors, vec).select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("v"))
    top = good.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if top is None:
        return None
    dims = top["dims"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_pylist()
            c = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
            x = np.clip(np.floor(np.clip(SCALE * c, -2.0 * MOST, 2.0 * MOST)) + SHIFT, -MOST, MOST).astype("<i4")
            starts = range(0, len(ids), ROWS)
            yield pa.RecordBatch.from_arrays([pa.array([ids[i : i + ROWS] for i in starts], pa.list_(pa.int64())), pa.array([x[i : i + ROWS].tobytes() for i in starts], pa.binary())], ["ids", "x"])

    return C.stage(good.where(F.size("v") == dims).mapInArrow(run, "ids array<long>, x binary")), dims


def _added(parts: DataFrame, width: int) -> np.ndarray:
    """Sum of the partial matrices (part, m), in the order of their parts, by tasks of FAN_IN each; the driver adds the last FAN_IN."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        ms = [np.frombuffer(m) for m in pdf.sort_values("part")["m"]]
        return pd.DataFrame({"part": [int(pdf["part"].min()) // FAN_IN], "m": [np.sum(ms, axis=0).tobytes()]})

    n = parts.rdd.getNumPartitions()
    while n > FAN_IN:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("_g")).applyInPandas(add, _PART)
        n = -(-n // FAN_IN)
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    return np.sum([np.frombuffer(r["m"]).reshape(-1, width) for r in rows], axis=0)


def _each_task(blocks: DataFrame, partial) -> DataFrame:
    """One row (part, m) for each task that has blocks: the sum of `partial(x)` over them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for x in pdf["x"]:
                m = partial(np.frombuffer(x, dtype="<i4"))
                total = m if total is None else total + m
        if total is not None:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "m": [np.ascontiguousarray(total, dtype=np.float64).tobytes()]})

    return blocks.select("x").mapInPandas(run, _PART)


def totals(blocks: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums of each dimension."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = 0, np.zeros(dims, dtype=np.int64)
        for pdf in batches:
            for x in pdf["x"]:
                rows = np.frombuffer(x, dtype="<i4").reshape(-1, dims)
                n, s = n + len(rows), s + rows.sum(axis=0, dtype=np.int64)
        yield pd.DataFrame({"i": range(-1, dims), "s": [n, *s.tolist()]})

    got = {r["i"]: r["s"] for r in blocks.select("x").mapInPandas(run, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    return got[-1], np.array([got[i] for i in range(dims)], dtype=np.int64)


def _centre(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """Rows less the mean: n * x - S is exact in integers, so that only the division rounds."""
    return (x.reshape(-1, len(s)).astype(np.int64) * n - s) / n


def product(blocks: DataFrame, n: int, s: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q by one pass over the rows, and the trace of V."""

    def partial(x: np.ndarray) -> np.ndarray:
        c = _centre(x, n, s)
        return np.column_stack([c.T @ (c @ q), np.einsum("ij,ij->j", c, c)])

    m = _added(_each_task(blocks, partial), q.shape[1] + 1) / n
    return m[:, :-1], float(m[:, -1].sum())


def principal(blocks: DataFrame, n: int, s: np.ndarray, k: int = COMPONENTS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, float, int]:
    """Eigenvalues (falling), unit eigenvectors as columns, the trace and the number of passes.

    Directions without variance have no components, so there may be fewer than k.
    """
    d = len(s)
    k = min(k, d)
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.standard_normal((d, min(d, 2 * k))))[0]
    passes = 0
    while True:
        z, trace = product(blocks, n, s, q)
        passes += 1
        t = q.T @ z
        values, u = np.linalg.eigh((t + t.T) / 2)
        values, u = values[::-1], u[:, ::-1]
        z, y = z @ u, q @ u
        left = np.linalg.norm(z[:, :k] - y[:, :k] * values[:k], axis=0).max()
        if q.shape[1] == d or left <= tolerance * max(values[0], 0.0):
            break
        # A pass shrinks the residual of the last wanted component by the ratio of the block's last eigenvalue to its own.
        ratio = max(values[-1], 0.0) / values[k - 1] if values[k - 1] > 0 else 1.0
        slow = ratio > 0 and (ratio >= 1 or np.log(tolerance * values[0] / left) / np.log(ratio) > PASSES)
        wide = rng.standard_normal((d, min(d, 2 * q.shape[1]) - q.shape[1])) * np.linalg.norm(z, axis=0).mean() if slow else np.empty((d, 0))
        q = np.linalg.qr(np.column_stack([z, wide]))[0]
    held = np.flatnonzero(values[:k] > 64 * d * np.finfo(float).eps * max(values[0], 0.0)) if values[0] > 0 else []
    y = y[:, :k][:, held]
    return values[:k][held], y / np.linalg.norm(y, axis=0), trace, passes


def _deviation(x: np.ndarray, n: int, s: np.ndarray) -> list[int | None]:
    """Exact sum over the dimensions of (n * x - S) ** 2; None where it is no 64-bit integer."""
    d = x.reshape(-1, len(s)).astype(np.int64) * n - s
    if float(np.abs(d).max(initial=0)) ** 2 * len(s) < 2.0**62:
        return np.einsum("ij,ij->i", d, d).tolist()
    exact = [sum(v * v for v in row) for row in d.tolist()]
    return [v if v < 2**63 else None for v in exact]


def whiten(vectors: DataFrame, k: int = COMPONENTS, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors are dropped that are null, empty, hold null or non-finite entries, or have another length than most. Repeated
    rows and ids and null ids are vectors of their own. Entries beyond 2**31 units count as that many. A deviation that no
    64-bit integer holds is null. Where no direction varies (no vector, one, or all equal) there are no rows. Other
    columns of `vectors` are not read.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = blocked(vectors, vec_id, vec)
    if found is None:
        return spark.createDataFrame([], schema)
    blocks, dims = found
    n, s = totals(blocks, dims)
    values, y, trace, _ = principal(blocks, n, s, k)
    if not len(values):
        return spark.createDataFrame([], schema)
    to = y / np.sqrt(values)
    width = len(values)

    def gram(x: np.ndarray) -> np.ndarray:
        w = _centre(x, n, s) @ to
        return np.vstack([w.T @ w, w.sum(axis=0)])

    g = _added(_each_task(blocks, gram), width) / n
    error = float(np.abs(g[:-1] - np.outer(g[-1], g[-1]) - np.eye(width)).max())
    explained = values / trace

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, raw in zip(pdf["ids"], pdf["x"], strict=True):
                x = np.frombuffer(raw, dtype="<i4")
                w = _centre(x, n, s) @ to
                yield pd.DataFrame(
                    {
                        "vec_id": pd.Series(list(ids), dtype=object).repeat(width).reset_index(drop=True),
                        "component": np.tile(np.arange(1, width + 1, dtype=np.int32), len(w)),
                        "n": n,
                        "deviation": pd.Series(_deviation(x, n, s), dtype=object).repeat(width).reset_index(drop=True),
                        "whitened": w.ravel(),
                        "explained": np.tile(explained, len(w)),
                        "identity_error": error,
                    }
                )

    return blocks.mapInPandas(run, schema)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(C.table(spark, sf_dir, "embeddings"))

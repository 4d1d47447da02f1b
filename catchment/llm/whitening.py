"""Whitening of embeddings by shifted CholeskyQR over distributed Gram passes.

Vectors are quantised to integers, centred on the exact mean, and orthogonalised in passes: each pass runs over all
rows in their partitions, applies the inverse of the triangular factor composed so far to the centred rows (a
triangular solve per batch), and sums their Gram matrix across partitions. The first pass is shifted so that its
Cholesky factor exists for any rank; two more passes bring the rows to orthonormal. The composed factor R holds the
geometry of the centred rows (A = Q R), so the singular value decomposition of R alone, on the driver and of size
dimensions squared, gives the components and their variances. A last pass projects every row and measures how far
the whitened values are from unit covariance.

Defined cases: rows with a null vector or a null, NaN or infinite entry are dropped; of the remaining lengths the
most frequent (ties: the longer) is fitted and rows of other lengths are dropped as well; extra columns of the
frame never clash with the ones made here. Components whose variance is not above 1e-12 of the total variance (as
for constant data or a single row) are not returned, since they cannot be scaled to unit variance; an empty table
or one without such a component gives no rows. Repeated rows count as many times as they appear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Unit round-off of double precision.
UNIT = 2.0**-53


def quantised(frame: DataFrame, column: str, key: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    """Rows with a whole vector of the fitted length, as (key, x) with x = floor(scale * c) + offset; and the length."""
    whole = frame.where(F.col(column).isNotNull()).where(F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))))
    rows = whole.select(F.col(key).alias("key"), F.transform(column, lambda c: F.floor(c.cast("double") * scale) + offset).alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.where(F.size("x") == d), d


def squared_deviation(total: list[int], n: int) -> Column:
    """Exactly, the sum over dimensions of (n * x - S)^2 for a row's integer vector x and the sums S of all rows."""
    sums = F.array(*[F.lit(s).cast("decimal(38,0)") for s in total])
    gap = lambda x, s: x.cast("decimal(38,0)") * F.lit(n).cast("decimal(38,0)") - s
    return F.aggregate(F.zip_with("x", sums, lambda x, s: gap(x, s) * gap(x, s)), F.lit(0).cast("decimal(38,0)"), lambda a, v: a + v)


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, d)


def gram(rows: DataFrame, d: int, mean: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Sum over all rows of q q^T, where q solves q R = x - mean for the upper triangular factor R."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch, d) - mean
                q = np.linalg.solve(factor.T, centred.T).T
                total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d)), pa.array(total.ravel())], ["cell", "value"])

    summed = rows.select("x").mapInArrow(partial, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(d * d)
    for row in summed.collect():  # d * d values, whatever the number of rows
        out[row["cell"]] = row["value"]
    return out.reshape(d, d)


def shifted_cholesky_qr(rows: DataFrame, d: int, n: int, mean: np.ndarray, passes: int = 3) -> np.ndarray | None:
    """The upper triangular R of the centred rows A = Q R, composed over shifted and plain CholeskyQR passes.

    The first pass is shifted; a later one is shifted too only where its Gram matrix is singular, as for rows that
    span fewer dimensions than they have. None if the rows do not vary at all.
    """
    factor = np.eye(d)
    for step in range(passes):
        g = gram(rows, d, mean, factor)
        g = (g + g.T) / 2
        if step == 0 and np.trace(g) <= 0:
            return None
        shift = 11 * (n * d + d * (d + 1)) * UNIT * np.trace(g)
        try:
            r = np.linalg.cholesky(g + (shift if step == 0 else 0.0) * np.eye(d)).T
        except np.linalg.LinAlgError:
            r = np.linalg.cholesky(g + shift * np.eye(d)).T
        factor = r @ factor
    return factor


def whiten(frame: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row per kept vector and component: key, component, n, deviation, whitened, explained, identity_error."""
    spark = frame.sparkSession
    rows, d = quantised(frame, column, key, scale, offset)
    sums = rows.agg(F.count("*").alias("n"), *[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first() if d else None
    n = sums["n"] if sums else 0
    total = [int(sums[f"s{i}"]) for i in range(d)] if n else []
    mean = np.array(total, dtype=np.float64) / max(n, 1)
    r = shifted_cholesky_qr(rows, d, n, mean) if n >= 2 else None
    if r is None:
        kept = 0
    else:
        _, sigma, vt = np.linalg.svd(r)
        variance = sigma**2 / n
        # The exact trace of the covariance, from integer sums of squared deviations.
        trace = float(rows.select(squared_deviation(total, n).cast("double").alias("q")).agg(F.sum("q")).first()[0]) / n**3
        kept = int(min(components, np.sum(variance > 1e-12 * trace)))
        picked = vt[:kept].T.copy()
        # One sign for each component: its entry of largest size is positive.
        picked *= np.where(picked[np.abs(picked).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0)
        picked /= np.sqrt(variance[:kept])
        explained = variance[:kept] / trace
        check = gram(_projected(rows, d, mean, picked), kept, np.zeros(kept), np.eye(kept)) if kept else np.zeros((0, 0))
        error = float(np.abs(check / n - np.eye(kept)).max()) if kept else 0.0
    if not kept:
        return spark.createDataFrame([], f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(v)) for v in explained])
    with_dev = rows.select("key", "x", squared_deviation(total, n).cast("long").alias("dev"))
    projected = _projected(with_dev, d, mean, picked, with_key=True).select("key", "dev", F.posexplode("w").alias("at", "whitened"))
    return projected.select(
        F.col("key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        F.col("dev").alias("deviation"),
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def _projected(rows: DataFrame, d: int, mean: np.ndarray, picked: np.ndarray, with_key: bool = False) -> DataFrame:
    """Centred rows times the scaled components: as `x` arrays for a Gram pass, or as `w` beside key and dev."""
    k = picked.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = (_matrix(batch, d) - mean) @ picked if batch.num_rows else np.zeros((0, k))
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k) if k else np.zeros(batch.num_rows + 1, np.int64), pa.int32()), pa.array(w.ravel()))
            if with_key:
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("dev"), values], ["key", "dev", "w"])
            else:
                yield pa.RecordBatch.from_arrays([values], ["x"])

    if with_key:
        return rows.select("key", "dev", "x").mapInArrow(project, "key long, dev long, w array<double>")
    return rows.select("x").mapInArrow(project, "x array<double>")

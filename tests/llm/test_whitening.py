"""Whitening by shifted CholeskyQR against a brute-force eigen-decomposition, and its defined cases."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catchment.llm import whitening
from catchment.llm.queries import op12_whitening

SF_DIR = "/root/testdata/sf0.01"


def brute(rows: list[tuple[int, list[float] | None]], components: int = 32):
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    keys = [k for k, _ in kept]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    a = x - s / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order]
    k = min(components, int(np.sum(values > 1e-12 * values.sum())))
    dev = [sum((n * int(xi) - int(si)) ** 2 for xi, si in zip(row, s)) for row in x]
    return keys, n, dev, a @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_query_equals_brute_force(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()
    keys, n, dev, white, share = brute([(r["vec_id"], r["embedding"]) for r in table])
    got = op12_whitening(spark, SF_DIR).toPandas()
    assert len(got) == len(keys) * white.shape[1] and (got["n"] == n).all()
    at = {k: i for i, k in enumerate(keys)}
    for comp, part in got.groupby("component"):
        i = np.array([at[k] for k in part["vec_id"]])
        mine = part["whitened"].to_numpy()
        sign = np.sign(mine @ white[i, comp - 1])
        assert np.abs(mine - sign * white[i, comp - 1]).max() < 1e-6
        assert np.abs(part["explained"].to_numpy() / share[comp - 1] - 1).max() <= 1e-4
    assert all(got["deviation"].to_numpy() == np.array([dev[at[k]] for k in got["vec_id"]]))
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] <= 1e-4


def test_nulls_lengths_repeats_and_clashing_columns(spark):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, rng.normal(size=4))) for _ in range(30)]
    rows = [(i, v, "extra") for i, v in enumerate(vectors)] + [(100, None, "a"), (101, [1.0, None, 0.0, 0.0], "b"), (102, [float("nan"), 0.0, 0.0, 0.0], "c"), (103, [float("inf")] * 4, "d"), (104, [1.0, 2.0], "e"), (105, vectors[0], "f")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string").withColumn("n", F.lit(7))
    got = whitening.whiten(frame).toPandas()
    kept = sorted(set(got["vec_id"]))
    assert kept == list(range(30)) + [105]
    keys, n, dev, white, _ = brute([(k, v) for k, v, _ in rows if k != 104])
    assert (got["n"] == n).all() and got["component"].max() == 4


def test_empty_constant_and_single_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])], schema)).toPandas()
    assert sorted(line["vec_id"]) == [1, 2, 3] and (line["component"] == 1).all()
    assert line["explained"].iloc[0] == pytest.approx(1.0) and line["identity_error"].iloc[0] < 1e-9

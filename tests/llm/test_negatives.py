"""Hard negatives by the inverted multi-index against a brute-force search over all rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from catchment.llm import negatives
from catchment.llm.queries import op11_negatives

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, anchor_every=100, k=5):
    """rows: (key, label, vector); the contract's rules in plain Python."""
    kept = [
        (key, (label + 1) % 10 if key % 7 == 0 else label, [math.floor(256 * float(c)) for c in vec])
        for key, label, vec in rows
        if key is not None and label is not None and vec is not None and all(c is not None and math.isfinite(c) for c in vec)
    ]
    out = []
    for a_key, a_label, a in kept:
        if a_key % anchor_every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(a, x)), key, label) for key, label, x in kept if key != a_key), key=lambda t: (t[0], t[1]))
        pos = [(key, -s) for s, key, label in scored if label == a_label][:k]
        for p_key, ps in pos:
            window = [(key, -s) for s, key, label in scored if label != a_label and 80 * ps <= 100 * -s <= 100 * ps]
            window = sorted(window, key=lambda t: (-t[1], t[0]))[:k]
            out += [(a_key, p_key, r + 1, key, ps, s) for r, (key, s) in enumerate(window)]
    return sorted(out)


def test_query_equals_brute_force(spark):
    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()
    want = brute([(r["vec_id"], r["label"], [float(np.float32(c)) for c in r["embedding"]] if r["embedding"] is not None else None) for r in table])
    got = sorted(tuple(r) for r in op11_negatives(spark, SF_DIR).collect())
    assert got == want and len(want) > 20


def test_hot_vector_ties_nulls_and_small_codebooks(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(scale=0.2, size=(120, 6))
    base[40:80] = base[40]  # one vector repeated many times: ties broken by key
    rows = [(i, int(i % 3), [float(v) for v in base[i]], "x") for i in range(120)]
    rows += [(200, None, [0.1] * 6, "n"), (300, 1, None, "n"), (400, 2, [float("nan")] * 6, "n"), (500, 0, [0.1, None, 0.0, 0.0, 0.0, 0.0], "n")]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, key string")
    for codes in (1, 3, 8):
        got = sorted(tuple(r) for r in negatives.mine(*_rows(frame), codes=codes, sample=50, chunk_rows=7).collect())
        want = brute([(k, l, v) for k, l, v, _ in rows], anchor_every=10)
        assert got == want


def _rows(frame):
    moved = frame.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    rows, d = negatives.prepared(moved, "embedding", "vec_id", "label", scale=256)
    return rows, rows.where(F.col("key") % 10 == 0), d


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, label int, embedding array<double>")
    assert negatives.mine(*_rows(frame)).count() == 0

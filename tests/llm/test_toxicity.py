"""Segments against brute force, held-out accuracy, calibration, odd rows."""

from __future__ import annotations

import random
import zlib

import pytest

from catchment.llm import toxicity
from catchment.llm.queries import op10_toxicity


def brute_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """By definition: the best-scoring stretch (the shortest, then the first), and the same left and right of it."""
    def search(low: int, high: int):
        best = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                if total > 1e-12 and (best is None or total > best[2] + 1e-9):
                    best = (a, b, total)
        return [] if best is None else search(low, best[0]) + [best] + search(best[1] + 1, high)

    return search(0, len(scores))


@pytest.mark.parametrize("seed", range(40))
def test_linear_scan_finds_the_maximal_segments(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 60)
    found = [(i, rng.uniform(0.2, 3)) for i in range(n) if rng.random() < 0.2]
    scores = [-0.5] * n
    for i, w in found:
        scores[i] = w
    got = toxicity.maximal_segments(found, 0.5)
    want = brute_segments(scores)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [s for _, _, s in got] == pytest.approx([s for _, _, s in want])


def test_far_apart_hits_take_linear_time():
    # every hit stands alone and starts lower than all before it: a scan that steps down one candidate at a time is
    # quadratic here (8 000 hits took 3.5 s), following the links is linear
    import time

    found = [(i * 1000, 1.0) for i in range(64000)]
    began = time.perf_counter()
    got = toxicity.maximal_segments(found, 0.5)
    assert time.perf_counter() - began < 3.0
    assert len(got) == 64000 and got[-1] == (63999000, 63999000, 1.0)


def test_longest_known_beginning_decides():
    weights = {"scum$": 3.0, "worth": 2.0, "worthy$": 0.0}
    heads = toxicity.Model(weights).heads()
    assert toxicity.events("Scum! worthy worthless, scums", weights, heads) == (4, [(0, 3.0), (2, 2.0)])


def test_evidence_grows_with_scores_and_shrinks_with_length():
    one = toxicity.evidence(100, [5.0], 2.0, 0.1)
    assert toxicity.evidence(100, [6.0], 2.0, 0.1) > one > toxicity.evidence(10000, [5.0], 2.0, 0.1)
    assert toxicity.evidence(100, [5.0, 5.0], 2.0, 0.1) == pytest.approx(2 * one)
    assert toxicity.evidence(100, [], 2.0, 0.1) == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in op10_toxicity(spark, folder).collect() if r.held_out and r.doc_id in toxic]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    caught = [r.predicted for r in held if toxic[r.doc_id] == 1]
    blamed = [r.predicted for r in held if toxic[r.doc_id] == 0]
    assert sum(caught) / len(caught) > 0.85 and sum(blamed) / len(blamed) < 0.01
    assert all(r.predicted == (r.score >= 0.5) for r in held)


def test_passages(spark):
    model = toxicity.Model({"bad$": 4.0}, rate=2.0, factor=0.01)
    rows = [("fine words " * 30 + "bad bad and bad " + "fine words " * 30,), (None,), ("",)]
    got = [r.p for r in spark.createDataFrame(rows, "text string").select(toxicity.passages("text", model).alias("p")).collect()]
    assert [(p.first, p.last) for p in got[0]] == [(60, 63)] and got[0][0].p < 0.01 and got[1] == got[2] == []


def test_odd_rows(spark, tmp_path):
    docs = [(i, f"word{i % 7} plain text", "x") for i in range(30)] + [(100, None, "x"), (100, None, "x"), (None, "", "x"), (101, "é " * 50000, "x")]
    spark.createDataFrame(docs, "doc_id long, text string, toxic string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 0, None), (1, 0, 1), (None, 0, 1), (999, 1, 0), (100, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = op10_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = toxicity.train(empty, spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.weights == {} and empty.select(toxicity.score("text", model)).count() == 0


def test_held_out_ranking_from_few_labels(spark, tmp_path):
    # 16 toxic documents of 120, each with one of four words or with one beginning repeated: one split in four and five
    # documents a token left too little to learn from, and every text got the same score
    rng = random.Random(5)
    plain = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(80)]
    docs, labels = [], []
    for i in range(120):
        words = [rng.choice(plain) for _ in range(60)]
        toxic = int(i % 8 == 0)
        if toxic:
            extra = ["rotten", "filthy", "wretch", "vermin"][i // 8 % 4]
            for _ in range(3):
                words.insert(rng.randrange(60), extra if i % 16 else "quazzo" + rng.choice(plain))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = [(r.score, labels[r.doc_id][2]) for r in op10_toxicity(spark, str(tmp_path)).collect() if r.held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held for b, y in held if x > y]
    assert pairs and sum(pairs) / len(pairs) > 0.75


def test_no_slope_is_below_zero():
    import numpy as np

    x = np.array([[0.0, 5.0], [0.0, 4.0], [2.0, 0.0], [3.0, 0.0], [0.0, 3.0], [1.0, 6.0]])
    slopes, _ = toxicity._logistic(x, np.array([0.0, 0.0, 1.0, 1.0, 0.0, 0.0]))
    assert slopes[0] > 0 and slopes[1] == 0

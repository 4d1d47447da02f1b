"""Vector links against all pairs, with copies, tight groups, small cells and unsound vectors."""

from __future__ import annotations

import os
import threading

import numpy as np
import pyarrow as pa
import pytest

from catchment.llm import embeddings as e

SCHEMA = "vec_id long, embedding array<float>, root string"


def rows(seed: int, dims: int) -> list[tuple[int | None, list[float] | None, str]]:
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((120, dims))
    tight = base[0] + 0.12 * rng.standard_normal((40, dims))
    chain = [base[1] / np.linalg.norm(base[1])]
    for _ in range(12):
        step = rng.standard_normal(dims)
        chain.append(chain[-1] + 0.28 * step / np.linalg.norm(step))
    every = np.vstack([base, tight, 3 * np.array(chain), base[2:5], base[5:6] * 7]).astype(np.float32)
    out = [(int(i), [float(x) for x in v], "x") for i, v in enumerate(every)]
    out += [(500, None, "x"), (501, [], "x"), (502, [0.0] * dims, "x"), (503, [float("nan")] + [1.0] * (dims - 1), "x")]
    out += [(504, [None] + [1.0] * (dims - 1), "x"), (505, [1.0] * (dims - 1), "x"), (506, [float("inf")] * dims, "x"), (507, [1.0] * (dims - 1), "x")]
    rng.shuffle(out)
    return [tuple(r) for r in out]


def brute(data):
    sound = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, _ in data]
    n = len(data)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and sound[i] and sound[j] and len(data[i][1]) == len(data[j][1]):
                a, b = np.array(data[i][1], float), np.array(data[j][1], float)
                near[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95
    label = [r[0] for r in data]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            least = min([label[i], *(label[j] for j in np.flatnonzero(near[i]))])
            changed, label[i] = changed or least != label[i], least
    return sorted((r[0], int(near[i].sum()), label[i], r[0] == label[i]) for i, r in enumerate(data))


@pytest.mark.parametrize("seed,dims,cell,part", [(1, 64, 4096, 1 << 21), (2, 24, 20, 1 << 21), (3, 64, 8, 2000), (4, 5, 10, 100)])
def test_against_all_pairs(spark, monkeypatch, seed, dims, cell, part):
    monkeypatch.setattr(e, "CELL", cell)
    monkeypatch.setattr(e, "PART_VALUES", part)
    data = rows(seed, dims)
    got = e.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute(data)
    assert any(r.n_links > 10 for r in got)


def test_odd_rows(spark):
    data = [(None, [1.0, 0.0], ""), (4, [1.0, 0.0], ""), (4, [1.0, 0.0], ""), (9, [0.0, 1.0], ""), (None, None, "")]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in e.near_duplicates(spark.createDataFrame(data, SCHEMA)).collect()), key=str)
    assert got == [(4, 2, 4, True), (4, 2, 4, True), (9, 0, 9, True), (None, 0, None, False), (None, 2, 4, False)]
    assert e.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed,dims,tile,leaf", [(5, 64, 30, 2), (6, 24, 9, 1), (7, 100, 400, 16), (8, 5, 100, 4)])
def test_trees_of_two_chunks_against_all_pairs(monkeypatch, seed, dims, tile, leaf):
    monkeypatch.setattr(e, "TILE", tile)
    monkeypatch.setattr(e, "LEAF", leaf)
    x = np.array([v for _, v, _ in rows(seed, dims) if v and len(v) == dims and None not in v and np.isfinite(v).all() and any(v)])
    n, copies = len(x), np.arange(len(x)) % 3 + 1
    held = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(copies), pa.array([c.tobytes() for c in e.rounded(x)])], names=["node", "copies", "code"])
    cosine = (x @ x.T) / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
    near = (cosine >= 0.95) & ~np.eye(n, dtype=bool)
    links, sets, times = np.zeros(n, int), e._Sets(n), np.zeros((n, n), int)
    for b in range(len(e.blocks(dims))):
        one, two = (e._chunk([part], dims, b, 0.95).to_pylist()[0] for part in (held.slice(0, n // 3), held.slice(n // 3)))
        for chunks in ([one], [two], [one, two]):
            pair = e._Pair(chunks, dims, b, 0.95)
            links[pair.node] += pair.links
            sets.merge(pair.node, pair.node[pair.sets.parent])
            for u, v in pair.unsure:
                times[u, v] += 1
                yes = cosine[u, v] >= 0.95
                np.add.at(links, u[yes], copies[v[yes]])
                np.add.at(links, v[yes], copies[u[yes]])
                sets.merge(u[yes], v[yes])
    assert links.tolist() == (near @ copies).tolist() and links.max() > 20
    assert (times + times.T).max() <= 1
    reached = np.linalg.matrix_power((near | np.eye(n, dtype=bool)).astype(float), 64) > 0
    assert sets.parent.tolist() == reached.argmax(1).tolist()


def test_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    data = []
    for i, off in enumerate([-3e-4, -3e-5, -1e-6, 0, 1e-6, 3e-5, 3e-4]):
        x, y = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
        c = 0.95 + off
        data += [(10 * i, x.tolist(), ""), (10 * i + 1, (5 * (c * x + np.sqrt(1 - c * c) * y)).tolist(), ""), (10 * i + 2, x.tolist(), "")]
    data += [(90, [0.0, 1.0], ""), (91, [-0.0, 1.0], ""), (92, [1e-200, 0.0], ""), (93, [3e200, -0.0], "")]
    got = e.near_duplicates(spark.createDataFrame(data, SCHEMA.replace("float", "double"))).collect()
    want = brute([r for r in data if r[0] < 90]) + [(90, 1, 90, True), (91, 1, 90, False), (92, 1, 92, True), (93, 1, 92, False)]
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert {r.n_links for r in got if r.vec_id % 10 == 1 and r.vec_id < 90} == {0, 2}


def test_disk_grows_with_the_vectors_alone(spark, monkeypatch):
    """Cells that each vector can reach by the dozen: shuffles and stored tables stay within four times the vectors' bytes."""
    monkeypatch.setattr(e, "CELL", 25)
    vectors = np.random.default_rng(9).standard_normal((4000, 64)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    dirs = [d.toString() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    dirs.append(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    most, over = [], threading.Event()

    def used():
        total = 0
        for d in dirs:
            for at, _, names in os.walk(d):
                for n in names:
                    if "broadcast" not in n:
                        try:
                            total += os.path.getsize(f"{at}/{n}")
                        except OSError:
                            pass  # gone meanwhile
        return total

    def watch():
        while not over.wait(0.05):
            most.append(used())

    before = used()
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        got = e.near_duplicates(frame).collect()
    finally:
        over.set()
        watcher.join()
    assert len(got) == 4000 and not any(r.n_links for r in got)
    assert max(most) - before < 4 * vectors.nbytes + 4e6

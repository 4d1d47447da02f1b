"""SimHash against brute force: fingerprints by definition, links by all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from catchment.llm import simhash
from catchment.llm.components import components
from catchment.llm.queries import op4_simhash


def by_definition(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(fps: dict[int, int]) -> dict[int, int]:
    label = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def texts(rng: random.Random) -> list[tuple[int, str | None]]:
    words = [f"w{i}" for i in range(500)]
    out: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one\x0btwo"), (5, "Été À A b c d e")]
    base = rng.choices(words, k=400)
    for i in range(6, 90):
        kind = rng.random()
        if kind < 0.5:
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((i, " ".join(copy)))
        elif kind < 0.7:
            out.append((i, rng.choice(out)[1]))
        else:
            out.append((i, " ".join(rng.choices(words, k=rng.randint(1, 60)))))
    rng.shuffle(out)
    return out


def test_query_by_brute_force(spark, tmp_path):
    rows = texts(random.Random(5))
    spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, str(tmp_path)).collect()}
    fps = {i: by_definition(t) for i, t in rows}
    label = components_of(fps)
    assert got == {i: (f"{fps[i]:016x}", label[i]) for i, _ in rows}
    assert len(set(label.values())) < len(rows)


def test_variants_lose_no_pair(spark):
    rng = random.Random(6)
    fps = []
    for _ in range(60):
        fp = rng.getrandbits(64)
        fps += [fp, fp ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))]
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).distinct().collect()
    want = {frozenset((a, b)) for a, x in zip(signed, fps) for b, y in zip(signed, fps) if a != b and (x ^ y).bit_count() <= 4}
    assert {frozenset((r.u, r.v)) for r in links} == want


def test_large_groups_are_joined_without_all_pairs():
    rng = random.Random(7)
    center = rng.getrandbits(64)
    fps = np.unique(np.array([center ^ sum(1 << b for b in rng.sample(range(40, 64), 2)) for _ in range(250)], np.uint64)).view(np.int64)
    u, v = simhash.link_groups(np.zeros(len(fps), np.int64), fps, 4)
    assert len(u) == len(fps) - 1 and set(v) == {fps[0]}


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 175)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 200: 150, 175: 150}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(spark):
    rows = [(None, "a b c d e", 1), (7, "a b c d e", 1), (7, "a b c d e", 1), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == [(7, 7), (7, 7), (None, 7), (None, None)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0

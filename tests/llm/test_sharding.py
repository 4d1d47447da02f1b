"""Sharding: sizes, places, balance and growth, by recounting rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

from catchment.llm import sharding
from catchment.llm.queries import op6_sharding


def documents(spark, rows, at):
    spark.createDataFrame(rows, "doc_id long, text string, shard string, vslot int").write.parquet(f"{at}/documents.parquet")


def check(rows, got):
    def size(text):
        return len((text or "").encode()) + 16

    want = Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 40
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    held = Counter()
    for r in got:
        held[r.shard] += r["size"]
    return held


def test_query_balances_bytes(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "é" * rng.choice([3, 50, 400, 3000]), "x", 1) for i in range(4000)]
    documents(spark, rows, tmp_path)
    held = check(rows, op6_sharding(spark, str(tmp_path)).collect())
    mean = sum(held.values()) / 40
    assert max(held.values()) < 1.01 * mean and min(held.values()) > 0.99 * mean


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None), (None, "a", None, None), (5, "", "x", 3), (5, "", "x", 3), (5, "b" * 300000, "x", 3)]
    documents(spark, rows, tmp_path)
    check(rows, op6_sharding(spark, str(tmp_path)).collect())
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(empty, 40).count() == 0


def test_growth_moves_slots_only_into_the_new_shard(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 700)) for i in range(3000)], "doc_id long, text string")
    records = sharding.sized(docs, 512)
    loads = sharding.slot_loads(records, 512)
    maps = sharding.SlotMaps(spark)
    before = maps.put(sharding.rebalance(maps.put(sharding.first_map(spark, 7, 512), 0), loads, 7), 1)
    after = maps.put(sharding.grow(before, loads, 7), 2)
    moved = before.alias("b").join(after.alias("a"), "vslot").where("a.shard <> b.shard").select("a.shard").distinct().collect()
    assert [r.shard for r in moved] == [7]
    held = {r.shard: r.n for r in after.join(loads, "vslot").groupBy("shard").agg({"bytes": "sum"}).withColumnRenamed("sum(bytes)", "n").collect()}
    assert 0.8 < held[7] / (sum(held.values()) / 8) <= 1.02
    assert maps.get(0).count() == 512


def test_rebalance_moves_few_slots(spark):
    loads = spark.createDataFrame([(s, 1000 + (s * 37) % 200, 1) for s in range(512)], "vslot int, bytes long, rows long")
    before = sharding.first_map(spark, 8, 512)
    after = sharding.rebalance(before, loads, 8)
    assert before.alias("b").join(after.alias("a"), "vslot").where("a.shard <> b.shard").count() < 40


def test_no_python_in_the_plan(spark, tmp_path):
    documents(spark, [(1, "a", "x", 1)], tmp_path)
    plan = op6_sharding(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""A small change rewrites only the buckets its keys fall in, by Spark's dynamic partition overwrite."""

from __future__ import annotations

import pytest

from catchment.streaming import sync


def files_by_bucket(folder):
    return {b.name: sorted(f.name for f in b.glob("*.parquet")) for b in (folder / "data").glob("bucket=*")}


def test_merge_rewrites_touched_buckets_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.range(1000).selectExpr("id", "concat('n', id) as name", "1L as ts")
    sync.merge_into(first, path, "id", "ts", buckets=16)
    before = files_by_bucket(tmp_path / "t")
    change = spark.createDataFrame([(7, "seven", 2), (5000, "new", 2)], "id bigint, name string, ts bigint")
    sync.merge_into(change, path, "id", "ts")
    after = files_by_bucket(tmp_path / "t")
    assert len(before) == len(after) == 16 and sum(before[b] != after[b] for b in before) in (1, 2)
    table = sync.read_current(spark, path)
    assert table.count() == 1001 and table.columns == ["id", "name", "ts"]
    assert rows(table.filter("id in (6, 7, 5000)")) == [(5000, "new", 2), (6, "n6", 1), (7, "seven", 2)]
    # Any Parquet reader sees the table as it is: partitioned files, no bookkeeping of its own.
    assert spark.read.parquet(f"{path}/data").count() == 1001
    # An older change is kept out only when asked.
    old = spark.createDataFrame([(7, "older", 1)], "id bigint, name string, ts bigint")
    sync.merge_into(old, path, "id", "ts", newer_only=True)
    assert rows(sync.read_current(spark, path).filter("id = 7")) == [(7, "seven", 2)]
    sync.merge_into(old, path, "id", "ts")
    assert rows(sync.read_current(spark, path).filter("id = 7")) == [(7, "older", 1)]


def test_repeated_merges_keep_every_row(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for i in range(5):
        sync.merge_into(spark.createDataFrame([(k, i, i) for k in range(i, 8)], "id int, v int, ts int"), path, "id", "ts", buckets=4)
    assert rows(sync.read_current(spark, path)) == [(k, min(k, 4), min(k, 4)) for k in range(8)]
    assert len(list((tmp_path / "t" / "data").glob("bucket=*"))) <= 4


def test_a_failed_merge_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sync.merge_into(spark.createDataFrame([(1, 1, 1), (2, 2, 2)], "id int, v int, ts int"), path, "id", "ts", buckets=4)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(sync, "upsert", broken)
    with pytest.raises(RuntimeError, match="lost"):
        sync.merge_into(spark.createDataFrame([(3, 3, 3)], "id int, v int, ts int"), path, "id", "ts")
    assert {r["id"] for r in sync.read_current(spark, path).collect()} == {1, 2}

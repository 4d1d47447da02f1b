"""Tiling against brute force, reordered passages, and odd rows."""

from __future__ import annotations

import random
import re

import pytest

from catchment.llm import decontamination as d
from catchment.llm.queries import op1_decontamination


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_tiles(doc: list[str], item: list[str], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling as first published: scan for the longest unmarked match, mark it, repeat."""
    there, here, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not here[p + n] and not there[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        here[p : p + n] = there[t : t + n] = [True] * n
        tiles.append((t, p, n))


@pytest.mark.parametrize("seed", range(12))
def test_tiling_is_greedy(seed):
    rng = random.Random(seed)
    item = rng.choices("abcd" if seed % 2 else "abcdefghijklmnop", k=40)
    doc = rng.choices("abcd" if seed % 2 else "xyz", k=30) + item[20:] + item[5:22] + rng.choices("abcd", k=10) + item[:12]
    hits = [(t, p) for t in range(len(doc) - 4) for p in range(len(item) - 4) if doc[t : t + 5] == item[p : p + 5]]
    assert d.tile(hits, 5) == brute_tiles(doc, item, 5)


def test_query_by_brute_force(spark, tmp_path):
    rng = random.Random(3)
    vocabulary = [f"Wort{i}é" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 40)))) for i in range(8)] + [(100, None), (101, "too short here"), (102, "")]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 2)):
            source = items[rng.randrange(8)][1].split()
            pieces = [source[k : k + rng.choice([3, 6, 9])] for k in range(0, len(source), 9)]
            rng.shuffle(pieces)
            parts += [w for piece in pieces for w in piece] if rng.random() < 0.6 else source
        parts = rng.choices(vocabulary, k=rng.randint(0, 30)) + parts
        text = (" " if i % 2 else ", “").join(parts)
        docs.append((i, text.upper() if i % 3 == 0 else text))
    docs += [(90, None), (91, ""), (92, items[0][1] * 3), (92, items[0][1]), (92, items[0][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, seed int").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = set()
    for i, text in docs:
        for j, item in items:
            if len(words_of(item)) >= 5:
                tiles = brute_tiles(words_of(text), words_of(item), 5)
                share = sum(t[2] for t in tiles) / len(words_of(item))
                if share >= d.COVERAGE:
                    want.add((i, j, round(share, 9), len(tiles), max(t[2] for t in tiles)))
    got = op1_decontamination(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.item_id, round(r.coverage, 9), r.n_tiles, r.longest) for r in got} == want
    assert len(got) == len(want) or len(got) == len(want) + 1  # the two texts of doc 92


def test_clean_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (None, "A b, c d e f g!", "y"), (2, None, "z"), (3, "a b c x d e f g", "w")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, "a b c d e f g")], "item_id long, text string")
    left = d.clean(docs, items)
    assert left.columns == docs.columns and sorted(r.item_id for r in left.collect()) == ["w", "z"]
    assert d.clean(docs, items.limit(0)).count() == 4 and d.leaks(docs.limit(0), items).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    items = [(1, "Paris"), (2, "forty-two apples!"), (3, "水は何度で沸騰しますか。"), (4, "中国的首都是哪里?"), (5, "เมืองหลวงของไทย"), (6, "…"), (7, "a b c d")]
    docs = [(1, "In paris, PARIS is home."), (2, "Forty two, apples"), (3, "forty apples two"), (4, "問い：水は何度で沸騰しますか、という。"), (5, "问题，中国的首都、是哪里")]
    docs += [(6, "x เมืองหลวงของไทย y"), (7, "水は沸騰"), (8, "parisian"), (9, None), (10, "a b c x d"), (11, "Ｐａｒｉｓ。parís"), (12, "日本paris語")]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string")
    got = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles) for r in d.leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert set(got) == {(1, 1), (2, 2), (4, 3), (5, 4), (6, 5), (12, 1)}
    assert got[1, 1] == got[2, 2] == got[4, 3] == (1.0, 1)
    # A second item, of one kind of words with a longer one, changes nothing for it.
    assert {(r.doc_id, r.item_id) for r in d.leaks(frame(docs, "doc_id"), frame(items[:2] + [(8, "问题 中国 的首 都是")], "item_id")).collect()} == {(1, 1), (12, 1), (2, 2), (5, 8)}

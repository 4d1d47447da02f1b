"""Benchmark decontamination by greedy string tiling.

Running Karp-Rabin hashes of all word 5-grams are joined with those of the test items; a document's shared 5-grams on
one diagonal are a match. The longest match that overlaps no tile becomes a tile, again and again, and an item counts
as leaked when tiles cover enough of its words, in whatever order they stand in the document.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm import words
from catchment.llm.buffers import flat, giving_back, mix
from catchment.llm.repeats import rolling

#: Words of the shortest tile, which is also the seed, and the share of an item's words that tiles must cover. An item of
#: fewer words is one tile.
TILE = 5
COVERAGE = 0.6
#: Bits of the filter that documents are read through. Its size is fixed; a larger benchmark lets more seeds pass to the join.
FILTER_BITS = 1 << 22

_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True
_WORD[128:] = True


#: Scripts written without spaces, whose characters are words each, and further blocks with punctuation and signs of theirs.
_UNSPACED = (
    (0x0E00, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0x3005, 0x3008), (0x3021, 0x3030), (0x3031, 0x303D), (0x3041, 0x3130), (0x31A0, 0x3200),
    (0x3400, 0xA4D0), (0xA9E0, 0xAA00), (0xAA60, 0xAAE0), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x16FE0, 0x18E00), (0x1AFF0, 0x1B300), (0x20000, 0x32400),
)
_SIGNS = ((0x3000, 0x3040), (0x30A0, 0x3100), (0xFE10, 0xFE20), (0xFE30, 0xFE70), (0xFF00, 0xFFF0))


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of each code point: 1 is a word by itself, 2 separates words, 0 is neither."""
    out = np.zeros(0x110000, np.uint8)
    for low, high in _UNSPACED:
        out[low:high] = 1
    for low, high in (*_UNSPACED, *_SIGNS):
        for point in range(low, min(high, 0x20000)):
            if unicodedata.category(chr(point))[0] in "PSZ":
                out[point] = 2
    return out


def _inside(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words: letters and digits, and beyond ASCII all but general punctuation, Latin-1 signs and the signs of
    unspaced scripts. And where a word is cut: before and after each character of an unspaced script."""
    inside = _WORD[data]
    if len(data) > 2:
        dash = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
        inside[dash] = inside[dash + 1] = inside[dash + 2] = False
    if len(data) > 1:
        sign = np.flatnonzero((data[:-1] == 0xC2) & (data[1:] >= 0xA0) & (data[1:] < 0xC0))
        inside[sign] = inside[sign + 1] = False
    cuts = []
    for size, first, last in ((3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
        at = np.flatnonzero((data >= first) & (data < last))
        at = at[at + size <= len(data)]
        point = data[at].astype(np.int64) & (last - first - 1)
        for i in range(1, size):
            point = (point << 6) | (data[at + i] & 63)
        kind = _kinds()[np.minimum(point, 0x10FFFF)]
        for i in range(size):
            inside[at[kind == 2] + i] = False
        cuts += [at[kind == 1], at[kind == 1] + size]
    cuts = np.unique(np.concatenate(cuts))
    return inside, cuts[cuts < len(data)]


def _grams(hashed: np.ndarray, inner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, word place and hash of every run of `size` words within a row."""
    grams = mix(rolling(hashed, size)) if len(hashed) >= size else np.empty(0, np.uint64)
    place = np.arange(len(grams))
    row = np.searchsorted(inner, place, side="right") - 1
    fits = place + size <= inner[row + 1]
    return row[fits], (place - inner[row])[fits], grams[fits]


def seeds(texts: pa.Array, sizes: Sequence[int] = (TILE,)) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Row, word place and hash of every word n-gram of texts in lower case, for each n, and the words of each row."""
    data, offsets = flat(texts)
    inside, cuts = _inside(data)
    starts, ends = words.bounds(inside, offsets, cuts)
    inner = np.searchsorted(starts, offsets)
    hashed = words.hashes(data, starts, ends)
    return [_grams(hashed, inner, n) for n in sizes], np.diff(inner)


def item_seeds(items: DataFrame, tile: int = TILE) -> DataFrame:
    """seed, item_id, at, n_words: the n-grams of each item, or all of an item with fewer words. Items without words have none."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = range(1, tile + 1)
            found, n = seeds(batch.column("text"), sizes)
            for size, (row, at, hashed) in zip(sizes, found):
                own = np.minimum(n[row], tile) == size
                row, at, hashed = row[own], at[own], hashed[own]
                columns = [pa.array(hashed.view(np.int64)), batch.column("item_id").take(pa.array(row)), pa.array(at.astype(np.int32)), pa.array(n[row].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "item_id", "at", "n_words"])

    lowered = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    return lowered.mapInArrow(run, "seed long, item_id long, at int, n_words int")


def _filter(found: DataFrame, bits: int) -> np.ndarray:
    """Which of the filter's places some seed has: at most bits / 64 rows of 64 places each reach the driver."""
    place = F.pmod("seed", F.lit(bits))
    rows = found.select(F.shiftright(place, 6).alias("row"), F.expr(f"shiftleft(1L, cast(pmod(seed, {bits}) & 63 as int))").alias("bit"))
    got = rows.groupBy("row").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[got.column("row").to_numpy()] = got.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def tile(hits: list[tuple[int, int]], least: int = TILE) -> list[tuple[int, int, int]]:
    """Greedy tiling from shared n-grams, as places in document and item: tiles (document place, item place, words).

    The longest match without marked words is marked first; of equally long ones the first in the item, then in the
    document. What is left of a match beside marked words goes on as a shorter one, down to the n-gram's length.
    """
    diagonals = defaultdict(list)
    for there, here in set(hits):
        diagonals[there - here].append(here)
    queue = []
    for gap, places in diagonals.items():
        places.sort()
        start = last = places[0]
        for here in [*places[1:], None]:
            if here is None or here != last + 1:
                queue.append((-(last - start + least), start, start + gap))
                start = here
            last = here
    heapq.heapify(queue)
    marked_here: set[int] = set()
    marked_there: set[int] = set()
    tiles = []
    while queue:
        size, here, there = heapq.heappop(queue)
        free = [i for i in range(-size) if here + i not in marked_here and there + i not in marked_there]
        if len(free) == -size:
            marked_here.update(range(here, here - size))
            marked_there.update(range(there, there - size))
            tiles.append((there, here, -size))
            continue
        start = 0
        for i in range(1, len(free) + 1):
            if i == len(free) or free[i] != free[i - 1] + 1:
                if i - start >= least:
                    heapq.heappush(queue, (-(i - start), here + free[start], there + free[start]))
                start = i
    return tiles


def leaks(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, least: int = TILE, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, text_hash, item_id, coverage, n_tiles, longest of every document that holds enough of an item.

    Words are letters and digits in lower case; in scripts without spaces each character is one. An item of fewer than
    `least` words is found where all of it stands. Null and empty texts hold nothing; a null doc_id is reported as such;
    different texts of one doc_id are judged apart and copies of a row once. Only doc_id and text, item_id and text are
    read. Empty tables give no rows.
    """
    wanted = item_seeds(items, least)
    passes = _filter(wanted, filter_bits)
    sizes = [*sorted(r["n_words"] for r in wanted.where(F.col("n_words") < least).select("n_words").distinct().collect()), least]

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, (row, at, hashed) in zip(sizes, seeds(batch.column("text"), sizes)[0]):
                found = np.flatnonzero(passes[(hashed % np.uint64(filter_bits)).astype(np.int64)])
                if size < least and len(found):  # such an item is all one tile, so one place is enough
                    found = found[np.unique(np.stack([row[found], hashed[found].view(np.int64)], 1), axis=0, return_index=True)[1]]
                rows = pa.array(row[found])
                columns = [pa.array(hashed[found].view(np.int64)), batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(at[found].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["seed", "doc_id", "text_hash", "place"])

    lowered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.lower("text").alias("text"))
    shared = lowered.mapInArrow(run, "seed long, doc_id long, text_hash long, place int").join(wanted, "seed")
    pairs = shared.groupBy("doc_id", "text_hash", "item_id").agg(F.max("n_words").alias("n_words"), F.collect_set(F.struct("place", "at")).alias("hits"))

    @giving_back
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, rows = [], []
            for i, (hits, n) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("n_words").to_pylist())):
                tiles = tile([(h["place"], h["at"]) for h in hits], min(least, n))
                share = sum(t[2] for t in tiles) / n
                if share >= coverage:
                    keep.append(i)
                    rows.append((share, len(tiles), max(t[2] for t in tiles)))
            at = pa.array(keep, pa.int64())
            kinds = (pa.float64(), pa.int32(), pa.int32())
            columns = [batch.column(c).take(at) for c in ("doc_id", "text_hash", "item_id")]
            columns += [pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "item_id", "coverage", "n_tiles", "longest"])

    return pairs.mapInArrow(judge, "doc_id long, text_hash long, item_id long, coverage double, n_tiles int, longest int")


def clean(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents, all columns as they are, that hold no item."""
    found = leaks(docs, items, coverage).select(F.col("doc_id").alias("_leaked"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_leaked")) & (F.xxhash64("text") == F.col("_hash"))
    return docs.join(found, same, "left_anti")

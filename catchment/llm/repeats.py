"""Windows of a fixed number of units (bytes or words) that stand at more than one place of a corpus.

Every window picks one anchor inside itself by its own content, so equal windows pick the same one wherever they stand.
Neighbouring windows with one anchor form a segment. Segments, a fraction of the windows, are what is shuffled:

1. `first_look`: segments of each block of texts, with a key (content around the anchor) and a name (all content).
   Repeats inside the block are settled at once, so a hot passage sends at most one row for each block and not one for
   each copy; a key that stands in several different segments of the block is settled likewise.
2. `second_look`: a whole segment that stands earlier is repeated. A key of one segment only is unique. What is left,
   segments that share their key and differ further out, is asked for.
3. Both looks again at what is asked for, with a second kind of anchor whose key is longer, if there is one.
4. `windows_of`, `last_look`: what is still asked for window by window, by two independent 64-bit hashes; all but the
   earliest are repeated.

No step lists pairs of places. All joins with the texts have one form, so that Spark shuffles the texts once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.buffers import flat, giving_back, mix
from catchment.llm.groups import whole_groups

#: Units looked at at once, and bytes of text whose segments are settled together. They bound memory, not results.
CHUNK = 1 << 20
BLOCK_BYTES = 24_000_000

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PLACE = np.uint64((1 << 24) - 1)
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)

NORMAL, REPEATED, ASKED, SHARED = 0, 1, 2, 3
ROW = "key long, name long, doc long, start int, n int, kind int"


@dataclass(frozen=True)
class Windows:
    """What a window is and how it picks its anchor.

    units: bytes and row offsets of texts to values and row offsets of units. rank: values and row offsets to a rank
    for each unit, the least of which is the anchor; the greatest number marks units that cannot be one. The anchor of
    a window of `length` units from i lies from i + low to i + high; the key is the content from anchor - before, of
    `size` units, and lies in the window; with size 0 it is the anchor's rank, which then hashes content. within: earlier places in the same text count, and not only other texts.
    """

    length: int
    low: int
    high: int
    before: int
    size: int
    within: bool
    units: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    rank: Callable[[np.ndarray, np.ndarray], np.ndarray]


def rolling(values: np.ndarray, n: int, base: np.uint64 = _BASES[0]) -> np.ndarray:
    """Polynomial hash of every n values in a row, by doubling."""
    if len(values) < n:
        return values[:0]
    power, have, part, out, done = base, 1, values, None, 0
    with np.errstate(over="ignore"):
        while True:
            if n & have:
                if out is None:
                    out, done = part, have
                else:
                    size = min(len(part), len(out) - have) if have <= len(out) else 0
                    # The longer part goes first, the shorter ones found before it follow.
                    out = part[:size] * _power(base, done) + out[have : have + size]
                    done += have
            if have * 2 > n:
                return out[: len(values) - n + 1]
            part = part[:-have] * power + part[have:]
            power, have = power * power, have * 2


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """Least of every n values in a row, by doubling."""
    have = 1
    while have * 2 <= n:
        values, have = np.minimum(values[:-have], values[have:]), have * 2
    return np.minimum(values[: -(n - have)], values[n - have :]) if n > have else values


def segments(values: np.ndarray, offsets: np.ndarray, w: Windows) -> tuple[np.ndarray, ...]:
    """row, start, n, key, name of all segments of some rows of units; start counts windows within the row."""
    total = len(values) - w.length + 1
    row_starts, row_windows = offsets[:-1], np.diff(offsets) - w.length + 1
    if total <= 0 or not (row_windows > 0).any():
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    place = np.arange(len(values), dtype=np.uint64)
    raw = w.rank(values, offsets)
    ranks = (raw & ~_PLACE) | (_PLACE - place)  # of equal ranks the rightmost place
    least = sliding_least(ranks[w.low :], w.high - w.low + 1)[:total]
    anchor = (_PLACE - (least & _PLACE)).astype(np.int64)
    starts = np.concatenate([np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, row_starts[row_windows > 0]])
    starts = np.unique(starts)
    row = np.searchsorted(offsets, starts, side="right") - 1
    fits = starts < row_starts[row] + row_windows[row]
    starts, row = starts[fits], row[fits]
    ends = np.append(starts[1:], total)
    ends = np.minimum(ends, row_starts[row] + row_windows[row])
    whole = rolling(values, w.length)
    key = mix(rolling(values, w.size)[anchor[starts] - w.before]) if w.size else raw[anchor[starts]]
    name = mix(whole[starts] + mix(whole[ends - 1] ^ (ends - starts).astype(np.uint64)) * _BASES[1])
    return row, starts - row_starts[row], ends - starts, key, name


def chunks(data: np.ndarray, offsets: np.ndarray, w: Windows) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, first window, values and offsets of pieces of bounded size that together hold all windows."""
    rows = len(offsets) - 1
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1)
        values, inner = w.units(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        if len(values) <= 2 * CHUNK:
            yield first, 0, values, inner
        else:
            for at in range(0, len(values) - w.length + 1, CHUNK):
                piece = values[at : at + CHUNK + w.length - 1]
                yield first, at, piece, np.array([0, len(piece)])
        first = last


def _ranges(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring ranges of windows of one document as one."""
    if not len(doc):
        return doc, start, n
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + n)[order]
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != end[:-1])])
    heads = np.flatnonzero(head)
    return doc[heads], start[heads], end[np.append(heads[1:], len(doc)) - 1] - start[heads]


def _table(kind: int, key: np.ndarray, name: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [key.astype(np.uint64, copy=False).view(np.int64), name.astype(np.uint64, copy=False).view(np.int64), doc.astype(np.int64, copy=False)]
    columns += [start.astype(np.int32), n.astype(np.int32), np.full(len(doc), kind, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "name", "doc", "start", "n", "kind"])


def _settled(kind: int, doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Ranges that only pass through the next look, dealt out by document."""
    doc, start, n = _ranges(doc, start, n)
    return _table(kind, mix(doc.view(np.uint64)), np.zeros(len(doc), np.uint64), doc, start, n)


def _later(same: np.ndarray, doc: np.ndarray, start: np.ndarray, within: bool) -> np.ndarray:
    """Of rows sorted by content, doc and start, those with an earlier row of the same content; same: as the row before."""
    place = np.arange(len(doc))
    head = np.maximum.accumulate(np.where(same, 0, place))
    later = doc > doc[head]
    return later | ((doc == doc[head]) & (start > start[head])) if within else later


def _in_block(key: np.ndarray, name: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray, w: Windows) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((start, doc, name, key))
    key, name, doc, start, n = key[order], name[order], doc[order], start[order], n[order]
    same_key = np.concatenate([[False], key[1:] == key[:-1]])
    later = _later(same_key & np.concatenate([[False], name[1:] == name[:-1]]), doc, start, w.within)
    yield _settled(REPEATED, doc[later], start[later], n[later])
    key, name, doc, start, n = (x[~later] for x in (key, name, doc, start, n))
    differs = np.zeros(len(key), bool)
    differs[1:] = (key[1:] == key[:-1]) & (name[1:] != name[:-1])
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1 if len(key) else np.empty(0, np.int64)
    shared = (np.bincount(group[differs], minlength=group[-1] + 1) > 0)[group] if len(key) else differs
    yield _settled(ASKED, doc[shared], start[shared], n[shared])
    first = shared & np.concatenate([[True], key[1:] != key[:-1]])[: len(key)]
    yield _table(SHARED, key[first], name[first], doc[first], start[first], n[first])
    yield _table(NORMAL, *(x[~shared] for x in (key, name, doc, start, n)))


def first_look(docs: DataFrame, w: Windows) -> DataFrame:
    """Rows of ROW from the columns doc (long; nulls are passed over) and text; with a column ranges, of the asked
    windows only, beside those known to be repeated."""
    restricted = "ranges" in docs.columns

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if restricted:
                yield _known(batch)
            for doc, base, values, inner in _asked(batch, w) if restricted else _all(batch, w):
                row, start, n, key, name = segments(values, inner, w)
                held.append((key, name, doc[row], start + base[row], n))
                size += len(values) if w.within else 6 * len(values)
                if size >= BLOCK_BYTES:
                    yield from _in_block(*map(np.concatenate, zip(*held)), w)
                    held, size = [], 0
        if held:
            yield from _in_block(*map(np.concatenate, zip(*held)), w)

    return docs.mapInArrow(run, ROW)


def _all(batch: pa.RecordBatch, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Document and first window of each row, values and offsets, of pieces that together hold all windows."""
    named = batch.filter(batch.column("doc").is_valid())
    ids = named.column("doc").to_numpy()
    for first, at, values, inner in chunks(*flat(named.column("text")), w):
        rows = len(inner) - 1
        yield ids[first : first + rows], np.full(rows, at), values, inner


def _asked(batch: pa.RecordBatch, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """As _all, with a row for each asked range of windows and no others."""
    some = batch.filter(batch.column("ranges").is_valid())
    ids = some.column("doc").to_numpy()
    row, start, n, kind = _lists(some.column("ranges"))
    asked = np.flatnonzero(kind == ASKED)
    asked = asked[np.lexsort((start[asked], row[asked]))]
    row, start, n = row[asked], start[asked], n[asked]
    for first, at, values, inner in chunks(*flat(some.column("text")), w):
        low, high = np.searchsorted(row, [first, first + len(inner) - 1])
        r, last = row[low:high] - first, np.diff(inner) - w.length + 1
        s = np.maximum(start[low:high] - at, 0)
        size = np.minimum(start[low:high] + n[low:high] - at, last[r]) - s
        r, s, size = (x[size > 0] for x in (r, s, size))
        ends = np.cumsum(size + w.length - 1)
        done = 0
        while done < len(r):
            until = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + 2 * CHUNK, side="right")))
            part = slice(done, until)
            units = size[part] + w.length - 1
            yield ids[first + r[part]], s[part] + at, values[_spread(inner[r[part]] + s[part], units)], np.concatenate([[0], np.cumsum(units)])
            done = until


def _known(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The ranges that are known to be repeated."""
    row, start, n, kind = _lists(batch.column("ranges"))
    known = kind == REPEATED
    doc = batch.column("doc").take(pa.array(row[known])).to_numpy(zero_copy_only=False)
    return _settled(REPEATED, doc.astype(np.int64), start[known], n[known])


def second_look(rows: DataFrame, w: Windows) -> DataFrame:
    """doc, start, n, kind: ranges of windows that are REPEATED or ASKED for one by one."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            key, name, doc, start, n, kind = (c.to_numpy() for c in table.columns)
            passes = (kind == REPEATED) | (kind == ASKED)
            new_key = np.concatenate([[True], key[1:] != key[:-1]])
            group = np.cumsum(new_key) - 1
            plain = np.flatnonzero(kind == NORMAL)
            g, m = group[plain], name[plain]
            same_key = np.concatenate([[False], g[1:] == g[:-1]])[: len(g)]
            same = same_key & np.concatenate([[False], m[1:] == m[:-1]])[: len(m)]
            shared = np.zeros(group[-1] + 1, bool)
            shared[group[kind == SHARED]] = True
            shared[g[same_key & ~same]] = True
            later = _later(same, doc[plain], start[plain], w.within) if len(plain) else same
            asked = shared[g] & ~later
            rows_of = [np.flatnonzero(passes), plain[later], plain[asked]]
            kinds = np.concatenate([kind[passes], np.full(later.sum(), REPEATED, np.int32), np.full(asked.sum(), ASKED, np.int32)])
            at = np.concatenate(rows_of)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[at], start[at], n[at], kinds)], names=["doc", "start", "n", "kind"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "name", "doc", "start")
    return dealt.mapInArrow(run, "doc long, start int, n int, kind int")


def by_document(ranges: DataFrame) -> DataFrame:
    """doc and all its ranges; a document's ranges are no more than its windows."""
    return ranges.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "kind")).alias("ranges"))


def _lists(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, ...]:
    """Rows, start, n and kind of all ranges of a column of range lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flatten = column.flatten()
    counts = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    row = np.repeat(np.arange(len(column)), counts)
    return (row, *(flatten.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)))


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All members of ranges, one range after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n) + np.repeat(start, n)


def windows_of(docs: DataFrame, w: Windows) -> DataFrame:
    """Rows of ROW, from doc, text and ranges: the asked windows by two hashes, and what is repeated already."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            yield _known(batch)
            for doc, base, values, inner in _asked(batch, w):
                n = np.diff(inner) - w.length + 1
                row = np.repeat(np.arange(len(n)), n)
                inside = _spread(np.zeros(len(n), np.int64), n)
                one, two = (mix(rolling(values, w.length, b)[inner[row] + inside]) for b in _BASES)
                held.append((one, two, doc[row], base[row] + inside))
                size += len(row)
                if size >= CHUNK:
                    yield from _windows(*map(np.concatenate, zip(*held)), w)
                    held, size = [], 0
        if held:
            yield from _windows(*map(np.concatenate, zip(*held)), w)

    return docs.mapInArrow(run, ROW)


def _windows(one: np.ndarray, two: np.ndarray, doc: np.ndarray, start: np.ndarray, w: Windows) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((start, doc, two, one))
    one, two, doc, start = one[order], two[order], doc[order], start[order]
    same = np.concatenate([[False], (one[1:] == one[:-1]) & (two[1:] == two[:-1])])[: len(one)]
    later = _later(same, doc, start, w.within)
    yield _settled(REPEATED, doc[later], start[later], np.ones(later.sum(), np.int64))
    yield _table(NORMAL, one[~later], two[~later], doc[~later], start[~later], np.ones((~later).sum(), np.int64))


def last_look(rows: DataFrame, w: Windows) -> DataFrame:
    """doc, start, n, kind of all ranges of repeated windows."""

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "key"):
            key, name, doc, start, n, kind = (c.to_numpy() for c in table.columns)
            passes = np.flatnonzero(kind == REPEATED)
            plain = np.flatnonzero(kind == NORMAL)
            k, m = key[plain], name[plain]
            same = np.concatenate([[False], (k[1:] == k[:-1]) & (m[1:] == m[:-1])])[: len(k)]
            later = plain[_later(same, doc[plain], start[plain], w.within)] if len(plain) else plain
            at = np.concatenate([passes, later])
            found = _ranges(doc[at], start[at], n[at])
            columns = [found[0], found[1].astype(np.int32), found[2].astype(np.int32), np.full(len(found[0]), REPEATED, np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "start", "n", "kind"])

    dealt = rows.repartition("key").sortWithinPartitions("key", "name", "doc", "start")
    return dealt.mapInArrow(run, "doc long, start int, n int, kind int")


def with_ranges(docs: DataFrame, ranges: DataFrame, all_texts: bool = False) -> DataFrame:
    """doc, text and ranges of all rows; texts without ranges are left out as null unless they are wanted."""
    joined = docs.select("doc", "text").join(ranges, "doc", "left")
    return joined if all_texts else joined.select("doc", F.when(F.col("ranges").isNotNull(), F.col("text")).alias("text"), "ranges")


def repeated_ranges(docs: DataFrame, *kinds: Windows) -> DataFrame:
    """doc and ranges of all windows that stand earlier too, from the columns doc and text. The kinds of windows have
    the same length and differ in their anchors: those with shorter keys first."""
    ranges = by_document(second_look(first_look(docs.select("doc", "text"), kinds[0]), kinds[0]))
    for w in kinds[1:]:
        ranges = by_document(second_look(first_look(with_ranges(docs, ranges), w), w))
    return by_document(last_look(windows_of(with_ranges(docs, ranges), kinds[-1]), kinds[-1]))


def covered(row: np.ndarray, start: np.ndarray, n: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Which units lie in a repeated window; offsets: of the units of each row."""
    total = int(offsets[-1])
    size = np.diff(offsets)[row]
    fits = start + length <= size
    row, start, n, size = row[fits], start[fits], n[fits], size[fits]
    low = offsets[row] + start
    high = np.minimum(low + n + length - 1, offsets[row] + size)
    steps = np.bincount(low, minlength=total + 1)[: total + 1] - np.bincount(high, minlength=total + 1)[: total + 1]
    return np.cumsum(steps[:total]) > 0

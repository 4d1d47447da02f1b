"""Removal of repeated word passages by recompression.

Rounds of naming turn a text's words into ever longer symbols: short runs of one word become a symbol, then pairs whose
left and right symbol fall in the two halves of the alphabet. A name is a hash of what it stands for, so all tasks name
alike without asking each other, and a symbol depends on nothing but the few words around it: equal passages have equal
symbols inside. Within a window the least of its interior symbols is the one that reveals repeats; the words around it
are the key that Spark groups by, and the whole windows verify it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm import words
from catchment.llm.buffers import flat, giving_back, mix
from catchment.llm.repeats import LAST, Windows, _lists, covered, repeated_ranges, with_ranges

#: Words of a passage that counts as repeated.
LENGTH = 50
#: Most words of a symbol that names a run, and of a symbol after each round of pairs.
RUN_WORDS = 3
PAIR_WORDS = (4, 8)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0xD6E8FEB86659FD93)


def context_words() -> int:
    """Words on either side that decide where the final symbols begin: of each round, its longest input and its own."""
    context, longest = RUN_WORDS, RUN_WORDS
    for most in PAIR_WORDS:
        context, longest = context + longest, most
    return context


def windows(length: int = LENGTH) -> Windows:
    """The window must hold a whole symbol with its context on both sides, and each place within it has one."""
    around, longest = context_words(), PAIR_WORDS[-1]
    high = length - around - longest
    if high - around + 1 < longest:
        raise ValueError(f"windows of {length} words are too short for symbols of {longest}")
    return Windows(length, around, high, around, 2 * around + longest, False, word_values, symbol_ranks)


def word_values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all rows, and the offsets of rows in words."""
    starts, ends = words.bounds(~_SPACE[data], offsets)
    return words.hashes(data, starts, ends), np.searchsorted(starts, offsets)


def name_runs(names: np.ndarray, fresh: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Which symbols stay, and how many each stands for: runs of 2 to `most` equal ones become one."""
    head = np.concatenate([[True], (names[1:] != names[:-1]) | fresh[1:]])[: len(names)]
    heads = np.flatnonzero(head)
    sizes = np.diff(np.append(heads, len(names)))
    named = np.repeat(sizes <= most, sizes)
    stays = head | ~named
    counts = np.ones(len(names), np.int64)
    counts[heads] = np.where(sizes <= most, sizes, 1)
    return stays, counts


def symbol_ranks(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A rank for each word at which a final symbol begins, by the symbol's name; LAST elsewhere."""
    out = np.full(len(values), LAST)
    if not len(values):
        return out
    fresh = np.zeros(len(values), bool)
    fresh[offsets[:-1][offsets[:-1] < len(values)]] = True
    stays, sizes = name_runs(values, fresh, RUN_WORDS)
    starts, sizes, fresh = np.flatnonzero(stays), sizes[stays], fresh[stays]
    names = mix(values[starts] + sizes.astype(np.uint64) * _ODD)
    for turn, most in enumerate(PAIR_WORDS):
        left = (mix(names + np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
        pairs = np.flatnonzero(left[:-1] & ~left[1:] & ~fresh[1:] & (sizes[:-1] + sizes[1:] <= most))
        names[pairs] = mix(names[pairs] * _ODD + names[pairs + 1])
        sizes[pairs] += sizes[pairs + 1]
        stays = np.ones(len(names), bool)
        stays[pairs + 1] = False
        names, sizes, starts, fresh = names[stays], sizes[stays], starts[stays], fresh[stays]
    out[starts] = mix(names ^ _ODD)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, kept (text), n_words, n_removed of each row, without the words of repeated passages.

    A word goes when `length` consecutive words over it also start in a document with a smaller doc_id. Words are what
    stands between ASCII white space, unchanged; what is kept is joined by single spaces. Windows are judged as they
    come in. A null text has no words; rows without doc_id stay whole and count as no source; rows that share a doc_id
    are one document. Only doc_id and text are read; an empty table gives no rows.
    """
    w = windows(length)
    named = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    ranges = repeated_ranges(named, w)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            raw, cuts = data.tobytes(), offsets.tolist()
            split = [raw[a:b].split() for a, b in zip(cuts, cuts[1:])]
            word_offsets = np.concatenate([[0], np.cumsum([len(s) for s in split], dtype=np.int64)])
            row, start, n, _ = _lists(batch.column("ranges"))
            gone = covered(row, start, n, word_offsets, length)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[word_offsets])
            for i in np.flatnonzero(removed):
                out = gone[word_offsets[i] : word_offsets[i + 1]].tolist()
                split[i] = [word for word, is_gone in zip(split[i], out) if not is_gone]
            kept = pa.array([b" ".join(s).decode() for s in split], pa.string())
            columns = [batch.column("doc"), kept, pa.array(np.diff(word_offsets)), pa.array(removed)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_words", "n_removed"])

    return with_ranges(named, ranges, all_texts=True).mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long")

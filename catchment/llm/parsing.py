"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash slides over the bytes of every text; where it is least within its neighbourhood it triggers the end of a
phrase, so a string that is long enough is cut at the same triggers wherever it stands. The dictionary of phrases with
their context is what Spark groups and orders by content and place, and phrase by phrase the parse settles whether what
starts in it starts earlier too. Only suffixes of phrases whose trigger is shared by different contexts are ordered one
by one, by fingerprints of their first bytes: as many as the threshold has, and the order beyond them decides nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.buffers import flat, giving_back
from catchment.llm.repeats import LAST, Windows, _lists, covered, repeated_ranges, rolling, with_ranges
from catchment.llm.words import BYTES

#: Bytes of a string that counts as repeated, and bytes of the rolling hash: for all text, and for what that leaves open.
LENGTH = 100
TRIGGERS = (24, 64, 88)


def _units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.take(BYTES, data), offsets


def _triggers(values: np.ndarray, offsets: np.ndarray, trigger: int) -> np.ndarray:
    out = np.full(len(values), LAST)
    rolled = rolling(values, trigger)
    np.multiply(rolled ^ (rolled >> np.uint64(29)), np.uint64(0xFF51AFD7ED558CCD), out=out[: len(rolled)])
    return out


def windows(length: int = LENGTH, trigger: int = TRIGGERS[0]) -> Windows:
    trigger = min(trigger, length)
    return Windows(length, 0, length - trigger, 0, 0, True, _units, partial(_triggers, trigger=trigger))


def remove_repeats(docs: DataFrame, length: int = LENGTH, triggers: tuple[int, ...] = TRIGGERS) -> DataFrame:
    """doc_id, kept (binary), n_bytes, n_removed, n_spans of each row, without the bytes of repeated strings.

    A byte goes when a string of `length` bytes over it also starts earlier: in a smaller doc_id, or in the same
    document further left. Strings lie in one text and are judged as they come in. A null text is empty; rows without
    doc_id stay whole and count as no source; rows that share a doc_id are one document, told apart by start only. Only
    doc_id and text are read; an empty table gives no rows.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    ranges = repeated_ranges(named, *(windows(length, t) for t in triggers))

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            row, start, n, _ = _lists(batch.column("ranges"))
            gone = covered(row, start, n, offsets, length)
            heads = gone.copy()
            heads[1:] &= ~gone[:-1]
            firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
            heads[firsts] = gone[firsts]
            removed, spans = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, heads))
            kept = data[~gone].tobytes()
            cuts = (offsets - removed).tolist()
            columns = [
                batch.column("doc"),
                pa.array([kept[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                *(pa.array(np.diff(x)) for x in (offsets, removed, spans)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return with_ranges(named, ranges, all_texts=True).mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")

"""Reading sorted Arrow batches in whole groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold only whole groups of a key, from batches that are sorted by it. Nulls in the key are not allowed."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(key)[-1].as_py() == keys[0]:
            if last == 0:
                held.append(batch)
                continue
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
        elif held:
            yield pa.Table.from_batches([*held, batch.slice(0, last)] if last else held)
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)

"""Unions of many frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def append_chunks(*chunks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, chunks)


def strict_union(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of frames with the same columns in the same order and of the same types, else an error."""
    if not frames:
        raise ValueError("no files to merge")
    (_, first), *rest = frames.items()
    for name, frame in rest:
        if frame.columns != first.columns:
            raise ValueError(f"{name} has different columns")
        if [f.dataType for f in frame.schema] != [f.dataType for f in first.schema]:
            raise ValueError(f"{name} has different types")
    return reduce(DataFrame.union, frames.values())


def lenient_union(frames: list[DataFrame | None]) -> DataFrame | None:
    """Union by name of the frames that could be read; None when there is none."""
    there = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), there) if there else None

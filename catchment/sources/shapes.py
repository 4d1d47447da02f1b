"""Polygon layers in the binary shape format: geometry records (``.shp``) beside their attribute tables (``.dbf``).

Every file is one ``binaryFile`` row, so each is decoded by one task and no file passes through the driver; a folder of
per-state layers spreads over as many tasks as it has files. Geometry and attributes are joined by file stem and record
number in Spark.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GEOMETRY = "path string, stem string, record long, shape_type int, rings array<array<array<double>>>"
ATTRIBUTES = "stem string, record long, properties string"

# Fixed values of the format: the main file header is 100 bytes and starts with the file code 9994; a record header is
# two big-endian ints (record number, content length in 16-bit words); shape types 0 (null), 5 (polygon),
# 15 (polygon with z), 25 (polygon with measures) share the polygon layout up to the points.
HEADER_BYTES = 100
FILE_CODE = 9994
NULL_SHAPE = 0
POLYGON_TYPES = (5, 15, 25)


def _stem(path: pd.Series) -> pd.Series:
    return path.str.replace(r"\.[^./]*$", "", regex=True)


def polygon_records(content: bytes) -> Iterator[tuple[int, int, list | None]]:
    """(record number, shape type, rings) of each record; rings are lists of [x, y] points, None for a null shape.

    Only the x and y of z or measured polygons are read. Other shape types raise, as does a file that is not a
    shape file or ends within a record.
    """
    if len(content) < HEADER_BYTES or struct.unpack_from(">i", content, 0)[0] != FILE_CODE:
        raise ValueError("not a shape file")
    at = HEADER_BYTES
    while at < len(content):
        if at + 12 > len(content):
            raise ValueError("shape file ends within a record header")
        number, words = struct.unpack_from(">2i", content, at)
        body, end = at + 8, at + 8 + 2 * words
        if end > len(content):
            raise ValueError(f"shape file ends within record {number}")
        kind = struct.unpack_from("<i", content, body)[0]
        if kind == NULL_SHAPE:
            yield number, kind, None
        elif kind in POLYGON_TYPES:
            parts, points = struct.unpack_from("<2i", content, body + 36)
            starts = np.frombuffer(content, "<i4", parts, body + 44).tolist() + [points]
            xy = np.frombuffer(content, "<f8", 2 * points, body + 44 + 4 * parts).reshape(points, 2)
            yield number, kind, [xy[a:b].tolist() for a, b in zip(starts[:-1], starts[1:]) if b > a]
        else:
            raise ValueError(f"record {number} has shape type {kind}, not a polygon")
        at = end


def attribute_records(content: bytes) -> Iterator[tuple[int, dict]]:
    """(record number from 1, fields) of each live record of an attribute table; deleted records are skipped.

    Character fields are trimmed text, numeric ones numbers (None when blank), logical ones booleans, others text.
    """
    count, header, width = struct.unpack_from("<IHH", content, 4)
    fields, at = [], 32
    while at < header - 1 and content[at] != 0x0D:
        name = content[at : at + 11].split(b"\0", 1)[0].decode("ascii", "replace")
        fields.append((name, chr(content[at + 11]), content[at + 16], content[at + 17]))
        at += 32
    for number in range(count):
        start = header + number * width
        row = content[start : start + width]
        if len(row) < width or row[:1] == b"*":
            continue
        values, offset = {}, 1
        for name, kind, size, decimals in fields:
            text = row[offset : offset + size].decode("latin-1").strip()
            offset += size
            if kind in "NF":
                values[name] = None if not text or set(text) <= {"*"} else (float(text) if decimals or "." in text or "e" in text.lower() else int(text))
            elif kind == "L":
                values[name] = None if text in ("", "?") else text in "TtYy"
            else:
                values[name] = text
        yield number + 1, values


def _decode_geometry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = list(polygon_records(bytes(content)))
            yield pd.DataFrame(
                {
                    "path": path,
                    "stem": _stem(pd.Series([path]))[0],
                    "record": [r[0] for r in rows],
                    "shape_type": [r[1] for r in rows],
                    "rings": [r[2] for r in rows],
                }
            )


def _decode_attributes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            rows = list(attribute_records(bytes(content)))
            yield pd.DataFrame(
                {
                    "stem": _stem(pd.Series([path]))[0],
                    "record": [r[0] for r in rows],
                    "properties": [json.dumps(r[1]) for r in rows],
                }
            )


def _files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").option("recursiveFileLookup", "true")
    return reader.load(path).select("path", "content")


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of every polygon layer under ``path``: the ``.shp`` path, its record number, shape type,
    the attributes of the same record in the ``.dbf`` beside it (a JSON object; null without one) and the rings.

    A null shape keeps its row with null rings; parts become rings in file order (outer rings and holes alike, as the
    format gives them by orientation only). An empty folder gives no rows.
    """
    shapes = _files(spark, path, "shp").mapInPandas(_decode_geometry, GEOMETRY)
    tables = _files(spark, path, "dbf").mapInPandas(_decode_attributes, ATTRIBUTES)
    joined = shapes.join(tables, ["stem", "record"], "left")
    return joined.select("path", "record", "shape_type", F.col("properties"), "rings")

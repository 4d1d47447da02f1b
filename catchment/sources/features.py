"""A table function callable from SQL that turns GeoJSON files into polygon rows.

    SELECT * FROM read_features(TABLE(SELECT path, content FROM binaryFile.`folder`) PARTITION BY path)

Spark lists and reads the files (``binaryFile``, any store it can open) and deals them out one file per partition
key; the function only parses the bytes of a file it is handed. A file is a FeatureCollection or one feature per
line. A feature without a Polygon or MultiPolygon with coordinates gives no row; properties stay as JSON text, to be
taken apart with ``get_json_object`` or ``from_json``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from catchment.functions.polygon import RINGS_TYPE

OUT = f"path string, feature int, properties string, kind string, rings {RINGS_TYPE}"


#: Features a file should hold at most when it is written for this reader, which is handed whole files, some at once.
FEATURES_PER_FILE = 1_000

#: The lines of a text as str.splitlines cuts them, empty ones left out.
LINE = re.compile("[^\n\r\v\f\x1c\x1d\x1e\x85\u2028\u2029]+")


def _parsed(text: str):
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        return None


def features_of(text: str) -> Iterator[dict]:
    """The features of a FeatureCollection, or of newline-delimited features, these parsed one at a time."""
    found = (line.group() for line in LINE.finditer(text))
    lines = (line for line in found if line.strip())
    first, second = next(lines, None), next(lines, None)
    if first is None:
        return
    # A whole object with more after it is no single value, so such a text is never parsed as one.
    if second is None or not isinstance(_parsed(first), dict):
        whole = _parsed(text.strip())
        if isinstance(whole, dict):
            yield from whole.get("features", []) if whole.get("type") == "FeatureCollection" else [whole]
            return
    yield json.loads(first)
    if second is not None:
        yield json.loads(second)
    for line in lines:
        yield json.loads(line)


def rings_of(geometry: dict | None) -> tuple[str | None, list]:
    kind = (geometry or {}).get("type")
    coordinates = (geometry or {}).get("coordinates") or []
    polygons = [coordinates] if kind == "Polygon" else coordinates if kind == "MultiPolygon" else []
    rings = [[(float(p[0]), float(p[1])) for p in ring] for polygon in polygons for ring in polygon if ring]
    return kind, rings


@udtf(returnType=OUT)
class ReadFeatures:
    """One row per polygon feature of each file row (path, content) it is given."""

    def eval(self, row) -> Iterator[tuple]:
        text = bytes(row["content"] or b"").decode("utf-8")
        for at, feature in enumerate(features_of(text)):
            kind, rings = rings_of(feature.get("geometry"))
            if rings:
                yield row["path"], at, json.dumps(feature.get("properties") or {}, sort_keys=True), kind, rings


def register(spark: SparkSession, name: str = "read_features") -> None:
    """Make the function callable by name from SQL in this session."""
    spark.udtf.register(name, ReadFeatures)

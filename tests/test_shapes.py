"""Polygon layers in the binary shape format, written here by a small helper and read back by Spark."""

from __future__ import annotations

import json
import struct

import pytest

from catchment.sources import shapes


def shape_file(records: list[list | None]) -> bytes:
    """A polygon shape file: each record is a list of rings ([x, y] points) or None for a null shape."""
    body = b""
    for number, rings in enumerate(records, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = [p for ring in rings for p in ring]
            xs, ys = [p[0] for p in points], [p[1] for p in points]
            starts, at = [], 0
            for ring in rings:
                starts.append(at)
                at += len(ring)
            content = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
            content += struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", number, len(content) // 2) + content
    header = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + len(body)) // 2) + struct.pack("<2i", 1000, 5) + struct.pack("<8d", *[0.0] * 8)
    return header + body


def table_file(fields: list[tuple[str, str, int, int]], rows: list[tuple], deleted: set[int] = frozenset()) -> bytes:
    """An attribute table with the given (name, type, width, decimals) fields; rows as text already padded or not."""
    width = 1 + sum(f[2] for f in fields)
    header_length = 32 + 32 * len(fields) + 1
    out = struct.pack("<B3BIHH20x", 3, 124, 1, 1, len(rows), header_length, width)
    for name, kind, size, decimals in fields:
        out += name.encode().ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([size, decimals]) + b"\0" * 14
    out += b"\r"
    for number, row in enumerate(rows):
        out += b"*" if number in deleted else b" "
        for (name, kind, size, _), value in zip(fields, row):
            text = str(value).encode("latin-1")
            out += text.rjust(size) if kind in "NF" else text.ljust(size)
    return out + b"\x1a"


SQUARE = [[0.0, 0.0], [0.0, 4.0], [4.0, 4.0], [4.0, 0.0], [0.0, 0.0]]
HOLE = [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]
FAR = [[10.0, 10.0], [10.0, 11.5], [11.25, 11.5], [10.0, 10.0]]


def test_layers_round_trip_with_holes_parts_null_shapes_and_attributes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "tracts.shp").write_bytes(shape_file([[SQUARE, HOLE], None, [SQUARE, FAR]]))
    fields = [("GEOID", "C", 11, 0), ("ALAND", "N", 12, 0), ("SHARE", "N", 8, 3), ("WET", "L", 1, 0)]
    rows = [("01001020100", 5000, "0.250", "T"), ("01001020200", "", "", "?"), ("01001020300", 12, "1.500", "F")]
    (tmp_path / "a" / "tracts.dbf").write_bytes(table_file(fields, rows))
    (tmp_path / "b" / "deep").mkdir(parents=True)
    (tmp_path / "b" / "deep" / "bare.shp").write_bytes(shape_file([[FAR]]))
    (tmp_path / "b" / "notes.txt").write_text("not a layer")
    got = {(r["path"].rsplit("/", 1)[-1], r["record"]): r for r in shapes.read_shapes(spark, str(tmp_path)).collect()}
    assert sorted(got) == [("bare.shp", 1), ("tracts.shp", 1), ("tracts.shp", 2), ("tracts.shp", 3)]
    assert got[("tracts.shp", 1)]["rings"] == [SQUARE, HOLE] and got[("tracts.shp", 3)]["rings"] == [SQUARE, FAR]
    assert got[("tracts.shp", 2)]["rings"] is None and got[("tracts.shp", 2)]["shape_type"] == 0
    assert json.loads(got[("tracts.shp", 1)]["properties"]) == {"GEOID": "01001020100", "ALAND": 5000, "SHARE": 0.25, "WET": True}
    assert json.loads(got[("tracts.shp", 2)]["properties"]) == {"GEOID": "01001020200", "ALAND": None, "SHARE": None, "WET": None}
    assert got[("bare.shp", 1)]["properties"] is None and got[("bare.shp", 1)]["rings"] == [FAR]


def test_deleted_attribute_rows_and_empty_folders(spark, tmp_path):
    fields = [("NAME", "C", 4, 0)]
    assert list(shapes.attribute_records(table_file(fields, [("a",), ("b",), ("c",)], deleted={1}))) == [(1, {"NAME": "a"}), (3, {"NAME": "c"})]
    (tmp_path / "empty").mkdir()
    assert shapes.read_shapes(spark, str(tmp_path / "empty")).count() == 0


def test_broken_files_raise():
    with pytest.raises(ValueError, match="not a shape file"):
        list(shapes.polygon_records(b"\0" * 120))
    whole = shape_file([[SQUARE]])
    with pytest.raises(ValueError, match="ends within record 1"):
        list(shapes.polygon_records(whole[:-8]))
    point = whole[:100] + struct.pack(">2i", 1, 10) + struct.pack("<i2d", 1, 1.0, 2.0)
    with pytest.raises(ValueError, match="shape type 1"):
        list(shapes.polygon_records(point))

"""Readers of binary formats on files that are made here byte by byte."""

from __future__ import annotations

import sqlite3
import struct
import zipfile
import zlib

import numpy as np
import pandas as pd

from gridweave.sources import formats


def polygon(*rings, mark="<"):
    return struct.pack(f"{mark}BII", mark == "<", 3, len(rings)) + b"".join(struct.pack(f"{mark}I", len(r)) + b"".join(struct.pack(f"{mark}2d", *p) for p in r) for r in rings)


def line(*points):
    return struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<2d", *p) for p in points)


SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_wkb(spark):
    many = struct.pack("<BII", 1, 6, 2) + polygon(SQUARE) + polygon(SQUARE, mark=">")
    rows = [(1, bytearray(polygon(SQUARE, SQUARE))), (2, bytearray(many)), (3, None), (4, bytearray(b"\x01\x03")), (5, bytearray(struct.pack("<BI2d", 1, 1, 5.0, 6.0)))]
    got = {r["id"]: r["rings"] for r in formats.decode_wkb(spark.createDataFrame(rows, "id int, g binary"), "g").collect()}
    assert [len(got[i]) for i in (1, 2, 5)] == [2, 2, 1] and got[3] is None and got[4] is None
    assert [tuple(p) for p in got[2][1]] == SQUARE and tuple(got[5][0][0]) == (5.0, 6.0)


def test_geopackage(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "a.gpkg")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('roads', 'geom')")
    con.execute("CREATE TABLE roads (id INTEGER, kind TEXT, geom BLOB)")
    head = b"GP\0\1" + struct.pack("<i", 4326)
    two = struct.pack("<BII", 1, 5, 2) + line((0, 0), (1, 1)) + line((50, 50), (60, 60))
    con.executemany("INSERT INTO roads VALUES (?, ?, ?)", [(1, "a", head + two), (2, None, b"GP\0\3" + struct.pack("<i4d", 4326, 0, 1, 0, 1) + line((0, 0), (0, 1))), (3, "c", None)])
    con.commit()
    con.close()
    cols = {"id": "long", "kind": "string"}
    assert sorted((r["id"], r["kind"], len(r["ring"])) for r in formats.read_geopackage(spark, str(tmp_path), "roads", cols).collect()) == [(1, "a", 2), (1, "a", 2), (2, None, 2)]
    assert sorted(r["id"] for r in formats.read_geopackage(spark, str(tmp_path), "roads", cols, (-1, -1, 2, 2)).collect()) == [1, 2]


def tiff(pixels, tile=None, deflate=False):
    """A little-endian TIFF of one float band."""
    h, w = pixels.shape
    pack = zlib.compress if deflate else bytes
    if tile:
        parts = []
        for y in range(0, h, tile):
            for x in range(0, w, tile):
                t = np.zeros((tile, tile), "<f4")
                own = pixels[y : y + tile, x : x + tile]
                t[: own.shape[0], : own.shape[1]] = own
                parts.append(pack(t.tobytes()))
    else:
        parts = [pack(pixels[y : y + 2].astype("<f4").tobytes()) for y in range(0, h, 2)]
    body, places = b"", []
    for p in parts:
        places.append(8 + len(body))
        body += p
    tags = [(256, "H", [w]), (257, "H", [h]), (258, "H", [32]), (259, "H", [8 if deflate else 1]), (339, "H", [3]), (33550, "d", [0.5, 0.5, 0.0]), (33922, "d", [0, 0, 0, 10.0, 20.0, 0])]
    tags += [(322, "H", [tile]), (323, "H", [tile]), (324, "I", places), (325, "I", [len(p) for p in parts])] if tile else [(273, "I", places), (278, "H", [2]), (279, "I", [len(p) for p in parts])]
    tags += [(42113, "s", b"-9\0")]
    extra, at, entries = b"", 8 + len(body), []
    start = at + 2 + 12 * len(tags) + 4
    for tag, kind, values in sorted(tags, key=lambda t: t[0]):
        raw = values if kind == "s" else struct.pack(f"<{len(values)}{kind}", *values)
        code = {"H": 3, "I": 4, "d": 12, "s": 2}[kind]
        if len(raw) <= 4:
            entries.append(struct.pack("<HHI", tag, code, len(values)) + raw.ljust(4, b"\0"))
        else:
            entries.append(struct.pack("<HHII", tag, code, len(values), start + len(extra)))
            extra += raw
    return struct.pack("<2sHI", b"II", 42, at) + body + struct.pack("<H", len(entries)) + b"".join(entries) + b"\0" * 4 + extra


def test_geotiff(spark, tmp_path):
    pixels = np.arange(35, dtype="f4").reshape(5, 7)
    pixels[2, 3] = -9
    for i, (tile, deflate) in enumerate(((None, False), (None, True), (4, False), (4, True))):
        (tmp_path / str(i)).mkdir()
        (tmp_path / str(i) / "a.tif").write_bytes(tiff(pixels, tile, deflate))
        got = {(r["row"], r["col"]): r for r in formats.read_geotiff(spark, str(tmp_path / str(i))).collect()}
        assert len(got) == 35 and got[2, 3]["value"] is None
        assert all(got[r, c]["value"] == pixels[r, c] for r in range(5) for c in range(7) if (r, c) != (2, 3))
        assert (got[1, 2]["x"], got[1, 2]["y"]) == (10 + 2.5 * 0.5, 20 - 1.5 * 0.5)
    part = formats.read_geotiff(spark, str(tmp_path / "3"), (1, 2, 3, 4)).collect()
    assert sorted((r["row"], r["col"]) for r in part) == [(1, 2), (1, 3), (2, 2), (2, 3)]


def test_stata(spark, tmp_path):
    df = pd.DataFrame({"hh": [1, 2, 3], "fuel": pd.Categorical(["wood", "grid", None]), "kwh": [1.5, None, 3.0]})
    df.to_stata(tmp_path / "a.dta", write_index=False)
    got = sorted(map(tuple, formats.read_stata(spark, str(tmp_path), {"hh": "long", "fuel": "string", "kwh": "double"}).collect()))
    assert [r[:2] for r in got] == [(1, "wood"), (2, "grid"), (3, None)] and got[0][2] == 1.5 and got[2][2] == 3.0


def test_sheet(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda r, v, t="": f'<c r="{r}"{t}><v>{v}</v></c>'
    s = ' t="s"'
    rows = cell("A1", 0, s) + cell("A3", 1, s) + cell("B3", 12) + cell("AA3", "0.5") + cell("A4", 2, s) + cell("B4", 3, s)
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Title</t></si><si><t>North </t></si><si><r><t>So</t></r><r><t>uth</t></r></si><si><t>n/a</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData><row>{rows}</row></sheetData></worksheet>")
    got = {(r["key"], r["setting"]): r["value"] for r in formats.read_sheet(spark, str(tmp_path), 2, 0, {"urban": 1, "rural": 26}).collect()}
    assert got == {("North", "urban"): 12.0, ("North", "rural"): 0.5, ("South", "urban"): None, ("South", "rural"): None}


def test_fetching_goes_on(spark):
    def fetch(key, page):
        if key == "gone":
            return 404, "", False
        if key == "busy":
            return 429, "", True
        return 200, f"{key}{page}", page < 2

    asked = spark.createDataFrame([("a",), ("a",), ("gone",), ("busy",), ("held",), ("failed",)], "k string")
    held = spark.createDataFrame([("held", 200), ("failed", 500)], "k string, status int")
    got = sorted((r["k"], r["page"], r["status"], r["body"]) for r in formats.fetched(asked, held, "k", fetch).collect())
    assert got == [("a", 0, 200, "a0"), ("a", 1, 200, "a1"), ("a", 2, 200, "a2"), ("busy", 0, 429, None), ("failed", 0, 200, "failed0"), ("failed", 1, 200, "failed1"), ("failed", 2, 200, "failed2"), ("gone", 0, 404, None)]

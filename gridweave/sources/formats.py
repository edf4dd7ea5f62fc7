"""Readers of binary formats: WKB, GeoPackage, GeoTIFF, Stata, spreadsheets; and paged answers of a service.

A file is read whole by the task that gets it (through Spark's own readers, so any store will do), and what comes out are
rows; many files are read at once, one large file isn't split.
"""

from __future__ import annotations

import io
import re
import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

RINGS = "array<array<struct<x:double,y:double>>>"


def wkb_rings(raw: bytes | None) -> list[list[tuple[float, float]]] | None:
    """The rings or lines of a WKB point, line, polygon, or a collection of one of these; null for null or other kinds."""
    if not raw:
        return None

    def read(at: int) -> tuple[list, int]:
        mark = "<" if raw[at] else ">"
        kind = struct.unpack_from(f"{mark}I", raw, at + 1)[0] & 0xFF
        at += 5

        def points(at: int, n: int) -> tuple[list, int]:
            return [struct.unpack_from(f"{mark}2d", raw, at + 16 * i) for i in range(n)], at + 16 * n

        if kind == 1:
            own, at = points(at, 1)
            return [own], at
        n = struct.unpack_from(f"{mark}I", raw, at)[0]
        at += 4
        if kind == 2:
            own, at = points(at, n)
            return [own], at
        out: list = []
        for _ in range(n):
            if kind == 3:
                m = struct.unpack_from(f"{mark}I", raw, at)[0]
                own, at = points(at + 4, m)
                out.append(own)
            elif kind in (4, 5, 6, 7):
                own, at = read(at)
                out += own
            else:
                raise ValueError(f"geometry kind {kind}")
        return out, at

    try:
        return read(0)[0]
    except (struct.error, ValueError, IndexError):
        return None


def decode_wkb(df: DataFrame, column: str, out: str = "rings") -> DataFrame:
    """Adds the rings of a WKB column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{out: [None if (r := wkb_rings(x)) is None else [[{"x": x, "y": y} for x, y in ring] for ring in r] for x in b[column]]})

    return df.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", {out} {RINGS}")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def _each(files: DataFrame, read: Callable[[str, bytes], pd.DataFrame], schema: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                yield read(path, bytes(content))

    return files.mapInPandas(run, schema)


def read_geopackage(spark: SparkSession, path: str, layer: str, columns: dict[str, str], box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Columns of a layer and its lines or rings, a row for each (multi-part shapes are taken apart), within a box if given."""

    def read(_: str, content: bytes) -> pd.DataFrame:
        con = sqlite3.connect(":memory:")
        con.deserialize(content)
        geom = con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,)).fetchone()[0]
        rows = []
        names = ", ".join(f'"{c}"' for c in columns)
        for *own, raw in con.execute(f'SELECT {names}, "{geom}" FROM "{layer}"'):
            if raw is None:
                continue
            envelope = (0, 32, 48, 48, 64)[raw[3] >> 1 & 7]
            for ring in wkb_rings(raw[8 + envelope :]) or []:
                xs, ys = [p[0] for p in ring], [p[1] for p in ring]
                if box is None or (max(xs) >= box[0] and min(xs) <= box[2] and max(ys) >= box[1] and min(ys) <= box[3]):
                    rows.append((*own, [{"x": x, "y": y} for x, y in ring]))
        return pd.DataFrame(rows, columns=[*columns, "ring"])

    return _each(_files(spark, path), read, ", ".join(f"{c} {t}" for c, t in columns.items()) + ", ring array<struct<x:double,y:double>>")


def tiff_pixels(content: bytes) -> tuple[np.ndarray, dict[int, tuple]]:
    """The first image of a TIFF (one band, strips or tiles, plain or deflated) and its tags."""
    mark = "<" if content[:2] == b"II" else ">"
    at = struct.unpack_from(f"{mark}I", content, 4)[0]
    kinds = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
    tags: dict[int, tuple] = {}
    for k in range(struct.unpack_from(f"{mark}H", content, at)[0]):
        tag, kind, n = struct.unpack_from(f"{mark}HHI", content, at + 2 + 12 * k)
        if kind not in kinds:
            continue
        form = f"{mark}{n}{kinds[kind]}"
        size = struct.calcsize(form)
        place = at + 2 + 12 * k + 8
        tags[tag] = struct.unpack_from(form, content, place if size <= 4 else struct.unpack_from(f"{mark}I", content, place)[0])
    width, height = tags[256][0], tags[257][0]
    packed = tags.get(259, (1,))[0]
    if packed not in (1, 8, 32946) or tags.get(277, (1,))[0] != 1:
        raise ValueError("only plain or deflated images of one band are read")
    dtype = np.dtype(f"{mark}{ {1: 'u', 2: 'i', 3: 'f'}[tags.get(339, (1,))[0]]}{tags[258][0] // 8}")
    plain = (lambda x: x) if packed == 1 else zlib.decompress
    out = np.zeros((height, width), dtype)
    if 324 in tags:
        w, h = tags[322][0], tags[323][0]
        across = -(-width // w)
        for i, (start, n) in enumerate(zip(tags[324], tags[325], strict=True)):
            y, x = i // across * h, i % across * w
            tile = np.frombuffer(plain(content[start : start + n]), dtype).reshape(h, w)
            out[y : y + h, x : x + w] = tile[: height - y, : width - x]
    else:
        step = tags.get(278, (height,))[0]
        for i, (start, n) in enumerate(zip(tags[273], tags[279], strict=True)):
            rows = min(step, height - i * step)
            out[i * step : i * step + rows] = np.frombuffer(plain(content[start : start + n]), dtype).reshape(rows, width)
    return out, tags


def read_geotiff(spark: SparkSession, path: str, window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """(path, row, col, x, y, value): pixels and their middles, within a window (row0, col0, row1, col1); no-data is null."""

    def read(name: str, content: bytes) -> pd.DataFrame:
        pixels, tags = tiff_pixels(content)
        r0, c0, r1, c1 = window or (0, 0, *pixels.shape)
        part = pixels[r0:r1, c0:c1].astype(float)
        if 42113 in tags:  # what stands for no data, as text
            part[part == float(b"".join(tags[42113]).split(b"\0")[0])] = np.nan
        row, col = np.mgrid[r0 : r0 + part.shape[0], c0 : c0 + part.shape[1]]
        sx, sy = tags.get(33550, (1.0, 1.0))[:2]
        _, _, _, x0, y0, _ = tags.get(33922, (0, 0, 0, 0.0, 0.0, 0.0))
        out = pd.DataFrame({"path": name, "row": row.ravel(), "col": col.ravel(), "x": x0 + (col.ravel() + 0.5) * sx, "y": y0 - (row.ravel() + 0.5) * sy})
        out["value"] = [None if np.isnan(v) else float(v) for v in part.ravel()]
        return out

    return _each(_files(spark, path), read, "path string, row long, col long, x double, y double, value double")


def read_stata(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Columns of Stata files, with the words of their value labels where a column is a string here."""

    def read(_: str, content: bytes) -> pd.DataFrame:
        labelled, codes = (pd.read_stata(io.BytesIO(content), convert_categoricals=c, columns=list(columns)) for c in (True, False))
        return pd.DataFrame({c: labelled[c].astype(object).where(labelled[c].notna(), None) if t == "string" else codes[c] for c, t in columns.items()})

    return _each(_files(spark, path), read, ", ".join(f"{c} {t}" for c, t in columns.items()))


def _sheet(content: bytes, number: int) -> dict[tuple[int, int], str]:
    """The cells of a spreadsheet's sheet as text, by row and column from 0."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        cells = {}
        for c in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{number}.xml")).iter(f"{{{ns['m']}}}c"):
            letters, digits = re.fullmatch(r"([A-Z]+)([0-9]+)", c.get("r")).groups()
            col = 0
            for ch in letters:
                col = 26 * col + ord(ch) - 64
            v = c.find("m:v", ns)
            text = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t")) if c.get("t") == "inlineStr" else None if v is None else v.text
            if text is not None:
                cells[int(digits) - 1, col - 1] = shared[int(text)] if c.get("t") == "s" else text
    return cells


def read_sheet(spark: SparkSession, path: str, first_row: int, key_col: int, blocks: dict[str, int], sheet: int = 1) -> DataFrame:
    """(key, setting, value): a table read by position, a row for each key and block of columns; words are null values."""

    def read(_: str, content: bytes) -> pd.DataFrame:
        cells, rows, r = _sheet(content, sheet), [], first_row
        while (r, key_col) in cells:
            for setting, col in blocks.items():
                text = cells.get((r, col))
                rows.append((cells[r, key_col].strip(), setting, float(text) if text and re.fullmatch(r"-?[0-9.]+(e-?[0-9]+)?", text, re.I) else None))
            r += 1
        return pd.DataFrame(rows, columns=["key", "setting", "value"]).astype({"value": object}).where(lambda d: d.notna(), None)

    return _each(_files(spark, path), read, "key string, setting string, value double")


def fetched(asked: DataFrame, held: DataFrame, key: str, fetch: Callable[[str, int], tuple[int, str, bool]], tries: int = 3, pages: int = 1000) -> DataFrame:
    """(key, page, status, body) of each asked key that isn't held: all its pages, as far as they come.

    fetch(key, page) gives (status, body, whether more follow). A 429 or 5xx is tried again up to `tries` times, with a
    wait that doubles; any other failure ends the key with its status and no body. What came is what to store, and a later run
    asks only for keys that the store lacks or that ended in a failure.
    """
    todo = asked.select(key).distinct().join(held.where("status = 200").select(key).distinct(), key, "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for b in batches:
            rows = []
            for name in b[key]:
                for page in range(pages):
                    for attempt in range(tries):
                        status, body, more = fetch(name, page)
                        if status != 429 and status < 500:
                            break
                        time.sleep(0.01 * 2**attempt)
                    rows.append((name, page, status, body if status == 200 else None))
                    if status != 200 or not more:
                        break
            yield pd.DataFrame(rows, columns=[key, "page", "status", "body"])

    return todo.mapInPandas(run, f"{key} {asked.schema[key].dataType.simpleString()}, page int, status int, body string")

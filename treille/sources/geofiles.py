"""Scans of geometry files by their public formats: shapefiles, GeoPackages, well-known binary, one-line GeoJSON.

Each file is read by one task of a binary scan, but for GeoJSON, which is split at its
features. Geometries come as ``array<struct<outer, holes>>``, see operators.geometry.
"""

from __future__ import annotations

import json
import os
import sqlite3
import struct
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treille.operators.geometry import PART

Ring = list[tuple[float, float]]


def _turn(ring: Ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def _inside(point: tuple[float, float], ring: Ring) -> bool:
    x, y = point
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def _as_part(outer: Ring, holes: list[Ring]) -> dict:
    points = lambda ring: [{"x": x, "y": y} for x, y in ring]
    return {"outer": points(outer), "holes": [points(h) for h in holes]}


def polygon_parts(rings: list[Ring]) -> list[dict]:
    """Parts of a shapefile's rings: those clockwise are outlines, each other one a hole of an outline around it."""
    outers = [(r, []) for r in rings if _turn(r) <= 0]
    for hole in (r for r in rings if _turn(r) > 0):
        home = next((holes for outer, holes in outers if _inside(hole[0], outer)), None)
        if home is None:
            outers.append((hole, []))
        else:
            home.append(hole)
    return [_as_part(outer, holes) for outer, holes in outers]


def read_shp(content: bytes) -> list[list[dict] | None]:
    """Geometries of the polygon records of a .shp file in order; null shapes give None."""
    out: list[list[dict] | None] = []
    at = 100
    while at + 8 <= len(content):
        words = struct.unpack(">i", content[at + 4 : at + 8])[0]
        body = content[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0]
        if kind not in (5, 15, 25):
            out.append(None)
            continue
        parts, points = struct.unpack("<2i", body[36:44])
        starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), points]
        flat = struct.unpack(f"<{2 * points}d", body[44 + 4 * parts : 44 + 4 * parts + 16 * points])
        xy = list(zip(flat[::2], flat[1::2]))
        out.append(polygon_parts([xy[a:b] for a, b in zip(starts, starts[1:])]))
    return out


def read_dbf(content: bytes, encoding: str = "utf-8") -> list[dict[str, str | None]]:
    """Rows of a .dbf file as text, blank values null; deleted rows are left out."""
    rows, head, width = struct.unpack("<IHH", content[4:12])
    fields = []
    for at in range(32, head - 1, 32):
        if content[at] == 0x0D:
            break
        fields.append((content[at : at + 11].split(b"\0")[0].decode("ascii"), content[at + 16]))
    out = []
    for n in range(rows):
        row = content[head + n * width : head + (n + 1) * width]
        if not row or row[:1] == b"*":
            continue
        at, got = 1, {}
        for name, size in fields:
            got[name] = row[at : at + size].decode(encoding, "replace").strip() or None
            at += size
        out.append(got)
    return out


def read_wkb(content: bytes, at: int = 0) -> tuple[list[dict], int]:
    """(parts, next place) of a polygon, multipolygon or collection in well-known binary; other kinds have no parts."""
    order = "<" if content[at] == 1 else ">"
    kind = struct.unpack(order + "I", content[at + 1 : at + 5])[0]
    at += 5
    if kind & 0x20000000:
        at += 4
    flags, kind = kind, kind & 0x0FFFFFFF
    width = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3) + bool(flags & 0x80000000) + bool(flags & 0x40000000)
    kind %= 1000

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack(order + "I", content[at - 4 : at])[0]

    def line() -> Ring:
        nonlocal at
        n = number()
        flat = struct.unpack(f"{order}{n * width}d", content[at : at + 8 * n * width])
        at += 8 * n * width
        return list(zip(flat[::width], flat[1::width]))

    if kind == 3:
        rings = [line() for _ in range(number())]
        return ([_as_part(rings[0], rings[1:])] if rings else []), at
    if kind == 1:
        return [], at + 8 * width
    if kind == 2:
        line()
        return [], at
    found = []
    for _ in range(number()):
        parts, at = read_wkb(content, at)
        found += parts
    return found, at


def shapefiles(spark: SparkSession, folder: str, encoding: str = "utf-8") -> DataFrame:
    """(file, row, attributes map, geometry) of the shapefiles of a folder; each .shp is joined to the .dbf beside it by row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    files = files.select(F.regexp_extract("path", r"(?i)^(.*)\.(?:shp|dbf)$", 1).alias("file"), F.lower(F.regexp_extract("path", r"\.(\w+)$", 1)).alias("kind"), "content").where("kind in ('shp', 'dbf')")
    pairs = files.where("kind = 'shp'").select("file", F.col("content").alias("shp")).join(files.where("kind = 'dbf'").select("file", F.col("content").alias("dbf")), "file", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, shp, dbf in zip(pdf["file"], pdf["shp"], pdf["dbf"]):
                shapes = read_shp(bytes(shp))
                rows = read_dbf(bytes(dbf), encoding) if dbf is not None else []
                rows += [{}] * (len(shapes) - len(rows))
                yield pd.DataFrame({"file": file, "row": range(len(shapes)), "attributes": rows[: len(shapes)], "geometry": shapes})

    return pairs.mapInPandas(run, f"file string, row int, attributes map<string,string>, geometry array<{PART}>")


def geopackages(spark: SparkSession, folder: str, table: str, geometry: str = "geom") -> DataFrame:
    """(file, attributes map, geometry) of the rows of a table of the GeoPackages (.gpkg) of a folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with tempfile.NamedTemporaryFile(suffix=".gpkg", delete=False) as f:  # the database library reads files only
                    f.write(bytes(content))
                try:
                    base = sqlite3.connect(f.name)
                    rows = base.execute(f'select * from "{table}"')
                    names = [d[0] for d in rows.description]
                    got = []
                    for row in rows:
                        values = dict(zip(names, row))
                        blob = values.pop(geometry, None)
                        # a header of flags and an envelope stands before the geometry
                        envelope = (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7] if blob else 0
                        got.append((path, {k: str(v) for k, v in values.items() if v is not None}, read_wkb(blob, 8 + envelope)[0] if blob else None))
                    base.close()
                finally:
                    os.unlink(f.name)
                yield pd.DataFrame(got, columns=["file", "attributes", "geometry"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gpkg").load(folder).select("path", "content")
    return files.mapInPandas(run, f"file string, attributes map<string,string>, geometry array<{PART}>")


def split_features(spark: SparkSession, path: str, start: str = '{"type":"Feature",') -> DataFrame:
    """(properties map, geometry json) of a GeoJSON collection of any size, even on one line.

    The scan is split at ``start``, how the file begins a feature, so a file of any size is
    read in parts; compressed files are read whole. What follows the last feature is cut off.
    """
    pieces = spark.read.option("lineSep", start).text(path).select(F.concat(F.lit(start), "value").alias("f"))
    whole = F.regexp_extract("f", r"(?s)^(.*\})[^}]*?(?:,\s*|\]\s*\}\s*)$", 1)
    schema = "type string, properties map<string,string>, geometry string"
    for_last = F.when(whole != "", whole).otherwise(F.col("f"))
    rows = pieces.select(F.from_json(for_last, schema).alias("r")).where("r.type = 'Feature'")
    return rows.select("r.properties", "r.geometry")


def parts_of_json(geometry: str | None) -> list[dict] | None:
    """Parts of a GeoJSON polygon or multipolygon; other kinds have none."""
    if geometry is None:
        return None
    got = json.loads(geometry)
    shapes = {"Polygon": [got.get("coordinates")], "MultiPolygon": got.get("coordinates")}.get(got.get("type"), [])
    return [_as_part(rings[0], rings[1:]) for rings in ([[tuple(p[:2]) for p in ring] for ring in shape] for shape in shapes) if rings]


_POINTS = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("outer", _POINTS), T.StructField("holes", T.ArrayType(_POINTS))])))
def json_parts(geometry: pd.Series) -> pd.Series:
    return geometry.map(parts_of_json)


def newest_release(files: DataFrame, path: str, family: str) -> DataFrame:
    """(family, path): the file of each family whose name comes last; dated names sort by date."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    return files.groupBy(F.regexp_extract(name, family, 1).alias("family")).agg(F.max_by(path, name).alias(path)).where("family <> ''")


def keyed_by_file(df: DataFrame, pattern: str, name: str = "code") -> DataFrame:
    """``df`` with a code taken from the name of the file each row was read from."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_name"), pattern, 1))

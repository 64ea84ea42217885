import math
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from treille.operators import geometry as g
from treille.sources import geofiles as f

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
SCHEMA = f"k int, g array<{g.PART}>"


def part(outer, *holes):
    points = lambda ring: [{"x": x, "y": y} for x, y in ring]
    return {"outer": points(outer), "holes": [points(h) for h in holes]}


def moved(ring, dx, dy=0.0):
    return [(x + dx, y + dy) for x, y in ring]


def test_measures_and_points(spark):
    df = spark.createDataFrame([(1, [part(SQUARE, HOLE)]), (2, []), (3, [part([(1.0, 1.0), (1.0, 1.0)])])], SCHEMA)
    assert [r[0] for r in df.orderBy("k").select(g.area(F.col("g"))).collect()] == [15.0, 0.0, 0.0]
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 5.0, 1.0), (4, 3.5, 3.5)], "p int, x double, y double")
    assert {tuple(r) for r in g.points_in(points, "p", df.where("k = 1"), "k", "g", 1.5).collect()} == {(1, 1), (4, 1)}
    c = df.where("k = 1").select(g.centroid(F.col("g")[0]["outer"]).alias("c")).first()["c"]
    assert (c["x"], c["y"]) == (2.0, 2.0)


def test_union_of_touching_parts(spark):
    rows = [(1, [part(SQUARE)]), (1, [part(moved(SQUARE, 4))]), (1, [part(SQUARE)]), (2, [part(SQUARE[::-1])])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in g.union_area(df, ["k"], "g").collect()} == {(1, 32.0), (2, 16.0)}
    assert g.outer_edges(df.where("k = 1"), ["k"], "g").where("x1 = 4 and x2 = 4").count() == 0


def test_clip_once_never_to_nothing(spark):
    df = spark.createDataFrame([(1, [part(SQUARE), part(moved(SQUARE, 10))]), (2, [part(SQUARE)]), (3, [part(SQUARE)])], SCHEMA)
    specs = spark.createDataFrame([(1, 12.01, 2.0, 16.0), (2, 2.0, 2.0, 16.1), (1, 50.0, 0.0, 1.0)], "k int, cx double, cy double, area double")
    got = {r["k"]: (len(r["g"]), r["status"]) for r in g.clipped(df, "k", "g", specs, 0.1, 0.05).collect()}
    assert got == {1: (1, "stale"), 2: (1, "kept"), 3: (1, "untouched")}


def test_outliers_by_gap_and_share(spark):
    rows = [(1, i, 10.0, float(i), 0.0) for i in range(10)] + [(1, 10, 1.0, 500.0, 0.0), (1, 11, 1.0, 9.5, 0.0)]
    df = spark.createDataFrame(rows, "k int, p int, s double, x double, y double")
    far = g.outliers(df, "k", "p", "s", F.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")), 25, 0.2)
    assert [tuple(r)[:2] for r in far.collect()] == [(1, 10)]


def test_grid_of_europe(spark):
    df = spark.createDataFrame([(10.0, 52.0), (5.0, 45.0), (-9.0, 38.5), (26.0, 60.0)], "lon double, lat double")
    rows = df.withColumn("p", g.to_equal_area(F.col("lon"), F.col("lat"))).withColumn("q", g.from_equal_area(F.col("p.x"), F.col("p.y"))).collect()
    assert (rows[0]["p"]["x"], rows[0]["p"]["y"]) == pytest.approx((4321000.0, 3210000.0), abs=1e-3)
    # the published example of the projection: 50 degrees north, 5 degrees east
    known = spark.createDataFrame([(5.0, 50.0)], "lon double, lat double").select(g.to_equal_area(F.col("lon"), F.col("lat")).alias("p")).first()["p"]
    assert (known["x"], known["y"]) == pytest.approx((3962799.45, 2999718.85), abs=0.01)
    for r in rows:
        assert (r["q"]["lon"], r["q"]["lat"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-7)


def test_simplified_rings_stay_near_and_never_vanish(spark):
    ring = [(math.cos(2 * math.pi * i / 200) * 10, math.sin(2 * math.pi * i / 200) * 10) for i in range(200)]
    ring.append(ring[0])
    df = spark.createDataFrame([(1, [part(ring)]), (2, [part(SQUARE)]), (3, None), (4, [])], SCHEMA)
    got = {r["k"]: r["g"] for r in g.simplified(df, "k", "g", 0.1).collect()}
    assert 4 < len(got[1][0]["outer"]) < 60 and len(got[2][0]["outer"]) == 5 and got[3] is None and got[4] == []
    assert len({r["k"]: r["g"] for r in g.simplified(df, "k", "g", 100.0).collect()}[1][0]["outer"]) >= 4


def wkb(rings):
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<2d", *p) for p in ring)
    return out


def shp(shapes):
    body = b""
    for n, rings in enumerate(shapes, 1):
        if rings is None:
            record = struct.pack("<i", 0)
        else:
            points = [p for r in rings for p in r]
            starts, at = [], 0
            for r in rings:
                starts.append(at)
                at += len(r)
            record = struct.pack("<i4d2i", 5, 0, 0, 0, 0, len(rings), len(points)) + struct.pack(f"<{len(starts)}i", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">2i", n, len(record) // 2) + record
    return b"\0" * 100 + body


def dbf(rows):
    head = struct.pack("<4BIHH20x", 3, 0, 0, 0, len(rows), 32 + 32 + 1, 11) + struct.pack("<11sc4xBB14x", b"NAME", b"C", 10, 0) + b"\r"
    return head + b"".join(b" " + r.encode().ljust(10) for r in rows)


def test_shapefiles_and_geopackages(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.shp").write_bytes(shp([[SQUARE[::-1], HOLE[::-1]], None, [SQUARE[::-1], moved(SQUARE[::-1], 9)]]))
    (tmp_path / "a/x.dbf").write_bytes(dbf(["one", "", "three"]))
    rows = f.shapefiles(spark, str(tmp_path / "a")).orderBy("row").collect()
    assert [(r["attributes"].get("NAME"), None if r["geometry"] is None else [len(p["holes"]) for p in r["geometry"]]) for r in rows] == [("one", [1]), (None, None), ("three", [0, 0])]
    base = sqlite3.connect(tmp_path / "y.gpkg")
    base.execute("create table zones (fid integer, name text, geom blob)")
    head = b"GP" + bytes([0, 1]) + struct.pack("<i", 4326)
    multi = struct.pack("<BII", 1, 6, 2) + wkb([SQUARE]) + wkb([moved(SQUARE, 9), moved(HOLE, 9)])
    base.executemany("insert into zones values (?, ?, ?)", [(1, "a", head + wkb([SQUARE])), (2, "b", head + multi), (3, None, None)])
    base.commit()
    base.close()
    rows = {r["attributes"]["fid"]: r for r in f.geopackages(spark, str(tmp_path), "zones").collect()}
    assert {k: None if r["geometry"] is None else [len(p["holes"]) for p in r["geometry"]] for k, r in rows.items()} == {"1": [0], "2": [0, 1], "3": None}
    assert rows["3"]["attributes"] == {"fid": "3"}


def test_one_line_collections_are_split(spark, tmp_path):
    features = [f'{{"type":"Feature","properties":{{"n":"{i}","t":"a }}, b"}},"geometry":{{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,0]]]}}}}' for i in range(500)]
    (tmp_path / "c.json").write_text('{"type":"FeatureCollection","features":[' + ",".join(features) + "]}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = f.split_features(spark, str(tmp_path / "c.json"))
        rows = got.select("properties", f.json_parts("geometry").alias("g")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(int(r["properties"]["n"]) for r in rows) == list(range(500)) and all(len(r["g"]) == 1 for r in rows)
    assert f.split_features(spark, str(tmp_path / "c.json")).where("geometry is null").count() == 0

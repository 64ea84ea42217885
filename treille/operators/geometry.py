"""Polygons without a geometry library: arrays of rings of (x, y), in built-in functions where they can say it.

A polygon part is ``struct<outer: array<point>, holes: array<array<point>>>``, a geometry an
array of parts; rings repeat their first point at the end.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
PART = f"struct<outer:array<{POINT}>,holes:array<array<{POINT}>>>"

# The ellipsoid of GRS 80 and the origin of the equal-area grid of Europe (EPSG 3035).
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
LAT_0, LON_0, EAST_0, NORTH_0 = 52.0, 10.0, 4321000.0, 3210000.0


def _sum(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def _edges(ring: Column, term) -> Column:
    """``term(p, q)`` of every edge of a ring; none for a ring of fewer than two points."""
    n = F.size(ring)
    return F.when(n > 1, F.zip_with(F.slice(ring, 1, F.greatest(n - 1, F.lit(1))), F.slice(ring, 2, F.greatest(n - 1, F.lit(1))), term)).otherwise(F.array().cast("array<double>"))


def signed_area(ring: Column) -> Column:
    """Shoelace area, positive against the clock."""
    return _sum(_edges(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])) / 2


def part_area(part: Column) -> Column:
    """Area of a part, its holes taken out."""
    return F.abs(signed_area(part["outer"])) - _sum(F.transform(F.coalesce(part["holes"], F.array().cast(f"array<array<{POINT}>>")), lambda h: F.abs(signed_area(h))))


def area(parts: Column) -> Column:
    return _sum(F.transform(parts, part_area))


def centroid(ring: Column) -> Column:
    """struct<x,y>: centre of the area of a ring; the mean of its points where it has no area."""
    a = signed_area(ring)
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]
    cx = _sum(_edges(ring, lambda p, q: (p["x"] + q["x"]) * cross(p, q)))
    cy = _sum(_edges(ring, lambda p, q: (p["y"] + q["y"]) * cross(p, q)))
    n = F.greatest(F.size(ring), F.lit(1))
    mean = lambda k: _sum(F.transform(ring, lambda p: p[k])) / n
    flat = F.abs(a) < 1e-12
    whole = F.when(flat, F.lit(1.0)).otherwise(6 * a)
    return F.struct(F.when(flat, mean("x")).otherwise(cx / whole).alias("x"), F.when(flat, mean("y")).otherwise(cy / whole).alias("y"))


def box(parts: Column) -> list[Column]:
    """minx, miny, maxx, maxy of a geometry."""
    points = F.flatten(F.transform(parts, lambda p: p["outer"]))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return [F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")]


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring, by the number of edges a ray to the right crosses; lower and left borders count as inside."""
    rise = lambda p, q: F.when(q["y"] == p["y"], F.lit(1.0)).otherwise(q["y"] - p["y"])
    crossed = _edges(ring, lambda p, q: F.when(((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / rise(p, q) + p["x"]), 1.0).otherwise(0.0))
    return _sum(crossed) % 2 == 1


def contains(parts: Column, x: Column, y: Column) -> Column:
    """Whether a point lies in a geometry and in none of its holes."""
    return F.exists(parts, lambda p: in_ring(x, y, p["outer"]) & ~F.exists(F.coalesce(p["holes"], F.array().cast(f"array<array<{POINT}>>")), lambda h: in_ring(x, y, h)))


def points_in(points: DataFrame, point_id: str, polygons: DataFrame, polygon_id: str, geometry: str, cell: float) -> DataFrame:
    """(point_id, polygon_id): points (x, y) within polygons; met by grid cells of the polygons' boxes, then tested exactly.

    Cells should be about as large as a box. A box is spread over the cells it covers, so
    no point is compared with a polygon whose box is elsewhere.
    """
    minx, miny, maxx, maxy = box(F.col(geometry))
    boxed = polygons.select(F.col(polygon_id), F.col(geometry).alias("_g"), minx, miny, maxx, maxy)
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    boxed = boxed.withColumn("_cx", F.explode(span("minx", "maxx"))).withColumn("_cy", F.explode(span("miny", "maxy")))
    placed = points.select(F.col(point_id), F.col("x").alias("_x"), F.col("y").alias("_y"), F.floor(F.col("x") / cell).alias("_cx"), F.floor(F.col("y") / cell).alias("_cy"))
    met = placed.join(boxed, ["_cx", "_cy"]).where((F.col("_x") >= F.col("minx")) & (F.col("_x") <= F.col("maxx")) & (F.col("_y") >= F.col("miny")) & (F.col("_y") <= F.col("maxy")))
    return met.where(contains(F.col("_g"), F.col("_x"), F.col("_y"))).select(point_id, polygon_id)


def dissolve(df: DataFrame, by: list[str], geometry: str) -> DataFrame:
    """(by, geometry, members): the parts of each group in one geometry, equal parts once.

    Edges that neighbours share are not removed: a union of this kind covers the same points
    and holds the same boxes, and for parts that do not overlap has the same area.
    """
    parts = df.select(*by, F.explode(geometry).alias("_p"))
    whole = parts.groupBy(*by).agg(F.sort_array(F.collect_set("_p")).alias(geometry))
    return whole.join(df.groupBy(*by).agg(F.count("*").alias("members")), by)


def outer_edges(df: DataFrame, by: list[str], geometry: str) -> DataFrame:
    """(by, x1, y1, x2, y2): the outline of the union of parts that touch without overlapping, edge by edge.

    An edge that two parts run along in opposite directions lies inside and cancels out;
    rings are turned one way first. Parts must share the points of common borders.
    """
    ring = F.when(signed_area(F.col("_p.outer")) < 0, F.reverse(F.col("_p.outer"))).otherwise(F.col("_p.outer"))
    rows = df.select(*by, F.explode(geometry).alias("_p")).select(*by, ring.alias("_r")).distinct()
    n = F.size("_r")
    pairs = F.zip_with(F.slice("_r", 1, F.greatest(n - 1, F.lit(1))), F.slice("_r", 2, F.greatest(n - 1, F.lit(1))), lambda p, q: F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2")))
    edges = rows.where(n > 1).select(*by, F.explode(pairs).alias("e")).select(*by, "e.*").where("x1 <> x2 or y1 <> y2")
    forward = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    ends = [F.when(forward, F.col(a)).otherwise(F.col(b)).alias(f"_{a}") for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    sums = edges.select(*by, *ends, F.when(forward, 1).otherwise(-1).alias("_d")).groupBy(*by, "_x1", "_y1", "_x2", "_y2").agg(F.sum("_d").alias("_d"))
    turned = lambda a, b: F.when(F.col("_d") > 0, F.col(f"_{a}")).otherwise(F.col(f"_{b}")).alias(a)
    return sums.where("_d <> 0").select(*by, turned("x1", "x2"), turned("y1", "y2"), turned("x2", "x1"), turned("y2", "y1"))


def union_area(df: DataFrame, by: list[str], geometry: str) -> DataFrame:
    """(by, area): area of the union of parts that touch without overlapping, from its outline."""
    return outer_edges(df, by, geometry).groupBy(*by).agg(F.abs(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))


def clipped(geometries: DataFrame, key: str, geometry: str, specs: DataFrame, tolerance: float, area_tolerance: float) -> DataFrame:
    """(key, geometry, status): parts that a spec (key, cx, cy, area) describes are taken out.

    A spec applies where exactly one part has its centre within ``tolerance`` and its area
    within the part ``area_tolerance``; otherwise it is ``stale`` and takes out nothing. A
    geometry that would be empty stays whole (``kept``).
    """
    parts = geometries.select(key, F.posexplode(geometry).alias("_i", "_p"))
    c = centroid(F.col("_p.outer"))
    signed = parts.select(key, "_i", "_p", c["x"].alias("_x"), c["y"].alias("_y"), part_area(F.col("_p")).alias("_a"))
    told = specs.select(key, F.monotonically_increasing_id().alias("_s"), "cx", "cy", "area")
    fits = signed.join(told, key).where((F.hypot(F.col("_x") - F.col("cx"), F.col("_y") - F.col("cy")) <= tolerance) & (F.abs(F.col("_a") - F.col("area")) <= area_tolerance * F.col("area")))
    once = fits.groupBy(key, "cx", "cy", "area").agg(F.count("*").alias("_n"), F.min("_i").alias("_i")).where("_n = 1").select(key, "_i").distinct().withColumn("_gone", F.lit(True))
    left = parts.join(once, [key, "_i"], "left").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("_gone").isNull(), F.struct("_i", "_p")))), lambda x: x["_p"]).alias("_left"), F.count("_gone").alias("_n"))
    asked = specs.groupBy(key).agg(F.countDistinct("cx", "cy", "area").alias("_asked"))
    joined = geometries.join(left, key, "left").join(asked, key, "left")
    status = F.when(F.col("_asked").isNull(), "untouched").when(F.size("_left") == 0, "kept").when(F.col("_n") < F.col("_asked"), "stale").otherwise("clipped")
    return joined.select(key, F.when((F.size("_left") > 0) & (F.col("_n") > 0), F.col("_left")).otherwise(F.col(geometry)).alias(geometry), status.alias("status"))


def main_body(parts: DataFrame, key: str, part: str, size: str, share: float = 0.95) -> DataFrame:
    """``parts`` with column ``main``: the largest parts of each key until ``share`` of its size is reached."""
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy(F.desc(size), part).rowsBetween(Window.unboundedPreceding, 0)
    whole = parts.groupBy(key).agg(F.sum(size).alias("_whole"))
    sized = parts.withColumn("_upto", F.sum(size).over(w) - F.col(size)).join(whole, key)
    return sized.withColumn("main", F.col("_upto") < F.lit(share) * F.col("_whole")).drop("_upto")


def outliers(parts: DataFrame, key: str, part: str, size: str, distance, gap: float, most: float) -> DataFrame:
    """(key, part, gap): parts outside the main body, farther than ``gap`` from its nearest part and below the part ``most`` of the whole.

    ``distance`` makes a column from the aliases ``a`` (the part) and ``b`` (a part of the body).
    """
    rows = main_body(parts, key, part, size)
    a, b = rows.where("not main").alias("a"), rows.where("main").alias("b")
    near = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}")).groupBy(F.col(f"a.{key}").alias(key), F.col(f"a.{part}").alias(part)).agg(F.min(distance).alias("gap"), F.first(f"a.{size}").alias("_size"), F.first("a._whole").alias("_all"))
    return near.where((F.col("gap") > gap) & (F.col("_size") < F.lit(most) * F.col("_all"))).select(key, part, "gap")


def _q(sin: Column, e: float) -> Column:
    return (1 - e * e) * (sin / (1 - e * e * sin * sin) - F.log((1 - F.lit(e) * sin) / (1 + F.lit(e) * sin)) / (2 * e))


def from_equal_area(x: Column, y: Column) -> Column:
    """struct<lon,lat> in degrees of a point on the equal-area grid of Europe (Lambert azimuthal, EPSG 3035 to 4326)."""
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    lat0 = math.radians(LAT_0)

    def q(lat: float) -> float:
        s = math.sin(lat)
        return (1 - e * e) * (s / (1 - e * e * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    qp = q(math.pi / 2)
    rq = SEMI_MAJOR * math.sqrt(qp / 2)
    beta0 = math.asin(q(lat0) / qp)
    d = SEMI_MAJOR * math.cos(lat0) / math.sqrt(1 - (e * math.sin(lat0)) ** 2) / (rq * math.cos(beta0))
    u, v = (x - EAST_0) / d, (y - NORTH_0) * d
    rho = F.hypot(u, v)
    far = F.when(rho == 0, F.lit(1.0)).otherwise(rho)
    c = 2 * F.asin(F.least(rho / (2 * rq), F.lit(1.0)))
    sin_beta = F.cos(c) * math.sin(beta0) + v * F.sin(c) * math.cos(beta0) / far
    beta = F.when(rho == 0, F.lit(beta0)).otherwise(F.asin(sin_beta))
    lon = math.radians(LON_0) + F.atan2(u * F.sin(c), rho * math.cos(beta0) * F.cos(c) - v * math.sin(beta0) * F.sin(c))
    e2, e4, e6 = e**2, e**4, e**6
    lat = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + (761 * e6 / 45360) * F.sin(6 * beta)
    return F.struct(F.degrees(F.when(rho == 0, F.lit(math.radians(LON_0))).otherwise(lon)).alias("lon"), F.degrees(lat).alias("lat"))


def to_equal_area(lon: Column, lat: Column) -> Column:
    """struct<x,y> on the equal-area grid of Europe of a point in degrees."""
    e = math.sqrt(2 * FLATTENING - FLATTENING**2)
    qp = (1 - e * e) * (1 / (1 - e * e) - math.log((1 - e) / (1 + e)) / (2 * e))
    rq = SEMI_MAJOR * math.sqrt(qp / 2)
    s0 = math.sin(math.radians(LAT_0))
    beta0 = math.asin((1 - e * e) * (s0 / (1 - e * e * s0 * s0) - math.log((1 - e * s0) / (1 + e * s0)) / (2 * e)) / qp)
    d = SEMI_MAJOR * math.cos(math.radians(LAT_0)) / math.sqrt(1 - (e * s0) ** 2) / (rq * math.cos(beta0))
    beta = F.asin(F.least(F.greatest(_q(F.sin(F.radians(lat)), e) / qp, F.lit(-1.0)), F.lit(1.0)))
    dl = F.radians(lon - LON_0)
    b = rq * F.sqrt(2 / (1 + math.sin(beta0) * F.sin(beta) + math.cos(beta0) * F.cos(beta) * F.cos(dl)))
    return F.struct((EAST_0 + b * d * F.cos(beta) * F.sin(dl)).alias("x"), (NORTH_0 + b / d * (math.cos(beta0) * F.sin(beta) - math.sin(beta0) * F.cos(beta) * F.cos(dl))).alias("y"))


def _thin(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """A ring by Douglas and Peucker, without recursion; a ring that would have no area stays as it is."""
    if len(ring) < 5:
        return ring
    keep = {0, len(ring) - 1}
    far = max(range(len(ring)), key=lambda i: (ring[i][0] - ring[0][0]) ** 2 + (ring[i][1] - ring[0][1]) ** 2)
    keep.add(far)
    stack = [(0, far), (far, len(ring) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        (x1, y1), (x2, y2) = ring[a], ring[b]
        length = math.hypot(x2 - x1, y2 - y1)
        best, at = -1.0, a
        for i in range(a + 1, b):
            x, y = ring[i]
            off = abs((x2 - x1) * (y1 - y) - (x1 - x) * (y2 - y1)) / length if length else math.hypot(x - x1, y - y1)
            if off > best:
                best, at = off, i
        if best > tolerance:
            keep.add(at)
            stack += [(a, at), (at, b)]
    return [ring[i] for i in sorted(keep)] if len(keep) >= 4 else ring


def simplified(df: DataFrame, key: str, geometry: str, tolerance: float) -> DataFrame:
    """(key, geometry) with fewer points, each ring within ``tolerance`` of the old one; no ring and no geometry is emptied."""
    kind = dict(df.dtypes)[key]

    def thin(ring: list[dict]) -> list[dict]:
        return [{"x": x, "y": y} for x, y in _thin([(p["x"], p["y"]) for p in ring], tolerance)]

    def one(text: str | None) -> str | None:
        return None if text is None else json.dumps([{"outer": thin(p["outer"]), "holes": [thin(h) for h in p.get("holes") or []]} for p in json.loads(text)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(g=pdf["g"].map(one, na_action="ignore"))

    # as text: empty lists within lists crash the conversion of nested columns to pandas
    rows = df.select(F.col(key).alias("k"), F.to_json(geometry).alias("g")).mapInPandas(run, f"k {kind}, g string")
    return rows.select(F.col("k").alias(key), F.from_json("g", f"array<{PART}>").alias(geometry))


def rectangle(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """A geometry of one part, turned against the clock."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ring = F.array(corner(minx, miny), corner(maxx, miny), corner(maxx, maxy), corner(minx, maxy), corner(minx, miny))
    return F.array(F.struct(ring.alias("outer"), F.array().cast(f"array<array<{POINT}>>").alias("holes")))


def tile(lon: Column, lat: Column, zoom: int) -> Column:
    """``z/x/y`` of the web map tile a point lies in."""
    n = 2**zoom
    inside = F.least(F.greatest(lat, F.lit(-85.0511287798066)), F.lit(85.0511287798066))
    x = F.least(F.greatest(F.floor((lon + 180) / 360 * n), F.lit(0)), F.lit(n - 1))
    s = F.sin(F.radians(inside))
    y = F.least(F.greatest(F.floor((F.lit(0.5) - F.log((1 + s) / (1 - s)) / (4 * math.pi)) * n), F.lit(0)), F.lit(n - 1))
    return F.concat_ws("/", F.lit(zoom).cast("string"), x.cast("string"), y.cast("string"))

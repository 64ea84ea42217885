"""Boxes, distances and ring areas, without a geometry library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treille.operators.tables import family_pairs
from treille.plans.lineage import cut, spread

EARTH_KM = 6371.0088


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def box_area(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Area of a box; null where it is degenerate."""
    area = (maxx - minx) * (maxy - miny)
    return F.when((maxx > minx) & (maxy > miny), area)


def ring_area(ring: Column) -> Column:
    """Shoelace area of an array of (x, y) structs whose last point repeats the first."""
    nexts = F.slice(ring, 2, F.size(ring))
    terms = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), nexts, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)) / 2


HEAP = 4096  # ids of one row
HELD = 1 << 22  # ids of a table that every executor holds; a larger one is joined by shuffle
SHAPE = ["minx", "miny", "maxx", "maxy"]


def _overlaps(boxes: DataFrame, id_: str, cell: float) -> DataFrame:
    """(a, b, shared, area_a, area_b): pairs of boxes that overlap, found through the grid cells they touch.

    A pair is reported by the cell that holds the lower left corner of its intersection,
    so no distinct is needed. Cells should be about as large as a box.
    """
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    cells = boxes.withColumn("cx", F.explode(span("minx", "maxx"))).withColumn("cy", F.explode(span("miny", "maxy")))
    a, b = cells.alias("a"), cells.alias("b")
    on = (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy")) & (F.col(f"a.{id_}") < F.col(f"b.{id_}"))
    left, low = F.greatest("a.minx", "b.minx"), F.greatest("a.miny", "b.miny")
    right, top = F.least("a.maxx", "b.maxx"), F.least("a.maxy", "b.maxy")
    hit = a.join(b, on).where((left < right) & (low < top) & (F.floor(left / cell) == F.col("a.cx")) & (F.floor(low / cell) == F.col("a.cy")))
    return hit.select(
        F.col(f"a.{id_}").alias("a"), F.col(f"b.{id_}").alias("b"), ((right - left) * (top - low)).alias("shared"),
        ((F.col("a.maxx") - F.col("a.minx")) * (F.col("a.maxy") - F.col("a.miny"))).alias("area_a"), ((F.col("b.maxx") - F.col("b.minx")) * (F.col("b.maxy") - F.col("b.miny"))).alias("area_b"),
    )


def _with_itself(shapes: DataFrame, id_: str) -> DataFrame:
    """Every shape that has an area as a pair with itself, in the columns of ``_overlaps``."""
    area = box_area(*[F.col(c) for c in SHAPE])
    return shapes.where(area.isNotNull()).select(F.col(id_).alias("a"), F.col(id_).alias("b"), area.alias("shared"), area.alias("area_a"), area.alias("area_b"))


def box_overlaps(boxes: DataFrame, id_: str, cell: float, what: dict[str, Column] | None = None) -> DataFrame:
    """(a, b, shared, and the columns of ``what``): pairs of boxes that overlap, the smaller id first.

    ``what`` is made of ``shared`` and of ``area_a`` and ``area_b``, the areas of the two boxes in
    any order. Boxes of one shape stand in heaps of at most ``HEAP``; heaps are compared, and
    only what overlaps is made into pairs, so a row costs no comparison and no shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*SHAPE).orderBy(id_)) - 1
    heaps = boxes.where(F.col(id_).isNotNull()).select(*SHAPE, id_, F.floor(place / HEAP).alias("_c")).groupBy(*SHAPE, "_c").agg(F.collect_list(id_).alias("_ids"))
    heaps = cut(heaps.withColumn("_u", F.monotonically_increasing_id()), "heaps")
    light, ids = heaps.select("_u", *SHAPE), heaps.select("_u", "_ids")
    held = heaps.agg(F.coalesce(F.sum(F.size("_ids") + 8), F.lit(0))).first()[0] <= HELD
    ids = F.broadcast(ids) if held else ids
    pairs = _overlaps(light, "_u", cell).union(_with_itself(light, "_u"))
    pairs = spread(pairs.select("a", "b", "shared", *[c.alias(k) for k, c in (what or {}).items()]), 0)
    pairs = pairs.join(ids.toDF("a", "_xs"), "a").join(ids.toDF("b", "_ys"), "b").withColumn("_x", F.explode("_xs")).withColumn("_y", F.explode("_ys"))
    pairs = pairs.where((F.col("_x") < F.col("_y")) | ((F.col("a") != F.col("b")) & (F.col("_x") > F.col("_y"))))
    return pairs.select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "shared", *(what or {}))


def family_overlaps(boxes: DataFrame, id_: str, family: str, cell: float) -> DataFrame:
    """One row per pair of families whose boxes overlap: (first, second, pairs, a, b, shared), with the largest pair of it; pairs within a family are left out.

    Boxes of one shape and family are counted once with their number, and each shape sums up
    the families around it, so the pairs themselves are never made. Of pairs with the same
    shared area the one with the least ``a``, then ``b`` is named. Boxes whose id occurs more
    than once make no pair with their like; pairs among such boxes are made singly.
    """
    boxes = boxes.where(F.col(id_).isNotNull() & F.col(family).isNotNull())
    repeated = cut(boxes.groupBy(id_).agg(F.count("*").alias("_t")).where("_t > 1"), "repeated").select(id_, F.lit(True).alias("_d"))
    none = repeated.isEmpty()
    flagged = boxes.withColumn("_d", F.lit(False)) if none else boxes.join(repeated, id_, "left").withColumn("_d", F.coalesce("_d", F.lit(False)))
    groups = cut(flagged.groupBy(*SHAPE, F.col(family).alias("f"), "_d").agg(F.count("*").alias("n"), F.min(id_).alias("m")), "groups")
    shapes = cut(groups.select(*SHAPE).distinct().withColumn("g", F.monotonically_increasing_id()), "shapes")
    groups = cut(groups.join(shapes, SHAPE).select("g", "f", "_d", "n", "m"), "groups")
    near = _overlaps(shapes, "g", cell)
    near = cut(near.select("a", "b", "shared").union(near.select("b", "a", "shared")).union(_with_itself(shapes, "g").select("a", "b", "shared")).toDF("g", "h", "shared"), "near")
    there = groups.select(F.col("g").alias("h"), F.col("f").alias("s"), F.col("_d").alias("_e"), F.col("n").alias("k"), F.col("m").alias("o"))
    apart = (F.col("f") < F.col("s")) & ~(F.col("_d") & F.col("_e"))
    around = near.join(there, "h").groupBy("g", "s", "_e").agg(F.sum("k").alias("k"), F.max("shared").alias("shared"))
    totals = cut(groups.join(around, "g").where(apart).groupBy("f", "s").agg(F.sum(F.col("n") * F.col("k")).alias("pairs"), F.max("shared").alias("shared")), "totals")
    largest = near.join(totals.select("shared").distinct(), "shared", "left_semi").join(groups.join(totals.select("f", "shared").distinct(), "f"), ["g", "shared"])
    largest = largest.join(there, "h").where(apart).join(totals, ["f", "s", "shared"])
    got = largest.groupBy(F.col("f").alias("first"), F.col("s").alias("second"), "pairs", "shared").agg(F.min(F.struct(F.least("m", "o").alias("a"), F.greatest("m", "o").alias("b"))).alias("_b"))
    got = got.select("first", "second", "pairs", F.col("_b.a").alias("a"), F.col("_b.b").alias("b"), "shared")
    if none:
        return got
    rows = cut(boxes.join(repeated, id_, "left_semi").withColumn("_r", F.monotonically_increasing_id()), "rows")
    side = lambda k: rows.select(F.col("_r").alias(k), F.col(id_).alias(f"_{k}"), F.col(family).alias(f"_f{k}"))
    single = _overlaps(rows, "_r", cell).join(side("a"), "a").join(side("b"), "b").where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"), "shared", "_fa", "_fb")
    both = got.unionByName(family_pairs(single, "a", "b", F.col("_fa"), F.col("_fb"), "shared"))
    best = F.max_by(F.struct("a", "b", "shared"), F.struct(F.col("shared"), (-F.col("a")).alias("x"), (-F.col("b")).alias("y")))
    return both.groupBy("first", "second").agg(F.sum("pairs").alias("pairs"), best.alias("_b")).select("first", "second", "pairs", "_b.a", "_b.b", "_b.shared")


def overlap_class(shared: Column, area_a: Column, area_b: Column) -> Column:
    """nested where the smaller box lies within by nine tenths, partial from one tenth, else sliver."""
    share = shared / F.least(area_a, area_b)
    return F.when(share >= 0.9, "nested").when(share >= 0.1, "partial").otherwise("sliver")

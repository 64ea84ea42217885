"""Queries whose result is many times their input: what comes out, and that it isn't shuffled or compared row by row."""

from pyspark.sql import functions as F

from treille.operators import derive, geo


def shuffled(df) -> int:
    """Rows that went through shuffles when ``df`` was collected."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        else:
            if name == "Exchange":
                total += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_codes_of_areas_are_not_shuffled(spark):
    areas = spark.range(200).select(F.col("id").alias("k"), F.array(F.lit("a"), F.lit("a"), F.lit(None)).alias("x"), F.when(F.col("id") % 2 == 0, F.array(F.lit("d"))).alias("y"))
    codes = spark.range(300).select(F.lit("d").alias("n"), F.col("id").alias("code"))
    single = spark.createDataFrame([("a", 7), ("a", 1000), ("a", None), ("b", 5)], "n string, code long")
    got = derive.resolved_parts(areas.union(areas.where("k = 3").select("k", F.array(F.lit("b")), "y")), "k", [("x", single, "n", "code"), ("y", codes, "n", "code")])
    rows = got.collect()
    want = {(k, c) for k in range(200) for c in (7, 1000, None)} | {(k, c) for k in range(0, 200, 2) for c in range(300)} | {(3, 5)}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want)
    assert shuffled(got) < len(want) / 10
    again = got.distinct()
    assert len(again.collect()) == len(want) <= shuffled(again)


def test_areas_in_any_order_are_crossed_whole(spark, monkeypatch):
    monkeypatch.setattr(derive, "BLOCK", 3)
    monkeypatch.setattr(derive, "RUN", 4)
    areas = spark.createDataFrame([(i if i else None, [f"n{i % 3}", None, "none"], None if i % 2 else ["d"]) for i in range(40)], "k long, x array<string>, y array<string>")
    table = spark.createDataFrame([(f"n{i % 3}", None if i == 7 else i) for i in range(31)] + [(None, 99)], "n string, code long")
    more = spark.createDataFrame([("d", i) for i in range(25, 34)], "n string, code long")
    want = {(i or None, None if c == 7 else c) for i in range(40) for c in range(34) if (c < 31 and c % 3 == i % 3) or (i % 2 == 0 and c >= 25)}
    for held in (derive.HELD, 0):
        monkeypatch.setattr(derive, "HELD", held)
        rows = [tuple(r) for r in derive.resolved_parts(areas, "k", [("x", table, "n", "code"), ("y", more, "n", "code")]).collect()]
        assert set(rows) == want and len(rows) == len(want)


def test_codes_of_areas_take_little_disk(spark, tmp_path):
    areas = spark.range(4000).select(F.xxhash64("id").alias("k"), F.array(F.concat(F.lit("n"), (F.col("id") % 40).cast("string"))).alias("x"))
    codes = spark.range(12_000).select(F.concat(F.lit("n"), F.pmod(F.xxhash64("id"), F.lit(40)).cast("string")).alias("n"), "id")
    out = tmp_path / "out"
    derive.resolved_parts(areas, "k", [("x", codes, "n", "id")]).write.parquet(str(out))
    rows = spark.read.parquet(str(out))
    assert rows.count() == rows.distinct().count() == 100 * 12_000
    assert sum(f.stat().st_size for f in out.glob("*.parquet")) < 0.5 * 100 * 12_000


def overlaps(rows):
    for i, (a, *x) in enumerate(rows):
        for b, *y in rows[i + 1 :]:
            wide, high = (min(x[k + 2], y[k + 2]) - max(x[k], y[k]) for k in (0, 1))
            if a != b and wide > 0 and high > 0:
                yield (min((a, x[4]), (b, y[4])), max((a, x[4]), (b, y[4])), wide * high)


BOX = "id long, minx long, miny long, maxx long, maxy long, brand string"


def test_families_are_paired_by_shapes(spark):
    rows = [(i, i * 7 % 30, i * 11 % 30, i * 7 % 30 + i % 4 + 5, i * 11 % 30 + i % 4 + 5, "xyz"[i % 3]) for i in range(80)]
    rows += [(i, 1, 2, 9, 9, "xyz"[i % 2]) for i in (80, 81, 82)] + [(3, *rows[9][1:]), (9, *rows[3][1:]), (9, 0, 0, 30, 30, "z"), (3, 0, 0, 30, 30, "x"), (3, 0, 0, 30, 30, "x"), (5, 0, 0, 30, 30, None)]
    got = {(r["first"], r["second"]): (r["pairs"], r["a"], r["b"], r["shared"]) for r in geo.family_overlaps(spark.createDataFrame(rows, BOX), "id", "brand", 10).collect()}
    want = {}
    for a, b, shared in overlaps([r for r in rows if r[5]]):
        if a[1] != b[1]:
            want.setdefault(tuple(sorted((a[1], b[1]))), []).append((-shared, a[0], b[0]))
    assert got == {k: (len(v), min(v)[1], min(v)[2], -min(v)[0]) for k, v in want.items()}


def test_pairs_of_one_shape_are_not_made_singly(spark):
    brands = F.concat(F.lit("b"), F.pmod("id", F.lit(3)).cast("string"))
    boxes = spark.range(60_000).select("id", *[F.lit(v).alias(k) for k, v in zip(("minx", "miny", "maxx", "maxy"), (1, 1, 5, 5))], brands.alias("brand"))
    got = {(r["first"], r["second"], r["pairs"], r["a"], r["b"], r["shared"]) for r in geo.family_overlaps(boxes, "id", "brand", 10).collect()}
    assert got == {("b0", "b1", 20_000**2, 0, 1, 16), ("b0", "b2", 20_000**2, 0, 2, 16), ("b1", "b2", 20_000**2, 1, 2, 16)}


def test_overlaps_are_made_from_heaps_of_one_shape(spark, monkeypatch):
    monkeypatch.setattr(geo, "HEAP", 4)
    rows = [(i, i * 7 % 30, i * 11 % 30, i * 7 % 30 + i % 4 + 5, i * 11 % 30 + i % 4 + 5, "") for i in range(80)]
    rows += [(i, 1, 2, 9, 9, "") for i in range(100, 109)] + [(101, 1, 2, 9, 9, ""), (102, 3, 3, 20, 20, ""), (7, 4, None, 9, 9, ""), (None, 1, 2, 9, 9, ""), (110, 5, 5, 5, 5, "")]
    least = F.least("area_a", "area_b")
    want = sorted((a[0], b[0], shared) for a, b, shared in overlaps([r for r in rows if None not in r]))
    boxes = spark.createDataFrame(rows, BOX)
    for held in (geo.HELD, 0):
        monkeypatch.setattr(geo, "HELD", held)
        got = geo.box_overlaps(boxes, "id", 10, {"least": least}).collect()
        assert sorted((r["a"], r["b"], r["shared"]) for r in got) == want and all(r["shared"] <= r["least"] for r in got)


def test_rows_of_overlaps_are_not_shuffled(spark):
    boxes = spark.range(600).select("id", *[(F.col("id") % 2 + v).alias(k) for k, v in zip(("minx", "miny", "maxx", "maxy"), (1, 1, 5, 5))])
    got = geo.box_overlaps(boxes, "id", 10)
    assert len(got.collect()) == 600 * 599 // 2 and shuffled(got) < 600
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "explode(" in plan

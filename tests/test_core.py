import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from treille.functions import keys, similarity
from treille.operators import dedup, documents, facets, geo, grounded, hierarchy, resolve, tables
from treille.sources import readers, sinks


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values()) or (1,)], list(values) or ["x"])
    return df.select(expr).first()[0]


def test_keys(spark):
    t = F.col("a")
    assert one(spark, keys.slugify(t), a="Côte d'Été — 2") == "cote-d-ete-2"
    assert one(spark, keys.squeeze(t), a="Val-de Ñu") == "valdenu"
    assert one(spark, keys.without_article(t), a="Les Étangs (vieux)") == "etangs"
    assert one(spark, keys.title_case(t), a="BLANC D'OR-FIN") == "Blanc D'Or-Fin"
    assert one(spark, keys.number_list(t), a="1, 4 y 7 al 9, x") == [1, 4, 7, 8, 9]
    assert one(spark, keys.outside_brackets(t), a="a, b (c, d), e") == ["a", "b (c, d)", "e"]
    assert one(spark, keys.natural_key(t), a="4.10.2") == [4, 10, 2]
    assert one(spark, keys.none_if_blank(t), a="  ") is None


def test_similarity(spark):
    assert similarity.longest_common("xxabcdyy", "zabcdz") == 4 and similarity.longest_common("", "a") == 0
    assert similarity.indel_ratio("abc", "abd") == pytest.approx(4 / 6)
    df = spark.createDataFrame([("The  Slow ripening", "a the slow RIPENING here"), (None, "x"), ("", "x")], "q string, s string")
    assert [r[0] for r in df.select(similarity.coverage("q", "s")).collect()] == [1.0, None, 0.0]
    assert df.limit(1).select(similarity.token_sort_ratio(F.lit("b a"), F.lit("a b"))).first()[0] == 1.0
    assert df.limit(1).select(similarity.block_ratio(F.lit("abcd"), F.lit("bcde"))).first()[0] == 0.75


def test_latest_and_once(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (1, None, "c"), (None, 9, "d"), (2, None, "e")], "k long, at long, v string")
    assert {(r["k"], r["v"]) for r in dedup.latest_per_key(df, ["k"], ["at"]).collect()} >= {(1, "b")}
    assert dedup.once_per_key(df, "k").count() == 2
    assert {(r["k"], r["v"]) for r in dedup.first_per_key(df.where("k is not null"), ["k"], [F.asc_nulls_last("at")]).collect()} == {(1, "a"), (2, "e")}


def test_resolvers(spark):
    left = spark.createDataFrame([("val-de-mavo-x",), ("val-de",), ("other",)], "slug string")
    names = spark.createDataFrame([("val",), ("val-de-mavo",), ("other",)], "p string")
    assert {(r["slug"], r["p"]) for r in resolve.longest_prefix(left, "slug", names, "p").collect()} == {("val-de-mavo-x", "val-de-mavo"), ("val-de", "val"), ("other", None)}
    found = {(r["slug"], r["p"]) for r in resolve.contains_unique(left, "slug", names, "p").collect()}
    assert found == {("val-de-mavo-x", "val-de-mavo"), ("val-de", None), ("other", "other")}
    votes = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b")], "k int, l string")
    assert [tuple(r) for r in resolve.majority(votes, "k", "l").collect()] == [(1, "a", 2)]
    own = spark.createDataFrame([(1, "", True), (2, "x", False), (3, None, False)], "k int, v string, stub boolean")
    side = spark.createDataFrame([(1, "s"), (2, "s"), (3, "s")], "k int, v string")
    assert {(r["k"], r["v"]) for r in resolve.fill_empty(own, side, "k", ["v"], F.col("stub")).collect()} == {(1, "s"), (2, "x"), (3, "s")}


def test_trees_with_a_second_parent_and_a_cycle(spark):
    edges = spark.createDataFrame([("a", "r"), ("b", "r"), ("c", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "node string, parent string")
    tree = hierarchy.closure(edges, depth=5)
    assert {(r["ancestor"], r["depth"]) for r in tree.where("node = 'c'").collect()} == {("c", 0), ("a", 1), ("b", 1), ("r", 2)}
    records = spark.createDataFrame([(1, "c"), (1, "a"), (2, "b")], "id int, n string")
    assert {r["ancestor"]: r["records"] for r in hierarchy.roll_up(records, "id", "n", tree).collect()} == {"c": 1, "a": 1, "b": 2, "r": 2}


def test_facets_ignore_their_own_filter(spark):
    df = spark.createDataFrame([("x", ["s"]), ("x", ["t"]), ("y", None)], "a string, b array<string>")
    chosen = {"a": facets.any_of("a", ["x"]), "b": facets.any_of("b", ["s"], True)}
    got = facets.counts_excluding_own(df.withColumn("k", F.lit("v")), {"a": F.col("a"), "b": F.col("k")}, chosen)
    assert {tuple(r) for r in got.collect()} == {("a", "x", 1), ("b", "v", 2)}


def test_tables(spark):
    a = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "k int, sha string")
    b = spark.createDataFrame([(2, "q"), (3, "z"), (4, "s")], "k int, sha string")
    assert {tuple(r) for r in tables.snapshot_diff(a, b, "k", "sha").collect()} == {(1, "removed"), (2, "same"), (3, "changed"), (4, "added")}
    patches = spark.createDataFrame([(1, "n"), (2, "n"), (2, "m")], "k int, v string")
    assert {(r["k"], r["sha"], r["patched"]) for r in tables.patch(a, patches, ["k"], "sha", "v", "skip").collect()} == {(1, "n", True), (2, "q", False), (3, "r", False)}


def test_geo(spark):
    assert one(spark, geo.haversine(F.lit(0), F.lit(0), F.lit(0), F.lit(180))) == pytest.approx(20015.1, abs=0.1)
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in [(0, 0), (2, 0), (2, 3), (0, 3), (0, 0)]])
    assert one(spark, geo.ring_area(ring)) == 6
    assert one(spark, geo.overlap_class(F.lit(9.0), F.lit(10.0), F.lit(100.0))) == "nested"


def test_documents(spark):
    html = "<p>a &amp; b</p><script>no</script><ul><li>x</li><li> </li></ul><a href='u'>1</a><a href=\"v\">2</a><a href='u'>3</a>"
    df = spark.createDataFrame([(1, html)], "k int, h string")
    assert df.select(documents.html_to_text(F.col("h"))).first()[0] == "a & b\nx\n123"
    assert {(r["href"], r["pos"]) for r in documents.links(df, "k", "h").collect()} == {("u", 0), ("v", 1)}
    assert documents.table_rows("<tr><td rowspan=2>a</td><td>1</td></tr><tr><td>2</td></tr><tr><td>b</td><td>3</td></tr>") == [["a", "1"], ["a", "2"], ["b", "3"]]
    heads = spark.createDataFrame([(1, 0, 1), (1, 1, 5), (1, 2, 2), (1, 3, 1), (1, 4, 3)], "k int, o int, n int")
    assert sorted(r["o"] for r in documents.contiguous(heads, "k", "o", "n").collect()) == [0, 2, 4]
    spans = spark.createDataFrame([(1, 0, 5), (1, 3, 8), (1, 5, 6)], "k int, start int, end int")
    assert sorted((r["start"], r["end"]) for r in documents.without_overlaps(spans, "k").collect()) == [(0, 5), (5, 6)]
    text = spark.createDataFrame([(1, "pre\nI. Name\nx\ny\nII. Zone\nz"), (2, "none"), (3, None)], "k int, t string")
    assert [tuple(r) for r in documents.sections(text, "k", "t", r"^([IV]+)\. (.+)$").orderBy("ord").collect()] == [(1, 1, "I", "Name", "x\ny"), (1, 2, "II", "Zone", "z")]
    tags = documents.tag_terms(spark.createDataFrame([(1, "the Val de Mavo and Val"), (2, "")], "k int, t string"), "k", "t", spark.createDataFrame([("val",), ("val de mavo",)], "term string"), "term")
    assert sorted(tuple(r) for r in tags.collect()) == [(1, "val", 6), (1, "val de mavo", 2)]
    assert one(spark, documents.shorten(F.col("a"), 10, 12), a="One two.  Three four five six") == "One two."


def test_grounded(spark):
    jobs = spark.createDataFrame([(1, "p"), (2, "p"), (3, None)], "id int, p string")
    assert {(r["id"], r["answer"]) for r in grounded.ask_once(jobs, "p", lambda x: [y.upper() for y in x]).collect()} == {(1, "P"), (2, "P"), (3, None)}
    assert grounded.loose_array('```json\n["a", "b"]\n```') == ["a", "b"] and grounded.loose_array('["a", "b" oops') == ["a", "b"] and grounded.loose_array("none") is None
    facts = spark.createDataFrame([("slow ripening", "a slow ripening", None), ("nothing", "x", "y")], "q string, a string, b string")
    assert [r["provenance"] for r in grounded.ground(facts, "q", "a", "b").collect()] == ["first"]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "fr").mkdir()
    (tmp_path / "fr/a.json").write_text('{"slug": "a",\n "n": 1}')
    (tmp_path / "fr/bad.json").write_text("{oops")
    (tmp_path / "fr/_index.json").write_text("{}")
    got = readers.json_folders(spark, {"fr": str(tmp_path / "fr")}, "slug string, n int")
    assert sorted((r["slug"] or "", r["n"]) for r in got.collect()) == [("", None), ("a", 1)]
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"properties": {"a": "x"}, "geometry": {"type": "P", "coordinates": [[[1, 2], [3.5, -4]]]}}]}))
    row = readers.features(spark, str(tmp_path / "g.json")).select("properties", *readers.bounds(F.col("geometry"))).first()
    assert row["properties"] == {"a": "x"} and tuple(row)[1:] == (1.0, -4.0, 3.5, 2.0)
    fixed = readers.fixed_columns(spark.createDataFrame([("ab  12 ",)], "line string"), "line", [("a", 1, 4), ("b", 5, 3), ("c", 8, 2)]).first()
    assert (fixed["a"], fixed["b"], fixed["c"]) == ("ab", "12", None)
    pubs = spark.createDataFrame([([("http://x", "L 1"), ("http://c", "OJ C 2 corrigendum"), ("http://y", "OJ C 3")],)], "p array<struct<uri:string,text:string>>")
    assert pubs.select(readers.best_publication(F.col("p"))).first()[0] == "http://y"
    todo = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, sha string")
    filled = spark.createDataFrame([("a", "1", "t"), ("b", "2", "t"), ("c", "1", " "), ("d", "1", "t")], "k string, sha string, text string")
    assert {r["k"]: r["status"] for r in sinks.accept_items(todo, filled, ["k"]).collect()} == {"a": "accepted", "b": "stale", "c": "empty", "d": "unknown"}
    page = spark.createDataFrame([("T", "fr", None, "body")], "a string, b string, c string, d string").select(sinks.markdown(F.col("a"), [("b", F.col("b")), ("c", F.col("c"))], F.col("d"))).first()[0]
    assert page == "# T\n\n- b: fr\n\nbody"


def test_stream_upserts_once_per_batch(spark, tmp_path):
    from treille.streaming import incremental

    schema = "k long, at long, v string"
    for n, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (2, 0, "late")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    args = (spark, str(tmp_path / "in/*"), spark.createDataFrame([], schema).schema, str(tmp_path / "t"), str(tmp_path / "c"), ["k"], ["at"])
    incremental.upsert_stream(*args)
    incremental.upsert_stream(*args)
    state = lambda: {(r["k"], r["v"]) for r in incremental.latest_version(spark, str(tmp_path / "t"), args[2]).collect()}
    assert state() == {(1, "c"), (2, "b")}
    before = incremental.Buckets(spark, str(tmp_path / "t")).last()[1]
    spark.createDataFrame([(1, 3, "d")], schema).coalesce(1).write.parquet(str(tmp_path / "in/2"))
    incremental.upsert_stream(*args)
    after = incremental.Buckets(spark, str(tmp_path / "t")).last()[1]
    assert state() == {(1, "d"), (2, "b")} and sum(before[b] != after[b] for b in before) == 1
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5), "x"), (dt.datetime(2024, 1, 1, 0, 50), "x"), (dt.datetime(2024, 1, 1, 1, 5), "x")], "ts timestamp, e string")
    assert sorted(r["n"] for r in incremental.windowed_counts(events, "ts", "e").collect()) == [1, 2]

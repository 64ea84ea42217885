import pytest
from pyspark.sql import functions as F

from treille.functions import keys
from treille.operators import grammar as g
from treille.operators import resolve, tables, vocabulary
from treille.sources import readers, sinks


def each(spark, make, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("a"))).collect()]


def test_names_of_all_scripts(spark):
    assert each(spark, keys.slugify, "Județul Timiș", "Łódź", "Dingač Čara", "Kőszeg", "Ødegård", "", None) == ["judetul-timis", "odz", "dingac-cara", "koszeg", "degard", "", None]
    assert each(spark, keys.search_key, "Éclair", "Μοσχοφίλερο", "Мавруд й") == ["eclair", "μοσχοφιλερο", "мавруд и"]
    assert each(spark, keys.german_key, "St. Pölten", "Sankt Pölten", "Weißenkirchen") == ["sanktpoelten", "sanktpoelten", "weissenkirchen"]
    assert each(spark, keys.greek_key, "Νεμέας", "Νεμέα", "Σαντορίνης", "Σαντορίνη") == ["νεμε", "νεμε", "σαντοριν", "σαντοριν"]
    assert each(spark, keys.cyrillic_key, "гр. Мелник", "с. Златен Рожен", "Мелник") == ["мелник", "златен рожен", "мелник"]
    assert each(spark, keys.transliterated, "Шевка", "Мавруд-Пловдив", "Ψ x") == ["shevka", "mavrud plovdiv", "ψ x"]
    assert each(spark, keys.inverted_article, "Molar, el", "El Molar", "Vilella Alta, La / otra") == ["molar", "molar", "vilella alta"]
    assert each(spark, keys.place_key, "L'Étang-Neuf", "Les Étangs", "Combe au Roi") == ["etangneuf", "etangs", "combeauroi"]
    assert each(spark, keys.upper_key, "Châ  teau\tx") == ["CHA TEAU X"]
    assert each(spark, keys.variety_key, "Pinot noir N", "Pinot Blanc", "Sauvignon") == ["pinot", "pinot", "sauvignon"]


def test_number_lists(spark):
    assert each(spark, keys.number_list, "del 11 al 16", "1 hasta el 4", "1, 4, 5 i 7", "1, 4 y 7 al 9, x", "9 al 7", "", None, "3-5; 8") == [[11, 12, 13, 14, 15, 16], [1, 2, 3, 4], [1, 4, 5, 7], [1, 4, 7, 8, 9], [9], [], None, [3, 4, 5, 8]]


def test_small_text_functions(spark):
    assert each(spark, keys.place_list, "Ay, Bou-\nzy et Cra (sauf a, b), Dun.", "") == [["Ay", "Bouzy", "Cra (sauf a, b)", "Dun"], []]
    assert [str(x) if x else None for x in each(spark, keys.french_date, "homologué le 3 août 2011.", "1er MAI 1999", "31 février 2000", "none", None)] == ["2011-08-03", "1999-05-01", None, None, None]
    assert each(spark, keys.qid, "http://x.org/entity/Q42", "q7", "Q", None) == ["Q42", "Q7", "", ""]
    assert each(spark, lambda c: keys.clamped(c, 10), "short", "one two three", "wordwordword") == ["short", "one two…", "wordwordw…"]
    df = spark.createDataFrame([("Val de Mavo Clos X", "Val de Mavo", ["a", None, "b"]), ("Other", "Val", []), ("Val", "Val", None)], "n string, p string, s array<string>")
    assert [tuple(r) for r in df.select(keys.without_prefix(F.col("n"), F.col("p")), keys.joined_set(F.col("s")), keys.common_prefix(F.col("n"), F.col("p"))).collect()] == [("Clos X", ";a;b;", 11), ("Other", "", 0), ("Val", "", 3)]
    assert df.select(keys.filled("{a} of {b}{c}", a=F.col("n"), b=F.lit(None))).first()[0] == "Val de Mavo Clos X of "
    assert each(spark, keys.language_code, "spa", "POR", "fr-FR", "und", "", None, "french") == ["es", "pt", "fr", None, None, None, None]


def test_chain_rejects_decoys(spark):
    rows = [(1, 0, "1", "Name"), (1, 1, "1", "inner"), (1, 2, "2", "Zone"), (1, 3, "2.1", "Part"), (1, 4, "3", "whereas"), (1, 5, "3", "Yield"), (1, 6, "2.2", "late"), (1, 7, "9", "x"), (2, 0, "2", "no start")]
    df = spark.createDataFrame(rows, "k int, o int, n string, t string")
    assert sorted((r["k"], r["o"], r["top"]) for r in g.header_chain(df, "k", "o", "n", "t", "^whereas").collect()) == [(1, 0, 1), (1, 2, 2), (1, 3, 2), (1, 5, 3)]


def test_roles_absorbing_and_last(spark):
    s = spark.createDataFrame([(1, 1, "Name", "x"), (1, 2, "Link to the area", "short"), (1, 3, "Factor a", "A"), (1, 4, "Factor b", "B"), (1, 5, "Control of link", "C"), (1, 6, "Factor c", "D"), (2, 1, "Zone", None)], "k int, o int, t string, b string")
    got = {(r["k"], r["o"]): (r["b"], r["merged"]) for r in g.absorbed(s, "k", "o", "t", "b", "^Link", "^Factor").collect()}
    assert got == {(1, 1): ("x", 0), (1, 2): ("Factor a\nA\nFactor b\nB", 2), (1, 5): ("C", 0), (1, 6): ("D", 0), (2, 1): ("", 0)}
    roles = g.routed(s, "k", "t", "o", [("link", "link"), ("area", "zone")], ["control"], {"area": 1, "name": 1})
    assert {(r["k"], r["role"], r["o"], r["how"]) for r in roles.collect()} == {(1, "link", 2, "keyword"), (1, "area", 1, "place"), (2, "area", 1, "keyword")}
    again = spark.createDataFrame([(1, "5", 2, "first"), (1, "5", 9, "last")], "k int, n string, o int, b string")
    assert [tuple(r) for r in g.last_of(again, "k", "n", "o").collect()] == [(1, "5", 9, "last")]


def test_bundles_columns_and_areas(spark):
    text = "ALPHA\nBETA\n\nALPHA\na text\nBETA\nb text\nGAMMA\nc\nGAMMA\nd\nGAMMA\ne"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string")
    names = spark.createDataFrame([(1, "Alpha"), (1, "Beta"), (1, "Gamma"), (1, "None")], "k int, n string")
    assert {(r["n"], r["body"]) for r in g.bundle(df, "k", "t", names, "n").collect()} == {("Alpha", "a text"), ("Beta", "b text"), ("Gamma", "c\nGAMMA\nd\nGAMMA\ne")}
    two = "Left one    right one\nleft two     right two\n             only right\nlast left"
    assert each(spark, g.left_column, two) == ["Left one\nleft two\nlast left"]
    area = spark.createDataFrame([(1, "Department of Ain: A, B. Department of Jura : C et D (sauf x, y)"), (2, "none")], "k int, t string")
    assert {(r["area"], tuple(r["places"])) for r in g.places_by_area(area, "k", "t", r"Department of (\w+)", keys.place_list).collect()} == {("Ain", ("A", "B")), ("Jura", ("C", "D (sauf x, y)"))}
    lists = spark.createDataFrame([(1, "a) Alba\nb) Berna\n– Carla"), (2, "a) Alba\n– Dora\n– Elsa")], "k int, t string")
    assert {tuple(r) for r in g.sub_areas(lists, "k", "t", [("letter", r"^[a-z]\) (.+)$"), ("dash", r"^– (.+)$")]).collect()} == {(1, "Alba", "letter"), (1, "Berna", "letter"), (2, "Dora", "dash"), (2, "Elsa", "dash")}
    ok = spark.createDataFrame([("Alba",), ("alba",), ("Zona 3",), ("Todos",), ("Una Dos Tres Cuatro Cinco Seis",)], "t string").select(g.place_token(F.col("t"), ["todos"]))
    assert [r[0] for r in ok.collect()] == [True, False, False, False, False]


def test_parcels_and_varieties(spark):
    df = spark.createDataFrame([(1, "polygon 3. In Alba: polygons 1, 4 y 7 al 9; polygon 2. In Berna: polygon 5."), (2, None)], "k int, t string")
    got = g.parcels(df, "k", "t", r"In (\w+):", r"polygons? ([\d, yal]+)", keys.number_list)
    assert {(r["anchor"], tuple(r["numbers"])) for r in got.collect()} == {(None, (3,)), ("Alba", (1, 2, 4, 7, 8, 9)), ("Berna", (5,))}
    text = "Principales : pinot noir N, chardon-\nnay B (melon, muscadet)\net aligoté\nAccessoires : gamay o petit gamay Rs; x"
    v = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string")
    rows = g.varieties(v, "k", "t", [("principal", "principales"), ("accessory", "accessoires")]).orderBy("pos").collect()
    assert [(r["role"], r["name"], tuple(r["synonyms"]), r["colour"]) for r in rows] == [("principal", "pinot noir", (), "black"), ("principal", "chardonnay", ("melon", "muscadet"), "white"), ("principal", "aligoté", (), None), ("accessory", "gamay", ("petit gamay Rs",), None)]
    a, b = v.limit(1).select("k"), spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert {tuple(r) for r in g.best_template([("a", a), ("b", b)], "k").collect()} == {(1, "b", 2), (2, "b", 1)}
    assert {tuple(r) for r in g.best_template([("a", a), ("b", b)], "k", "a").collect()} == {(1, "a", 1), (2, "b", 1)}


def test_tagging_slugs_and_rules(spark):
    names = spark.createDataFrame([("Alba",), ("Alba Longa",), ("Berna",)], "n string")
    df = spark.createDataFrame([(1, "Alba. District of Berna and Alba Longa without Berna. State of Alba"), (2, None)], "k int, t string")
    got = g.tagged(df, "k", "t", {"district": ("district of",), "state": ("state of",)}, names, "n", "without")
    assert {tuple(r) for r in got.collect()} == {(1, "none", "alba"), (1, "district", "berna"), (1, "district", "alba longa"), (1, "not", "berna"), (1, "state", "alba")}
    vocabulary_ = spark.createDataFrame([("a-b",), ("a",), ("c",), ("c-d",)], "w string")
    slugs = spark.createDataFrame([("a-b-c-d",), ("a-b",), ("a-x",), (None,), ("c-a",)], "s string")
    assert {(r["s"], tuple(r["parts"])) for r in g.concatenated(slugs, "s", vocabulary_, "w").collect()} == {("a-b-c-d", ("a-b", "c-d")), ("c-a", ("c", "a"))}
    assert each(spark, lambda c: g.by_rules(c, [("x", "ab", None), ("y", "b", "c")]), "AB", "abc", "z") == [["x", "y"], ["x"], []]
    assert each(spark, lambda c: g.read_glyphs(c, {"0": "o", "1": "l"}), "c0o1") == ["cool"]


def test_cascade_over_a_vocabulary(spark):
    v = spark.createDataFrame([("chardonnay", "chardonnay"), ("pinot noir", "pinot-noir"), ("gamay", "gamay"), ("mavrud", "mavrud")], "surface string, slug string")
    t = spark.createDataFrame([(x,) for x in ("Chardonnay", "GAMAY N", "Gamay-Freaux", "chardonay", "noir pinot", "Мавруд", "hardonnay", "klupmok", "", None)], "t string")
    got = {r["t"]: (r["slug"], r["how"], r["colour"]) for r in vocabulary.match_variety(t, "t", v).collect()}
    assert got["Chardonnay"] == ("chardonnay", "exact", "none") and got["GAMAY N"] == ("gamay", "colour", "black") and got["Gamay-Freaux"][:2] == ("gamay", "part")
    assert got["chardonay"][:2] == ("chardonnay", "fuzzy") and got["Мавруд"][:2] == ("mavrud", "exact") and got["klupmok"][:2] == (None, "none")
    assert got["hardonnay"][:2] == (None, "none") or got["hardonnay"][1] == "fuzzy"
    assert "" not in got and None not in got
    entries = spark.createDataFrame([(1, "klupmok"), (1, "klupmok"), (2, "Chardonnay")], "d int, t string")
    assert [tuple(r)[:2] for r in vocabulary.dead_letter(entries, "d", "t", vocabulary.match_variety(t, "t", v)).collect()] == [(1, "klupmok")]


def test_votes_prefer_the_longest_beginning(spark):
    m = spark.createDataFrame([(1, "mavo"), (2, "mavo"), (2, "sure")], "d int, n string")
    places = spark.createDataFrame([("mavo", "g1", 1, "Mavon"), ("mavo", "g2", 2, "Mavo"), ("mavo", "g3", 3, "Alta Mavo"), ("sure", "g3", 9, "Sure")], "n string, g string, c int, f string")
    assert {(r["d"], r["n"], r["g"]) for r in resolve.context_vote(m, "d", "n", places, "g", "c", "f").collect()} == {(1, "mavo", "g1"), (2, "mavo", "g3"), (2, "sure", "g3")}
    assert {(r["d"], r["n"], r["g"]) for r in resolve.context_vote(m, "d", "n", places, "g", "c").collect()} == {(1, "mavo", "g1"), (2, "mavo", "g3"), (2, "sure", "g3")}


def test_segments_by_alias_and_containment(spark):
    t = spark.createDataFrame([("d", "Alba ou Berna"), ("d", "Clos Carla"), ("d", "Zzz"), ("e", "any")], "doc string, target string")
    s = spark.createDataFrame([("d", "BERNA"), ("d", "Carla"), ("e", "One")], "doc string, title string")
    got = {(r["doc"], r["target"]): (r["title"], r["how"]) for r in resolve.segment_of(t, "target", s, "doc", "title", keys.squeeze).collect()}
    assert got == {("d", "Alba ou Berna"): ("BERNA", "alias"), ("d", "Clos Carla"): ("Carla", "held"), ("d", "Zzz"): (None, None), ("e", "any"): ("One", "only")}


def test_patches_that_clash_raise(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    two = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, n string")
    with pytest.raises(ValueError):
        tables.patch(df, two, ["k"], "v", "n")
    assert not any(r["patched"] for r in tables.patch(df, two, ["k"], "v", "n", "skip").collect())
    assert [(r["k"], r["patches"]) for r in tables.patch_clashes(two, ["k"], "n").collect()] == [(1, 2)]


def test_publications_and_links(spark):
    pubs = spark.createDataFrame([([("http://a", "L 12 musc c x"), ("http://b", "Amtsblatt C 3 Berichtigung"), ("http://c", "JO C 44 du 1.2.2020"), ("ftp://d", "C 1")],), ([("http://a", "abc c "), ("http://b", "vin C 5 rettifica")],), ([],), (None,)], "p array<struct<uri:string,text:string>>")
    assert [r[0] for r in pubs.select(readers.best_publication(F.col("p"))).collect()] == ["http://c", "http://b", None, None]
    df = spark.createDataFrame([(["o"], ["a", "o", None, "b"], "text/html; x", bytearray(b"<html>")), (None, None, "text/html", bytearray(b"%PDF-1")), (None, ["z"], None, None)], "o array<string>, h array<string>, t string, c binary")
    assert [tuple(r) for r in df.select(readers.link_candidates(F.col("o"), F.col("h")), readers.response_kind(F.col("t"), F.col("c"))).collect()] == [(["o", "a", "b"], "html"), ([], "pdf"), (["z"], None)]
    tries = spark.createDataFrame([(1, 2, "b", True), (1, 1, "a", False), (1, 3, "c", True), (2, 1, "x", False)], "k int, o int, u string, ok boolean")
    assert [(r["k"], r["u"]) for r in readers.first_success(tries, "k", "o", "ok").collect()] == [(1, "b")]
    assert each(spark, sinks.logical_path, "a/app-1a2b3c4d5e.js", "a/app.js", "x.deadbeef01.css") == ["a/app.js", "a/app.js", "x.css"]

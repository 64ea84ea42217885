from treille.llm import unicode_forms as u


def forms(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    return {r["name"]: r["canonical"] for r in u.canonical_forms(df, "name").collect()}


def test_equal_looking_names_get_one_form(spark):
    got = forms(spark, ["Ｒosso", "Rosso", "Ros​so", "Rоssо", "Sûmi ra", "Sûmi ra", "ﬁn", "Neɡô", "Tide‐go", "Ⅴe"])
    assert len({got[x] for x in ("Ｒosso", "Rosso", "Ros​so", "Rоssо")}) == 1
    assert got["Sûmi ra"] == got["Sûmi ra"] == "Sûmi ra"
    assert (got["ﬁn"], got["Neɡô"], got["Tide‐go"], got["Ⅴe"]) == ("fin", "Negô", "Tide-go", "Ve")


def test_script_case_and_accents_stay_apart(spark):
    got = forms(spark, ["лоза", "лoза", "Λευκό", "Λευκó", "ROSSO", "rosso", "rossò"])
    assert got["лoза"] == "лоза" and got["Λευκó"] == "Λευκό"
    assert len({got[x] for x in ("ROSSO", "rosso", "rossò", "лоза")}) == 4


def test_mark_order_and_long_and_empty_text(spark):
    long = "ậ" * 20_000
    got = forms(spark, ["ậ", "ậ", "", "​‍", long])
    assert got["ậ"] == got["ậ"] == "ậ"
    assert got[""] == "" and got["​‍"] == "" and got[long] == "ậ" * 20_000


def test_pairs_ignore_nulls_redelivery_and_equal_strings(spark):
    rows = [(1, "Rosso", 7, "x"), (1, "Rosso", 7, "y"), (2, "Ｒosso", 7, None), (3, "Rosso", 7, "x"), (4, None, 7, "x"), (None, "Rosso", 7, "x"), (5, "Rоsso", 8, "x")]
    df = spark.createDataFrame(rows, "id long, name string, grp long, t string")
    assert {tuple(r) for r in u.same_looking_pairs(df, "id", "name", ["grp"]).collect()} == {(1, 2), (2, 3)}
    assert {tuple(r) for r in u.same_looking_pairs(df, "id", "name").collect()} == {(1, 2), (2, 3), (1, 5), (2, 5), (3, 5)}
    assert u.same_looking_pairs(df.limit(0), "id", "name").count() == 0

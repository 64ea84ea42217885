import random

from treille.llm import mixing as m


def test_shortages_go_to_siblings_first():
    where = {"a1": ("d", "x"), "a2": ("d", "x"), "b": ("d", "y"), "c": ("e", "z")}.get
    got = m.budgets([("a1", 0.25, 10), ("a2", 0.25, 1000), ("b", 0.25, 1000), ("c", 0.25, 1000)], 400, where)
    assert got == {"a1": 10, "a2": 190, "b": 100, "c": 100}
    got = m.budgets([("a1", 0.25, 10), ("a2", 0.25, 110), ("b", 0.25, 120), ("c", 0.25, 1000)], 400, where)
    assert got == {"a1": 10, "a2": 110, "b": 120, "c": 160}
    assert sum(m.budgets([("a1", 0.5, 10), ("c", 0.5, 10)], 400, where).values()) == 20


def test_shares_repeats_and_prefix(spark):
    rng = random.Random(1)
    rows = [(i, "fr-x" if i < 3000 else "de-x" if i < 3100 else None if i < 3110 else "other", rng.randint(0, 40)) for i in range(3200)]
    df = spark.createDataFrame(rows, "id long, source string, tokens long").selectExpr("*", "1 as h", "2 as repeats")
    chosen, shares = m.mixture(df, "id", "source", [("fr-x", 0.5, 1), ("de-x", 0.3, 3), ("mt-x", 0.2, 2)], total=20_000)
    got = {r["source"]: r for r in shares.collect()}
    picked = chosen.toPandas()
    assert set(picked.source) == {"fr-x", "de-x"} and picked.id.is_unique and (picked.tokens > 0).all()
    assert picked[picked.source == "de-x"].repeats.max() <= 3 and picked[picked.source == "fr-x"].repeats.max() == 1
    total = (picked.tokens * picked.repeats).sum()
    assert abs(total - (got["fr-x"]["budget_share"] + got["de-x"]["budget_share"]) * 20_000) <= 80
    assert got["mt-x"]["reached_share"] == 0 and abs(sum(r["reached_share"] for r in got.values()) - 1) < 1e-9
    again = m.mixture(df.repartition(3), "id", "source", [("fr-x", 0.5, 1), ("de-x", 0.3, 3), ("mt-x", 0.2, 2)], total=20_000)[0].toPandas()
    assert set(zip(again.id, again.repeats)) == set(zip(picked.id, picked.repeats))


def test_a_given_tree_and_one_read_off_the_documents(spark):
    rows = [(i, s, k, la, 100) for i, (s, k, la) in enumerate([("a", "x", "fr")] * 10 + [("a", "x", None)] * 3 + [("b", "x", "fr")] * 40 + [("c", "y", "de")] * 20 + [("c", "y", "it")] * 21 + [("d", None, "de")] * 40 + [(None, "x", "fr")])]
    df = spark.createDataFrame(rows, "id long, source string, kind string, lang string, tokens long")
    tree = m.tree_of(df, "source", "kind", "lang")
    assert {tuple(r) for r in tree.collect()} == {("a", "x", "fr"), ("b", "x", "fr"), ("c", "y", "it"), ("d", "mul", "de")}
    targets = [("a", 0.5, 1), ("b", 0.2, 1), ("c", 0.3, 1), ("e", 0.0, 1)]
    by = lambda t: {r["source"]: r["mixed_tokens"] for r in m.mixture(df, "id", "source", targets, t, total=5000)[1].collect()}
    assert by(tree) == {"a": 1300, "b": 2200, "c": 1500, "e": 0}  # what a lacks goes to b, its sibling
    other = spark.createDataFrame([("a", "x", "fr"), ("b", "x", "it"), ("c", "x", "fr")], "source string, domain string, language string")
    assert by(other) == {"a": 1300, "b": 1000, "c": 2700, "e": 0}


def test_no_documents(spark):
    chosen, shares = m.mixture(spark.createDataFrame([], "id long, source string, tokens long"), "id", "source", [("fr-x", 1.0, 2)])
    assert chosen.count() == 0 and shares.count() == 1

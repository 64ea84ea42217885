import random

from treille.llm import canonical_map as c

ENTRIES = [(1, "PINOT NOIR"), (2, "PINOT BLANC"), (3, "CHARDONNAY"), (4, "PRERCOT D'GENDLAC"), (5, "SALMINA-CHIETRULPO"), (6, None), (7, "TRASUCHERA")]


def mapped(spark, names, entries=ENTRIES):
    values = spark.createDataFrame([(n, 1) for n in names], "name string, id int")
    reference = spark.createDataFrame(entries, "vivc long, prime string")
    return {r["name"]: r["id"] for r in c.map_values(values, "name", reference, "vivc", "prime").collect()}


def test_typos_swaps_blanks_and_additions(spark):
    names = ["pinot noir", "Noir Pinto", "PINOTBLANC", "chardo nnay", "Chardonay (max. 20 %)", "uva trasucehra N", "Prercot G.", "salmina c.", "cv. Prercot Gendlc"]
    got = mapped(spark, names)
    assert [got.get(n) for n in names] == [1, 1, 2, 3, 3, 7, 4, 5, 4]


def test_what_means_no_entry_is_unmatched(spark):
    got = mapped(spark, ["autres cépages", "noir", "pinot", "", "  ", None, "12,5 %", "klupmokwem", "x" * 50_000])
    assert got == {}
    assert mapped(spark, ["pinot noir"], ENTRIES[5:6]) == {}


def test_deletion_join_finds_every_near_word(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 8))) for _ in range(150)})
    units, vocabulary = words[::2], words[1::2]
    got = c.repair_tokens(spark.createDataFrame([(w,) for w in units], "unit string"), spark.createDataFrame([(w,) for w in vocabulary], "v string"))
    want = {(u, v, d) for u in units for v in vocabulary if (d := c.distance(u, v, 2)) <= c.edits_allowed(max(len(u), len(v)))}
    assert {tuple(r) for r in got.collect()} == want


def test_distance_counts_a_swap_once():
    assert c.distance("abcd", "acbd", 2) == 1 and c.distance("abcd", "abcd", 2) == 0 and c.distance("abc", "xyz", 2) == 3


def test_entries_are_found_by_their_commoner_tokens(spark):
    common = "alba berta carla dorna elisa fulvi gresto hinmo".split()
    entries = [(1, " ".join(["zwuxi", *common]))] + [(10 + i, f"{w} {chr(97 + i % 20) * 4}{chr(97 + i // 20) * 4}") for w in common for i in range(30)]
    entries = [(k, x) for k, (_, x) in enumerate(entries, 1)]
    assert mapped(spark, [" ".join(common)], entries) == {" ".join(common): 1}


def test_unmatched_are_all_others(spark, tmp_path):
    names = [(1, "pinot noir"), (2, "klupmokwem"), (3, None), (4, ""), (2, "klupmokwem")]
    spark.createDataFrame(names, "entry_id long, name string").write.parquet(f"{tmp_path}/match_result.parquet")
    spark.createDataFrame(ENTRIES, "vivc_id long, prime_name string").write.parquet(f"{tmp_path}/vivc_passport.parquet")
    assert sorted(r["entry_id"] for r in c.unmatched(spark, str(tmp_path)).collect()) == [2, 3, 4]

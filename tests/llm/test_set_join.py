import itertools
import random

import pytest

from treille.llm import set_join as s


def brute(records, p, q):
    out = set()
    for (a, x), (b, y) in itertools.combinations(sorted(records.items()), 2):
        if q * len(x & y) >= p * len(x | y) and x:
            out.add((a, b))
    return out


@pytest.mark.parametrize("p,q,least,part", [(3, 4, 1, 2000), (3, 4, 1, 3), (1, 3, 1, 2000), (9, 10, 4, 2)])
def test_same_pairs_as_all_pairs(spark, p, q, least, part):
    rng = random.Random(p * q)
    records = {i: set(rng.sample("abcdefghijklmn", rng.randint(least, 9))) for i in range(140)}
    for i in range(40):  # near copies and copies
        records[200 + i] = set(records[i]) ^ set(rng.sample("abcdefgh", rng.randint(0, 2)))
    records = {k: v for k, v in records.items() if len(v) >= least}
    df = spark.createDataFrame([(k, sorted(v)) for k, v in records.items()], "rec long, vals array<string>")
    members, _ = s.similar_sets(df, p, q)
    classes = df.join(members, "rec").where("rec = cid").select("cid", "vals")
    got = [tuple(r) for r in s.expand(members, s.class_links(classes, p, q, part)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(records, p, q)


@pytest.mark.parametrize("p,q,part", [(3, 4, 2000), (3, 4, 3), (1, 3, 4)])
def test_two_tables_as_all_pairs(spark, p, q, part):
    rng = random.Random(p + part)
    left = {i: set(rng.sample("abcdefghijk", rng.randint(1, 8))) for i in range(70)}
    right = {i: set(left[i]) ^ set(rng.sample("abcdefgh", rng.randint(0, 2))) if i < 30 else set(rng.sample("abcdefghijk", rng.randint(0, 8))) for i in range(60)}
    frame = lambda x: spark.createDataFrame([(k, sorted(v)) for k, v in x.items()], "rec long, vals array<string>")
    (a, of_a), (b, of_b) = s._classes(frame(left)), s._classes(frame(right))
    got = [tuple(r) for r in s.expand_between(of_a, of_b, s.links_between(a, b, p, q, part)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y) for x, u in left.items() for y, v in right.items() if u & v and q * len(u & v) >= p * len(u | v)}
    assert s.expand_between(*s.similar_between(frame(left), frame(right).limit(0))).count() == 0


def test_a_hot_key_is_joined_in_bounded_blocks(spark, monkeypatch):
    """Thousands of records share their rarest values: no task holds more than two blocks, and no link is lost."""
    rng = random.Random(9)
    records = {i: {"x", "y", *(f"v{j}" for j in rng.sample(range(60), 6))} for i in range(3000)}
    df = spark.createDataFrame([(k, sorted(v)) for k, v in records.items()], "rec long, vals array<string>")
    classes, _ = s._classes(df)
    ids = spark.createDataFrame([(v, i) for i, v in enumerate(["x", "y", *(f"v{j}" for j in range(60))])], "v string, id long")
    monkeypatch.setattr(s, "_ids", lambda sets: ids)  # the values all share count as the rarest
    sizes = []
    joined = s._joined
    monkeypatch.setattr(s, "_joined", lambda blocked, p, q: (sizes.append(blocked.groupBy("k1", "k2", "part").count().agg({"count": "max"}).first()[0]), joined(blocked, p, q))[1])
    got = {(r["cid_a"], r["cid_b"]) for r in s.class_links(classes, 3, 4, 300).collect()}
    kept = {r["cid"]: records[r["cid"]] for r in classes.collect()}
    assert sizes[0] <= 2 * 450
    by = {}
    for k, v in kept.items():
        for w in itertools.combinations(sorted(v - {"x", "y"}), 5):
            by.setdefault(w, []).append(k)
    want = {(min(a, b), max(a, b)) for group in by.values() for a, b in itertools.combinations(group, 2)}
    assert got == want


def test_t_occurrence_skips_but_loses_nothing():
    rng = random.Random(5)
    for _ in range(200):
        lists = [sorted(rng.sample(range(40), rng.randint(0, 30))) for _ in range(rng.randint(1, 7))]
        need, start = rng.randint(1, 5), rng.randint(0, 10)
        want = {r: n for r in range(start, 40) if (n := sum(r in x for x in lists)) >= need}
        for longest in (0, 1, 3):
            assert dict(s.t_occurrence(lists, need, start, longest)) == want


def test_sets_from_arrays_with_nulls_and_redelivery(spark):
    rows = [(1, ["a", None, "a"], ["b"], 0), (1, ["a", None, "a"], ["b"], 1), (2, None, [], 0), (None, ["a"], ["b"], 0), (3, ["b"], ["a"], 0)]
    df = spark.createDataFrame(rows, "id long, x array<string>, y array<string>, vals int")
    sets = s.value_sets(df, "id", ["x", "y"])
    assert {(r["rec"], tuple(r["vals"])) for r in sets.collect()} == {(1, ("a", "b")), (3, ("a", "b"))}
    members, links = s.similar_sets(sets)
    assert [tuple(r) for r in s.expand(members, links).collect()] == [(1, 3)]
    assert s.expand(*s.similar_sets(sets.limit(0))).count() == 0

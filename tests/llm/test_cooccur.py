import itertools
import random
from collections import Counter

from treille.llm.cooccur import PairTable, baskets_of


def check(table, baskets):
    pairs, items = Counter(), Counter()
    for b in baskets.values():
        items.update(b)
        pairs.update(itertools.combinations(sorted(b), 2))
    n = sum(1 for b in baskets.values() if b)
    got = {(r["item_a"], r["item_b"]): (r["n"], r["lift"]) for r in table.pairs().collect()}
    assert {k: v[0] for k, v in got.items()} == dict(pairs)
    for (a, b), (c, lift) in got.items():
        assert abs(lift - c * n / (items[a] * items[b])) < 1e-9
    assert {r["item"]: r["n"] for r in table.items().collect()} == dict(items)
    assert table.n == n


def test_batches_of_changes_keep_the_table_exact(spark):
    rng = random.Random(3)
    table, baskets = PairTable(spark, buckets=5), {}
    for _ in range(3):
        change = {rng.randint(0, 25): sorted(rng.sample("abcdefg", rng.randint(0, 5))) for _ in range(15)}
        table.apply(spark.createDataFrame(list(change.items()), "key long, items array<string>"))
        baskets |= change
        check(table, baskets)


def test_latest_row_null_and_empty_baskets(spark):
    rows = [(1, ["a", None, "b"], ["b"], 1), (1, ["a", "c"], None, 2), (2, None, [], 1), (None, ["a"], ["b"], 1)]
    df = spark.createDataFrame(rows, "id long, x array<string>, y array<string>, at int")
    baskets = baskets_of(df, "id", ["x", "y"], ["at"])
    assert {(r["key"], tuple(r["items"])) for r in baskets.collect()} == {(1, ("a", "c")), (2, ())}
    table = PairTable(spark)
    table.apply(baskets.limit(0))
    assert table.pairs().count() == 0 and table.associated(1, 0, 0).count() == 0
    table.apply(baskets)
    table.apply(baskets)  # delivered again: no change
    check(table, {1: ["a", "c"]})


def test_a_state_is_opened_again_and_an_older_row_comes_late(spark, tmp_path):
    path = f"file://{tmp_path}/state"

    def rows(*given):
        return baskets_of(spark.createDataFrame(list(given), "id long, x array<string>, at int"), "id", ["x"], ["at"])

    first = PairTable(spark, path)
    first.apply(rows((1, ["a", "b"], 5), (2, ["a", "c"], -7), (3, ["b"], None)))
    again = PairTable(spark, path)
    check(again, {1: ["a", "b"], 2: ["a", "c"], 3: ["b"]})
    again.apply(rows((1, ["a", "c"], 2), (2, [], 3), (3, ["b", "c"], -9)))  # 1 is older than what is stored
    check(again, {1: ["a", "b"], 2: [], 3: ["b", "c"]})
    third = PairTable(spark, path)
    third.apply(rows((2, ["c", "d"], 1)))  # older than the row that emptied it
    check(third, {1: ["a", "b"], 2: [], 3: ["b", "c"]})
    third.apply(rows((2, ["c", "d"], 4)))
    check(PairTable(spark, path), {1: ["a", "b"], 2: ["c", "d"], 3: ["b", "c"]})


def test_a_batch_reads_and_writes_touched_buckets_only(spark):
    table = PairTable(spark, buckets=16)
    table.apply(spark.createDataFrame([(i, [f"v{i}", f"w{i}"]) for i in range(300)], "key long, items array<string>"))
    before = {kind: dict(by) for kind, by in table.versions.items()}
    read = []
    plain = table._read
    table._read = lambda kind, only=None: (read.append((kind, None if only is None else len(only))), plain(kind, only))[1]
    table.apply(spark.createDataFrame([(7, ["v7", "x"])], "key long, items array<string>"))
    changed = {kind: sum(before[kind].get(b) != v for b, v in table.versions[kind].items()) for kind in before}
    assert changed["baskets"] == 1 and changed["items"] <= 3 and changed["pairs"] <= 3
    assert all(n is not None and n <= 3 for kind, n in read if kind in ("baskets", "pairs"))

import random
from collections import defaultdict

import numpy as np

from treille.llm import packing as p
from treille.llm.tokens import token_sizes


def test_nothing_is_lost_and_no_limit_is_passed(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([1, 3, 17, 60, 100, 101, 250, 1000]), 0) for i in range(400)] + [(5, 40, 7), (5, 40, 7), (None, 9, 1), (900, 0, 0), (901, None, None)]
    rows = [(i, n, n and n // 2) for i, n, _ in rows]
    df = spark.createDataFrame(rows, "id long, tokens long, loss_tokens long").selectExpr("*", "1 as block", "2 as container")
    out = p.pack(df, "id", [(1, 100), (2, 64), (3, 0)], segments_per=10, loss_share=0.6, block=150).toPandas()
    for run, cap in ((1, 100), (2, 64)):
        got = out[out.run_id == run]
        assert got.tokens.sum() == sum(n for i, n, _ in rows if i is not None and n)
        bins = got.groupby("container")
        assert bins.tokens.sum().max() <= cap and bins.size().max() <= max(8, cap // 10)
        spans = defaultdict(list)
        for r in got.itertuples():
            spans[r.id].append((r.first_token, r.tokens))
        for i, n, _ in rows[:400]:
            if i != 5:
                parts = sorted(spans[i])
                assert sum(t for _, t in parts) == n and (n > cap or len(parts) == 1)
                assert all(a + t == b for (a, t), (b, _) in zip(parts, parts[1:]))
    assert 3 not in set(out.run_id)


def test_little_space_is_left(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(i, rng.randint(5, 300), 5) for i in range(3000)], "id long, tokens long, loss_tokens long")
    runs = [(1, 1024)]
    assert p.report(p.pack(df, "id", runs), runs).first()["unused_share"] < 0.02


def test_item_beyond_another_limit_is_alone():
    bins = p.fill(np.array([[10.0, 1, 9], [10, 1, 1], [10, 1, 1]]), np.array([100.0, 8, 5]))
    assert sorted(map(sorted, bins)) == [[0], [1, 2]]


def test_sizes_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<|endoftext|>"), (4, "a b\n\nc d e"), (5, "x " * 50_000)], "id long, text string")
    got = {r["id"]: (r["tokens"], r["loss_tokens"]) for r in token_sizes(df, "id", "text").collect()}
    assert got[1] == got[2] == (0, 0) and got[3][0] > 1 and 0 < got[4][1] < got[4][0] and got[5][0] >= 50_000
    assert p.pack(token_sizes(df.limit(0), "id", "text"), "id", [(1, 8)]).count() == 0


def test_the_registered_loss_limit_binds(spark):
    from treille.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    cap = dict(p.capacities(spark, folder))
    out = QUERIES["p7_loss_packed"](spark, folder).toPandas()
    loss = out.groupby(["run_id", "container"]).agg(loss=("loss_tokens", "sum"), items=("doc_id", "size")).reset_index()
    limit = loss.run_id.map(cap) * p.LOSS_SHARE
    assert (loss[loss["items"] > 1].loss <= limit[loss["items"] > 1]).all()
    free = QUERIES["p7_packed"](spark, folder).toPandas()
    assert (free.groupby(["run_id", "container"]).loss_tokens.sum().reset_index().pipe(lambda x: x.loss_tokens > x.run_id.map(cap) * p.LOSS_SHARE)).any()
    assert out.tokens.sum() == free.tokens.sum()


def test_every_limit_binds_somewhere(spark):
    rng = random.Random(6)
    rows = [(i, n, n if rng.random() < 0.97 else 0) for i, n in enumerate(rng.choice([rng.randint(1, 60), rng.randint(60, 350)]) for _ in range(3000))]
    df = spark.createDataFrame(rows, "id long, tokens long, loss_tokens long")
    got = p.pack(df, "id", [(1, 1024)], p.SEGMENTS_PER, p.BEARING).toPandas().groupby("container").agg({"tokens": "sum", "loss_tokens": "sum", "slot": "size"})
    cap, most, bearing = 1024, 1024 // p.SEGMENTS_PER, int(1024 * p.BEARING)
    assert (got.tokens <= cap).all() and (got.slot <= most).all() and (got.loss_tokens <= bearing).all()
    assert (got.slot == most).any() and (got.loss_tokens >= bearing - 2).any()

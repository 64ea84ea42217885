"""Filling containers of fixed capacity: vector bin packing by the dot-product heuristic.

An item is a vector of tokens, one segment and loss-bearing tokens. A container takes,
one after the other, the item that fits and whose dot product with what is still free is
greatest, each dimension weighted by how scarce it is. Items are dealt by a hash of
their id into blocks of bounded size that are packed independently, so the work is
linear in the items and each block leaves at most a few containers partly filled. An item
above the capacity is cut into full containers, and its rest is packed like any item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.llm.tokens import token_sizes
from treille.plans.lineage import cut

BLOCK = 4000  # items packed together

# The limits of the queries, each of which binds in some containers: tokens of capacity for one
# segment more, and the part of the capacity that may bear loss (83 % of the documents' tokens do).
SEGMENTS_PER = 64
BEARING = 0.95


def fill(sizes: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Containers (lists of row numbers) for item vectors; an item beyond a limit other than the first is alone."""
    n = len(sizes)
    # items of one vector are interchangeable: work on the distinct vectors and their rows
    kinds, inverse = np.unique(sizes, axis=0, return_inverse=True)
    inverse = inverse.reshape(-1)
    order = np.argsort(inverse, kind="stable")
    counts = np.bincount(inverse, minlength=len(kinds))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    left = counts.copy()
    unit = kinds / limits
    scarce = (sizes / limits).sum(0)
    weights = scarce / max(scarce.sum(), 1e-12)
    alive = np.arange(len(kinds))
    containers = []
    placed = 0
    while placed < n:
        alive = alive[left[alive] > 0]
        free = limits.astype(float).copy()
        # the first item: the largest that is left, by its heaviest dimension
        k = alive[(unit[alive] * weights).sum(1).argmax()]
        bin_ = []
        while True:
            left[k] -= 1
            bin_.append(int(order[starts[k] + left[k]]))
            placed += 1
            free -= kinds[k]
            if (free < 0).any():
                break
            fits = alive[(left[alive] > 0) & (kinds[alive] <= free + 1e-9).all(1)]
            if not len(fits):
                break
            score = (unit[fits] * (weights * free / limits)).sum(1)
            k = fits[score.argmax()]
        containers.append(bin_)
    return containers


def pack(sized: DataFrame, key: str, runs: list[tuple[int, int]], segments_per: int = 16, loss_share: float = 1.0, block: int = BLOCK) -> DataFrame:
    """(run_id, container, slot, key, piece, first_token, tokens, loss_tokens) for every item and run.

    ``sized`` has (key bigint, tokens, loss_tokens); ``runs`` are (run_id, capacity). A
    container holds at most capacity/segments_per items (8 at least) and capacity *
    loss_share loss-bearing tokens. Items without tokens need no space and have no row; an
    item alone above the loss limit stands alone. Null keys are left out; equal keys are
    separate items. Capacities below 1 have no containers.
    """
    runs = [(int(r), int(c)) for r, c in runs if c is not None and c > 0]
    items = sized.select(F.col(key).cast("bigint").alias("id"), "tokens", "loss_tokens").where("id is not null and tokens > 0")
    blocks = max(1, -(-items.count() // block))
    table = F.array(*[F.struct(F.lit(r).alias("run_id"), F.lit(c).alias("capacity")) for r, c in runs]) if runs else F.array().cast("array<struct<run_id:int,capacity:int>>")
    rows = items.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks))).select("*", F.explode(table).alias("r")).select("r.run_id", "r.capacity", "block", "id", "tokens", "loss_tokens")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        capacity, run, blk = int(pdf["capacity"].iloc[0]), int(pdf["run_id"].iloc[0]), int(pdf["block"].iloc[0])
        pdf = pdf.sort_values(["tokens", "id"], ascending=[False, True], kind="stable")
        out, at, rest = [], 0, []
        for id_, n, loss in zip(pdf["id"], pdf["tokens"], pdf["loss_tokens"]):
            full, more = divmod(n, capacity)
            # the loss-bearing tokens are the last ones
            bears = lambda a, b: max(0, min(b, n) - max(a, n - loss))  # noqa: B023, E731
            if n > capacity:
                for p in range(full):
                    out.append((at, 0, id_, p, p * capacity, capacity, bears(p * capacity, (p + 1) * capacity)))
                    at += 1
                if more:
                    rest.append((id_, full, full * capacity, more, bears(full * capacity, n)))
            else:
                rest.append((id_, 0, 0, n, loss))
        if rest:
            limits = np.array([capacity, max(8, capacity // segments_per), max(1, capacity * loss_share)])
            vectors = np.array([[r[3], 1, r[4]] for r in rest], dtype=float)
            for bin_ in fill(vectors, limits):
                for slot, i in enumerate(bin_):
                    id_, piece, first, n, loss = rest[i]
                    out.append((at, slot, id_, piece, first, n, loss))
                at += 1
        got = pd.DataFrame(out, columns=["at", "slot", "id", "piece", "first_token", "tokens", "loss_tokens"])
        got.insert(0, "run_id", run)
        got.insert(1, "container", blk * (1 << 24) + got.pop("at"))
        return got

    schema = "run_id int, container bigint, slot int, id bigint, piece int, first_token bigint, tokens bigint, loss_tokens bigint"
    return rows.groupBy("run_id", "block").applyInPandas(lambda pdf: one(pdf), schema).withColumnRenamed("id", key)


def report(packed: DataFrame, runs: list[tuple[int, int]]) -> DataFrame:
    """(run_id, capacity, containers, items, tokens, unused_share) by run."""
    by_bin = packed.groupBy("run_id", "container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    by_run = by_bin.groupBy("run_id").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"))
    capacity = F.element_at(F.create_map(*[F.lit(x) for run in runs for x in run]), F.col("run_id"))
    return by_run.select("run_id", capacity.alias("capacity"), "containers", "items", "tokens", (1 - F.col("tokens") / (F.col("containers") * capacity)).alias("unused_share"))


def capacities(spark: SparkSession, folder: str, most: int = 1000) -> list[tuple[int, int]]:
    rows = spark.read.parquet(f"{folder}/pack_capacity.parquet").select("run_id", "capacity_tokens").dropna().distinct().orderBy("run_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} runs; pack them in parts")
    return [(r[0], r[1]) for r in rows]


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return cut(token_sizes(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text"), "sizes")


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_sizes(spark, folder), "doc_id", capacities(spark, folder), SEGMENTS_PER, BEARING)


def unused(spark: SparkSession, folder: str) -> DataFrame:
    runs = capacities(spark, folder)
    return report(pack(_sizes(spark, folder), "doc_id", runs, SEGMENTS_PER, BEARING), runs)


LOSS_SHARE = 0.8  # below the part of loss-bearing tokens of the documents: most containers meet this limit before the tokens


def packed_by_loss(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_sizes(spark, folder), "doc_id", capacities(spark, folder), loss_share=LOSS_SHARE)


def unused_by_loss(spark: SparkSession, folder: str) -> DataFrame:
    runs = capacities(spark, folder)
    return report(pack(_sizes(spark, folder), "doc_id", runs, loss_share=LOSS_SHARE), runs)

"""Differences of snapshots, funnels, conditional patches, work lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, sha: str) -> DataFrame:
    """(key, status): added, removed, changed or same by content hash."""
    a, b = old.select(F.col(key), F.col(sha).alias("_a")), new.select(F.col(key), F.col(sha).alias("_b"))
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed").otherwise("same")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def funnel(spine: DataFrame, key: str, stages: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """The spine with a flag per stage and ``lost_at``, the first stage without the key."""
    out = spine
    for name, table, table_key in stages:
        side = table.select(F.col(table_key).alias("_k")).where("_k is not null").distinct().withColumn(name, F.lit(True))
        out = out.join(side, F.col(key) == F.col("_k"), "left").drop("_k").withColumn(name, F.coalesce(name, F.lit(False)))
    lost = F.coalesce(*[F.when(~F.col(name), F.lit(name)) for name, _, _ in stages], F.lit("none"))
    return out.withColumn("lost_at", lost)


def patch_clashes(patches: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, values): keys for which a patch table has more than one row."""
    return patches.groupBy(*keys).agg(F.count("*").alias("patches"), F.sort_array(F.collect_set(value)).alias("values")).where("patches > 1")


def patch(df: DataFrame, patches: DataFrame, keys: list[str], column: str, value: str, clash: str = "raise") -> DataFrame:
    """``column`` replaced where a patch matches on all keys.

    Two patches for a key are an error of the patch table: they raise, or with ``clash`` =
    ``skip`` apply none and are for patch_clashes to report. A patch without a row is skipped.
    """
    if clash == "raise" and not patch_clashes(patches, keys, value).isEmpty():
        raise ValueError(f"several patches for one key of {', '.join(keys)}")
    side = patches.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(value).alias("_v")).where("_n = 1").drop("_n")
    joined = df.join(side, keys, "left")
    return joined.select(*[F.coalesce("_v", c).alias(c) if c == column else F.col(c) for c in df.columns], F.col("_v").isNotNull().alias("patched"))


def stale_jobs(wanted: DataFrame, cache: DataFrame, keys: list[str], sha: str) -> DataFrame:
    """Work that the cache doesn't hold for the present content."""
    return wanted.join(cache.select(*keys, sha).distinct(), [*keys, sha], "left_anti")


def count_if(*named: tuple[str, Column]) -> list[Column]:
    return [F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in named]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Corpora of different columns under one schema."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def one_to_one(left: DataFrame, right: DataFrame, stages: list[tuple[str, str]], left_id: str, right_id: str) -> DataFrame:
    """Greedy assignment stage by stage: (left_id, right_id, stage). Stages are (left key, right key).

    Within a stage the i-th left row of a key (by id) gets the i-th right row; claimed rows
    take no part in later stages.
    """
    from pyspark.sql import Window

    found = []
    for n, (lk, rk) in enumerate(stages):
        a = left.where(F.col(lk).isNotNull()).withColumn("_i", F.row_number().over(Window.partitionBy(lk).orderBy(left_id))).select(left_id, F.col(lk).alias("_k"), "_i")
        b = right.where(F.col(rk).isNotNull()).withColumn("_i", F.row_number().over(Window.partitionBy(rk).orderBy(right_id))).select(right_id, F.col(rk).alias("_k"), "_i")
        hit = a.join(b, ["_k", "_i"]).select(left_id, right_id, F.lit(n).alias("stage"))
        found.append(hit)
        left = left.join(hit.select(left_id), left_id, "left_anti")
        right = right.join(hit.select(right_id), right_id, "left_anti")
    return union_all(found)


def value_at(df: DataFrame, group: str, value: str, positions: dict[str, Column], least: int = 1, parts: int = 4096) -> DataFrame:
    """(group, a column per position): values by their place in ascending order, found without sorting the groups.

    ``positions`` are columns of ``n``, the group's size, counted from 1. Values are counted in
    ``parts`` ranges between the least and the greatest of all; only the ranges in which a
    position lies are ranked row by row. Null values are left out, and groups below ``least``.
    """
    from pyspark.sql import Window

    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v is not null")
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, width = ends["lo"] or 0.0, ((ends["hi"] or 0.0) - (ends["lo"] or 0.0)) / parts or 1.0
    rows = rows.withColumn("part", F.floor((F.col("v") - lo) / width).cast("int"))
    counts = rows.groupBy("g", "part").agg(F.count("*").alias("k"))  # at most parts + 1 rows a group
    upto = Window.partitionBy("g").orderBy("part")
    counts = counts.withColumns({"before": F.sum("k").over(upto) - F.col("k"), "n": F.sum("k").over(Window.partitionBy("g"))}).where(F.col("n") >= least)
    asked = counts.select("g", "part", "before", "k", F.explode(F.array(*[F.struct(F.lit(name).alias("name"), place.cast("bigint").alias("place")) for name, place in positions.items()])).alias("p"))
    asked = asked.where("p.place > before and p.place <= before + k").select("g", "part", (F.col("p.place") - F.col("before")).alias("i"), "p.name")
    inner = rows.join(asked.select("g", "part").distinct(), ["g", "part"]).withColumn("i", F.row_number().over(Window.partitionBy("g", "part").orderBy("v")).cast("bigint"))
    hit = inner.join(asked, ["g", "part", "i"])
    return hit.groupBy(F.col("g").alias(group)).agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in positions])


def confusion(df: DataFrame, surface: str, expected: Column, detected: Column, sure: Column) -> DataFrame:
    """(surface, expected, detected, n, sure): how often each label was found for each, sure cases counted apart."""
    rows = df.select(F.col(surface), expected.alias("expected"), detected.alias("detected"), sure.alias("_s")).where("expected is not null and detected is not null and expected <> detected")
    return rows.groupBy(surface, "expected", "detected").agg(F.count("*").alias("n"), F.sum(F.col("_s").cast("int")).alias("sure"))


def medians(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Totals and medians of columns by group."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("sum", F.sum), ("median", F.median))])


def family_pairs(pairs: DataFrame, a: str, b: str, family: Column, other: Column, size: str) -> DataFrame:
    """One row per pair of families: (first, second, pairs, a, b, size) with the largest pair of it; pairs within a family are left out."""
    rows = pairs.withColumns({"_f": F.least(family, other), "_s": F.greatest(family, other)}).where("_f <> _s")
    best = F.max_by(F.struct(a, b, size), F.struct(F.col(size), (-F.col(a)).alias("x"), (-F.col(b)).alias("y")))
    got = rows.groupBy(F.col("_f").alias("first"), F.col("_s").alias("second")).agg(F.count("*").alias("pairs"), best.alias("_b"))
    return got.select("first", "second", "pairs", F.col("_b")[a].alias(a), F.col("_b")[b].alias(b), F.col("_b")[size].alias(size))


def retried(jobs: DataFrame, key: str, done: DataFrame, tries: DataFrame, most: int = 3, wait: int = 60) -> DataFrame:
    """Requests still to send after an interruption: (key, attempt, wait_s).

    ``done`` holds the answers so far, ``tries`` the failed attempts (key). A request that
    failed ``most`` times is given up; each further attempt waits longer by ``wait`` seconds.
    """
    failed = tries.groupBy(key).agg(F.count("*").alias("_f"))
    rest = jobs.select(key).distinct().join(done.select(key), key, "left_anti").join(failed, key, "left").withColumn("attempt", F.coalesce("_f", F.lit(0)) + 1)
    return rest.where(F.col("attempt") <= most).select(key, F.col("attempt").cast("int").alias("attempt"), ((F.col("attempt") - 1) * wait).cast("int").alias("wait_s"))


def negatives_still_valid(cache: DataFrame, key: str, now: DataFrame, fingerprint: str = "fingerprint") -> DataFrame:
    """(key, use): cached answers that hold. One without a result (``found`` false) holds only while the fingerprint of the key's inputs is the same."""
    joined = cache.select(key, "found", F.col(fingerprint).alias("_then")).join(now.select(key, F.col(fingerprint).alias("_now")), key)
    return joined.select(key, F.when(F.col("found"), "answer").when(F.col("_then").eqNullSafe(F.col("_now")), "none").otherwise("ask").alias("use"))

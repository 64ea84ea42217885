"""Rows delivered more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def once_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key where redelivered rows repeat the content; rows without key are left out."""
    return df.where(F.col(key).isNotNull()).dropDuplicates([key])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by ``order`` (descending, nulls last).

    Partial aggregation with ``max_by`` on a struct, so a hot key shrinks before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in others])


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by a total order given as sort columns."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")

"""Faceted queries: one predicate per facet, counts under all the others, ranked search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_of(column: str, values: list, array: bool = False) -> Column:
    """A facet's predicate; an unset facet lets all pass."""
    if not values:
        return F.lit(True)
    if array:
        return F.coalesce(F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values])), F.lit(False))
    return F.coalesce(F.col(column).isin(values), F.lit(False))


def matching(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, predicates.values(), F.lit(True)))


def counts_excluding_own(df: DataFrame, facets: dict[str, Column], predicates: dict[str, Column]) -> DataFrame:
    """(facet, value, n): rows by facet value under every predicate but the facet's own, in one scan.

    Each row emits (facet, value) only for the facets whose other predicates hold, and the
    counts are combined before the shuffle.
    """
    def others(name: str) -> Column:
        return reduce(lambda a, b: a & b, [p for k, p in predicates.items() if k != name], F.lit(True))

    emitted = F.array(*[F.when(others(k), F.struct(F.lit(k).alias("facet"), v.cast("string").alias("value"))) for k, v in facets.items()])
    return df.select(F.explode(F.array_compact(emitted)).alias("e")).where("e.value is not null").groupBy("e.facet", "e.value").agg(F.count("*").alias("n"))


def histogram(df: DataFrame, key: str, values: str) -> DataFrame:
    """(value, n): records by distinct array value."""
    return df.select(key, F.explode(F.array_distinct(F.col(values))).alias("value")).where("value is not null").groupBy("value").agg(F.countDistinct(key).alias("n"))


def search_score(label: Column, query: str) -> Column:
    """100 where the label begins with the query, 80 where it holds it, else 0."""
    return F.when(label.startswith(query), 100).when(label.contains(query), 80).otherwise(0)


def top_per_group(df: DataFrame, group: str, order: list, k: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def listed(counts: DataFrame, by: list[str], value: str = "value", n: str = "n") -> DataFrame:
    """Facet values with their place in the listing: most records first, then by name."""
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(n), value)))

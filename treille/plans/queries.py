"""Registry of the queries for the reference's own operators, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from treille.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of a table getter under its name, with its SQL."""

    def wrap(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(lambda name: table(spark, folder, name))

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return wrap


from treille.plans import corpus, derived, passages, places, relations, shapes, texts  # noqa: E402, F401

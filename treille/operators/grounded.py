"""Grounded derivation: prompts once per content, replay, facts kept where a source covers them, tolerant JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treille.functions.similarity import coverage


def ask_once(jobs: DataFrame, prompt: str, answer: Callable[[list[str]], list[str]]) -> DataFrame:
    """``jobs`` with column ``answer``: each distinct prompt is answered once by ``answer`` (a batch function) and joined back by its hash."""
    keyed = jobs.withColumn("prompt_sha", F.sha2(F.col(prompt), 256))
    distinct = keyed.select("prompt_sha", F.col(prompt).alias("p")).where("p is not null").dropDuplicates(["prompt_sha"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"prompt_sha": pdf["prompt_sha"], "answer": answer(list(pdf["p"]))})

    return keyed.join(distinct.mapInPandas(run, "prompt_sha string, answer string"), "prompt_sha", "left")


def ground(facts: DataFrame, quote: str, first: str, second: str, least: float = 0.6) -> DataFrame:
    """Facts whose quote is covered by one of two sources, with both coverages (3 decimals) and provenance both, first or second."""
    c1, c2 = F.bround(F.coalesce(coverage(F.col(quote), F.col(first)), F.lit(0.0)), 3), F.bround(F.coalesce(coverage(F.col(quote), F.col(second)), F.lit(0.0)), 3)
    scored = facts.withColumns({"cover_first": c1, "cover_second": c2})
    a, b = F.col("cover_first") >= least, F.col("cover_second") >= least
    return scored.withColumn("provenance", F.when(a & b, "both").when(a, "first").when(b, "second")).where("provenance is not null")


def loose_array(raw: str | None) -> list[str] | None:
    """Strings of a JSON array in a model's answer: fences dropped, parsed strictly, else its quoted strings; null where there is none."""
    if raw is None:
        return None
    body = re.sub(r"^\s*```\w*\s*|\s*```\s*$", "", raw)
    at, upto = body.find("["), body.rfind("]")
    if at < 0:
        return None
    try:
        got = json.loads(body[at : upto + 1])
        return [str(x) for x in got]
    except ValueError:
        return [json.loads(f'"{m}"') if "\\" in m else m for m in re.findall(r'"((?:[^"\\\n]|\\["\\/nrtbf])*)"', body[at:])] or None


@F.pandas_udf(T.ArrayType(T.StringType()))
def parse_strings(raw: pd.Series) -> pd.Series:
    return raw.map(loose_array)


def overlay(own: Column, translated: Column) -> Column:
    """Translated elements over the own ones where both arrays have one length, else the own."""
    return F.when(F.size(own) == F.size(translated), F.zip_with(own, translated, lambda a, b: F.coalesce(F.nullif(F.trim(b), F.lit("")), a))).otherwise(own)

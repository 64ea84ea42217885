"""Free-entered values mapped to the entry of a reference list that was meant.

Values are folded and cut into tokens; neighbouring tokens are also read as one, and an
entry also counts as one glued token, so lost and stray blanks don't matter. Each
distinct token is joined to the reference vocabulary by edit distance: two strings within
k edits (a swap of neighbours is one) share a string left by at most k deletions from
either, so an equi-join on such strings finds every candidate, and the distance is then
computed. The repaired tokens of a value are matched to whole entries by soft TF-IDF; the
best entry is taken if it is covered well enough, else the value is unmatched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treille.llm.language_mix import fold
from treille.operators.dedup import once_per_key
from treille.plans.lineage import bytes_of, cut, spread

WORD = re.compile(r"[^\W\d_]+")
INITIAL = 0.5  # how far a single letter stands for a word it begins
BROADCAST_WORDS = 15_000
COVERED = 0.7  # least part of an entry's weight that must be found


def edits_allowed(length: int) -> int:
    return 0 if length < 3 else 1 if length < 6 else 2


def tokens(text: str) -> list[str]:
    """Folded words; the elided article before an apostrophe is dropped."""
    text = fold(unicodedata.normalize("NFKC", text))
    return WORD.findall(re.sub(r"\b[dl]['’ʼ`´]", " ", text))


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap neighbours) from a to b, or most+1 where there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def _vocabulary(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(v, id, glued: bool, df) for the tokens of the entries and the entries glued; (id, toks, weights) of the entries."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            toks = [tokens(t) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "toks": toks})

    parsed = cut(entries.mapInPandas(parse, "id bigint, toks array<string>").where(F.size("toks") > 0), "entries")
    total = parsed.count()
    by_token = parsed.select("id", F.explode(F.array_distinct("toks")).alias("v"))
    weight = by_token.groupBy("v").agg(F.count("*").alias("df")).withColumn("w", F.log(1 + F.lit(total) / F.col("df")))
    weighted = by_token.join(weight, "v")
    rarest = Window.partitionBy("id").orderBy("df", "v")
    before = F.sum("w").over(rarest.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    weighted = weighted.withColumns({"rank": F.row_number().over(rarest), "before": before, "all": F.sum("w").over(Window.partitionBy("id"))})
    weighted = cut(weighted, "weights")
    # heads: the rarest tokens without which, as initials at most, COVERED is out of reach
    heads = weighted.where((1 - INITIAL) * F.col("before") <= (1 - COVERED) * F.col("all") + 1e-9).select("v", "id", F.lit(False).alias("glued"))
    glued = parsed.select(F.array_join("toks", "").alias("v"), "id", F.lit(True).alias("glued"))
    whole = weighted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "v", "w"))).alias("toks"))
    others = weighted.select("v", F.lit(None).cast("bigint").alias("id"), F.lit(False).alias("glued"))
    return heads.unionByName(glued).unionByName(others).distinct(), whole


def _units(values: DataFrame, longest: int) -> DataFrame:
    """(value, toks, at, until, unit): single tokens and two or three neighbours read as one."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for value in pdf["value"]:
                toks = tokens(value)
                for i in range(len(toks)):
                    for j in range(i + 1, min(i + 3, len(toks)) + 1):
                        unit = "".join(toks[i:j])
                        if len(unit) <= longest:  # what is longer can't be within reach of the vocabulary
                            rows.append((value, i, j, unit))
            yield pd.DataFrame(rows, columns=["value", "at", "until", "unit"])

    return spread(values).mapInPandas(parse, "value string, at int, until int, unit string")


def _most(length: Column) -> Column:
    return F.when(length < 3, 0).when(length < 6, 1).otherwise(2)


def _variants(word: Column) -> Column:
    """``word`` and what is left of it by as many deletions as a word one letter longer allows edits."""

    def shorter(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w), F.lit(1))), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))

    none = F.array().cast("array<string>")
    once = shorter(word)
    most = _most(F.length(word) + 1)
    return F.array_distinct(F.concat(F.array(word), F.when(most >= 1, once).otherwise(none), F.when(most >= 2, F.flatten(F.transform(once, shorter))).otherwise(none)))


def _distance(a: Column, b: Column) -> Column:
    """Edits from a to b up to 2, a swap of neighbours being one, else 3; all in the JVM, as distance() has it."""
    plain = F.levenshtein(a, b, 4)  # -1 beyond: out of reach, as a swap saves one edit
    at = lambda w, i: F.substring(w, i, F.lit(1))
    crossed = lambda i, j: (at(a, i) == at(b, j + 1)) & (at(a, i + 1) == at(b, j))
    differ = F.filter(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: at(a, i) != at(b, i))
    same_size, d = F.length(a) == F.length(b), lambda k: F.get(differ, F.lit(k))
    one_swap = same_size & (F.size(differ) == 2) & (d(1) == d(0) + 1) & crossed(d(0), d(0))
    two_swaps = same_size & (F.size(differ) == 4) & (d(1) == d(0) + 1) & (d(3) == d(2) + 1) & crossed(d(0), d(0)) & crossed(d(2), d(2))

    def swap_and_edit(i: Column) -> Column:
        found = F.lit(False)
        for shift in (-1, 0, 1):  # where the swapped letters of a stand in b
            j = i + shift
            before = F.levenshtein(F.substring(a, F.lit(1), i - 1), F.substring(b, F.lit(1), j - 1), 1)
            after = F.levenshtein(F.substring(a, i + 2, F.length(a)), F.substring(b, j + 2, F.length(b)), 1)
            found = found | ((j >= 1) & crossed(i, j) & (before >= 0) & (after >= 0) & (before + after <= 1))
        return found

    swapped = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), swap_and_edit)
    return F.when((plain >= 0) & (plain <= 1), plain).when(one_swap, 1).when(plain == 2, 2).when((plain > 2) & (two_swaps | swapped), 2).otherwise(3)


def repair_tokens(units: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(unit, v, d): the vocabulary words within the edits allowed for the longer of both; columns ``unit`` and ``v``, distinct.

    The vocabulary's shortened forms are broadcast only where its counted size bounds them
    (BROADCAST_WORDS words make at most some 100 MB); a larger one is joined by shuffle.
    """
    left = spread(units).select("unit", F.explode(_variants(F.col("unit"))).alias("x"))
    right = vocabulary.select("v", F.explode(_variants(F.col("v"))).alias("x"))
    right = F.broadcast(right) if vocabulary.count() <= BROADCAST_WORDS else right.hint("merge")
    pairs = left.join(right, "x").where(F.levenshtein("unit", "v", 4) >= 0).select("unit", "v").distinct()
    near = pairs.withColumn("d", _distance(F.col("unit"), F.col("v")))
    return near.where(F.col("d") <= _most(F.greatest(F.length("unit"), F.length("v"))))


def _score(toks: list, units: list, v_glued: str | None) -> float:
    """Soft TF-IDF of one entry given the repaired units of a value."""
    best_glued = 0.0
    by_word: dict[str, list] = {}
    for u in units:
        for m in u["near"] if u["near"] is not None else ():
            sim = 1 - m["d"] / max(len(m["v"]), len(u["unit"]))
            if m["v"] == v_glued:
                best_glued = max(best_glued, sim)
            by_word.setdefault(m["v"], []).append((sim, u["at"], u["until"]))
    taken: set[int] = set()
    got, total = 0.0, 0.0
    missing = []
    for t in toks:
        total += t["w"]
        options = [o for o in by_word.get(t["v"], []) if not taken & set(range(o[1], o[2]))]
        if options:
            sim, a, b = max(options)
            taken |= set(range(a, b))
            got += t["w"] * (0.75 + 0.25 * sim)
        else:
            missing.append(t)
    for t in missing if taken else ():  # an initial counts only beside a word
        letters = [u["at"] for u in units if u["unit"] == t["v"][0] and u["at"] not in taken]
        if letters:
            taken.add(letters[0])
            got += t["w"] * INITIAL
    covered = got / total if total else 0.0
    return max(covered, 0.75 + 0.25 * best_glued if best_glued else 0.0)


def map_values(values: DataFrame, text: str, entries: DataFrame, entry_id: str, entry_text: str) -> DataFrame:
    """(text, id, score) for the distinct values of column ``text`` that mean an entry; ties go to the smaller id.

    Null, blank and wordless values, and values meaning no entry, have no row. An empty
    reference list matches nothing.
    """
    reference = entries.select(F.col(entry_id).cast("bigint").alias("id"), F.col(entry_text).alias("text")).dropna().dropDuplicates(["id"])
    vocabulary, whole = _vocabulary(reference)
    vocabulary = cut(vocabulary, "vocabulary")
    longest = (vocabulary.agg(F.max(F.length("v"))).first()[0] or 0) + 2
    distinct = values.select(F.col(text).alias("value")).where(F.col("value").rlike(r"(?U)\p{L}")).distinct()
    units = cut(_units(distinct, longest), "units")
    near = repair_tokens(units.select("unit").distinct(), vocabulary.select("v").distinct())
    near = cut(near, "near")
    grouped = near.groupBy("unit").agg(F.collect_list(F.struct("v", "d")).alias("near"))
    matched = cut(units.join(grouped, "unit", "left"), "matched")
    heads = vocabulary.where("id is not null")
    candidates = matched.select("value", F.explode("near.v").alias("v")).distinct().join(heads, "v")
    candidates = candidates.groupBy("value", "id").agg(F.max(F.when(F.col("glued"), F.col("v"))).alias("glued"))
    by_value = matched.groupBy("value").agg(F.sort_array(F.collect_list(F.struct("at", "until", "unit", "near"))).alias("units"))
    rows = candidates.join(whole, "id").join(by_value, "value").select("value", "id", "toks", "glued", "units")

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            scores = [_score(t, u, g) for t, u, g in zip(pdf["toks"], pdf["units"], pdf["glued"])]
            yield pd.DataFrame({"value": pdf["value"], "id": pdf["id"], "score": scores})

    ranked = spread(rows, 4 * bytes_of(matched)).mapInPandas(rank, "value string, id bigint, score double").where(F.col("score") >= COVERED)
    best = ranked.groupBy("value").agg(F.max(F.struct("score", (-F.col("id")).alias("neg"))).alias("b"))
    return best.select(F.col("value").alias(text), (-F.col("b.neg")).alias("id"), F.col("b.score").alias("score"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    entries = once_per_key(spark.read.parquet(f"{folder}/match_result.parquet").select("entry_id", "name"), "entry_id")
    mapped = map_values(entries, "name", spark.read.parquet(f"{folder}/vivc_passport.parquet"), "vivc_id", "prime_name")
    return entries.join(mapped, "name").select("entry_id", F.col("id").alias("vivc_id"))


def unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """(entry_id, name) of the entries whose name means none of the reference list, null and empty names among them."""
    entries = once_per_key(spark.read.parquet(f"{folder}/match_result.parquet").select("entry_id", "name"), "entry_id")
    return entries.join(found(spark, folder).select("entry_id"), "entry_id", "left_anti")

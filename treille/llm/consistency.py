"""Queries that check results of the training-data operators by what SQL can say of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.llm import canonical_map, language_mix, mixing, packing, sentences, unicode_forms
from treille.operators.dedup import once_per_key
from treille.plans.lineage import cut

# Characters without any width.
INVISIBLE = "​‌‍⁠﻿­"


def invisible(spark: SparkSession, folder: str) -> DataFrame:
    """Of the pairs that read the same those that differ in characters without width only: (tbl, id_a, id_b)."""
    bare = lambda c: F.regexp_replace(c, f"[{INVISIBLE}]", "")
    found = cut(unicode_forms.found(spark, folder), "found")
    parts = []
    for table, key in (("ofag_entry", "entry_id"), ("vivc_synonym", "syn_id")):
        names = once_per_key(spark.read.parquet(f"{folder}/{table}.parquet").select(key, "name"), key)
        side = lambda s, names=names, key=key: names.select(F.col(key).alias(f"id_{s}"), F.col("name").alias(f"name_{s}"))
        pairs = found.where(F.col("tbl") == table).join(side("a"), "id_a").join(side("b"), "id_b")
        parts.append(pairs.where(bare(F.col("name_a")) == bare(F.col("name_b"))).select("tbl", "id_a", "id_b"))
    return parts[0].unionByName(parts[1])


INVISIBLE_SQL = f"""
WITH o AS (SELECT DISTINCT entry_id id, name, regexp_replace(name, '[{INVISIBLE}]', '', 'g') b FROM ofag_entry WHERE name IS NOT NULL),
v AS (SELECT DISTINCT syn_id id, vivc_id, name, regexp_replace(name, '[{INVISIBLE}]', '', 'g') b FROM vivc_synonym WHERE name IS NOT NULL AND vivc_id IS NOT NULL)
SELECT 'ofag_entry' AS tbl, x.id AS id_a, y.id AS id_b FROM o x JOIN o y ON x.b = y.b AND x.id < y.id AND x.name <> y.name
UNION ALL SELECT 'vivc_synonym', x.id, y.id FROM v x JOIN v y ON x.b = y.b AND x.vivc_id = y.vivc_id AND x.id < y.id AND x.name <> y.name
"""


def exact(spark: SparkSession, folder: str) -> DataFrame:
    """Of the mapped entries those whose name is an entry's own, capitals aside: (entry_id, vivc_id)."""
    found = canonical_map.found(spark, folder)
    entries = once_per_key(spark.read.parquet(f"{folder}/match_result.parquet").select("entry_id", "name"), "entry_id")
    names = spark.read.parquet(f"{folder}/vivc_passport.parquet").select("vivc_id", F.lower("prime_name").alias("low"))
    only = names.groupBy("low").agg(F.count("*").alias("n")).where("n = 1").select("low")
    joined = found.join(entries, "entry_id").join(names.join(only, "low"), "vivc_id")
    return joined.where((F.lower(F.trim("name")) == F.col("low")) & F.col("low").rlike(r"(?U)\p{L}{3}")).select("entry_id", "vivc_id")


EXACT_SQL = r"""
WITH e AS (SELECT DISTINCT entry_id, lower(trim(name, ' ')) low FROM match_result), p AS (SELECT lower(prime_name) low, min(vivc_id) vivc_id FROM vivc_passport GROUP BY 1 HAVING count(*) = 1)
SELECT entry_id, vivc_id FROM e JOIN p USING (low) WHERE regexp_matches(low, '\p{L}{3}')
"""


def packing_limits(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of the packing by run, all of which must be 0, and the documents packed.

    Containers over a limit, items split that would fit, items with a gap or an overlap.
    """
    runs = packing.capacities(spark, folder)
    packed = cut(packing.packed(spark, folder), "packed")
    capacity = spark.createDataFrame(runs, "run_id int, capacity int")
    packed = packed.join(F.broadcast(capacity), "run_id")  # at most 1,000 runs
    most = F.greatest(F.lit(8), F.floor(F.col("capacity") / packing.SEGMENTS_PER))
    bins = packed.groupBy("run_id", "capacity", "container").agg(F.sum("tokens").alias("t"), F.sum("loss_tokens").alias("l"), F.count("*").alias("n"))
    over = bins.groupBy("run_id").agg(F.count_if(F.col("t") > F.col("capacity")).alias("over_tokens"), F.count_if(F.col("n") > most).alias("over_segments"), F.count_if((F.col("l") > F.col("capacity") * packing.BEARING) & (F.col("n") > 1)).alias("over_loss"))
    items = packed.groupBy("run_id", "capacity", "doc_id").agg(F.sum("tokens").alias("t"), F.max(F.col("first_token") + F.col("tokens")).alias("end"), F.min("first_token").alias("start"), F.count("*").alias("n"))
    kept = items.groupBy("run_id").agg(F.count("*").alias("documents"), F.count_if((F.col("n") > 1) & (F.col("t") <= F.col("capacity"))).alias("split"), F.count_if((F.col("start") != 0) | (F.col("end") != F.col("t"))).alias("gaps"))
    return kept.join(over, "run_id").select("run_id", "documents", "split", "gaps", "over_tokens", "over_segments", "over_loss")


LIMITS_SQL = """
SELECT run_id, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS documents, 0 AS split, 0 AS gaps, 0 AS over_tokens, 0 AS over_segments, 0 AS over_loss FROM pack_capacity WHERE capacity_tokens > 0
"""


def mixture_limits(spark: SparkSession, folder: str) -> DataFrame:
    """(source, target_share, over, unknown) by target: documents repeated more often than allowed, and chosen ones that aren't the source's; both must be 0."""
    chosen = cut(mixing.chosen(spark, folder), "chosen")
    targets = spark.read.parquet(f"{folder}/mix_target.parquet").select("source", "target_share", "max_repeats")
    real = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", F.col("source").alias("of"))
    joined = chosen.join(real, "doc_id", "left").join(targets.select("source", "max_repeats"), "source", "left")
    faults = joined.groupBy("source").agg(F.count_if(F.col("repeats") > F.col("max_repeats")).alias("over"), F.count_if(~F.col("of").eqNullSafe(F.col("source"))).alias("unknown"))
    none = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return targets.join(faults, "source", "left").select("source", "target_share", none("over"), none("unknown"))


MIXTURE_SQL = "SELECT source, target_share, 0 AS over, 0 AS unknown FROM mix_target"


def last_ends(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, last_end, ends_in_blank): every text with a visible character ends with a sentence, and none ends in white space."""
    ends = sentences.found(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    at = F.substring("text", F.col("end_pos").cast("int"), F.lit(1))
    rows = ends.join(docs, "doc_id").select("doc_id", "end_pos", at.rlike(r"[\s\p{Z}]").alias("blank"))
    return rows.groupBy("doc_id").agg(F.max("end_pos").alias("last_end"), F.count_if("blank").alias("ends_in_blank"))


LAST_SQL = r"""
SELECT doc_id, length(regexp_replace(text, '[\s\x0B\p{Z}]+$', '')) AS last_end, 0 AS ends_in_blank FROM documents WHERE regexp_matches(text, '[^\s\x0B\p{Z}]')
"""


def greek(spark: SparkSession, folder: str) -> DataFrame:
    """Of the languages found those of texts in Greek letters alone with six words in a row: (item_id, lang)."""
    items = once_per_key(spark.read.parquet(f"{folder}/audit_item.parquet").select("item_id", "text"), "item_id")
    only = items.where(F.col("text").rlike(r"(?:\p{IsGreek}{2,} ){5}\p{IsGreek}{2,}") & ~F.col("text").rlike(r"[\p{IsLatin}\p{IsCyrillic}]") & (F.length("text") >= 15)).select("item_id")
    return language_mix.found(spark, folder).join(only, "item_id")


GREEK_SQL = r"""
WITH i AS (SELECT DISTINCT item_id, expected, text FROM audit_item) SELECT item_id, 'el' AS lang FROM i
WHERE regexp_matches(text, '(?:\p{Greek}{2,} ){5}\p{Greek}{2,}') AND NOT regexp_matches(text, '[\p{Latin}\p{Cyrillic}]') AND length(text) >= 15
AND coalesce(lower(regexp_extract(trim(expected, ' '), '^([A-Za-z]{2,3})(?:$|[-_])', 1)), '') NOT IN ('el', 'ell', 'gre')
"""

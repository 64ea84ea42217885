"""Resolvers: the first source that has a value wins, and how it was found is kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treille.functions.keys import common_prefix


def first_by_priority(candidates: list[tuple[str, Column]], value: str = "value", label: str = "source") -> list[Column]:
    """(value, label) columns of the first non-null candidate; label is null where none has a value."""
    named = [F.when(c.isNotNull(), F.lit(name)) for name, c in candidates]
    return [F.coalesce(*[c for _, c in candidates]).alias(value), F.coalesce(*named).alias(label)]


def longest_prefix(left: DataFrame, key: str, prefixes: DataFrame, prefix: str, end: str = "-") -> DataFrame:
    """Each left row with the longest prefix that is followed by ``end``, or null.

    The prefixes of a key are taken at its separators and joined by equality, so the
    join is a hash join and not a comparison of all pairs.
    """
    parts = F.split(F.col(key), end)
    cuts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), end))
    asked = left.select(key, F.explode(F.when(F.size(parts) > 1, cuts).otherwise(F.array().cast("array<string>"))).alias("_p")).distinct()
    hit = asked.join(prefixes.select(F.col(prefix).alias("_p")).distinct(), "_p").groupBy(key).agg(F.max_by("_p", F.length("_p")).alias(prefix))
    return left.join(hit, key, "left")


def preceding(events: DataFrame, by: list[str], order: list[str], anchor: Column, name: str) -> DataFrame:
    """As-of: each row with the last anchor value at or before it in its group."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn(name, F.last(anchor, ignorenulls=True).over(w))


def contains_unique(left: DataFrame, key: str, names: DataFrame, name: str, least: int = 6) -> DataFrame:
    """Exact matches, else the one name that begins or ends the key at a separator; two such names are none."""
    exact = left.join(names.select(F.col(name)).distinct(), F.col(key) == F.col(name), "left")
    rest = exact.where(F.col(name).isNull()).drop(name)
    parts = F.split(F.col(key), "-")
    n = F.size(parts)
    spans = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda m: F.array_join(F.slice(parts, i, m), "-"))))
    asked = rest.select(key, F.explode(F.array_distinct(spans)).alias("_s")).where(F.length("_s") >= least).distinct()
    hits = asked.join(names.select(F.col(name).alias("_s")).distinct(), "_s").groupBy(key).agg(F.count("*").alias("_n"), F.min("_s").alias(name))
    found = rest.join(hits.where("_n = 1").drop("_n"), key, "left")
    return exact.where(F.col(name).isNotNull()).unionByName(found)


def fill_empty(left: DataFrame, side: DataFrame, key: str, columns: list[str], full: Column) -> DataFrame:
    """Sidecar merge: rows where ``full`` holds take the side's values first, the others only fill what is null or empty."""
    side = side.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    joined = left.join(side, key, "left")

    def merged(c: str) -> Column:
        kind = dict(left.dtypes)[c]
        empty = F.size(c) < 1 if kind.startswith("array") else F.trim(F.col(c)) == "" if kind == "string" else F.lit(False)
        own = F.when(~F.coalesce(empty, F.lit(True)), F.col(c))
        return F.when(full, F.coalesce(F.col(f"_{c}"), F.col(c))).otherwise(F.coalesce(own, F.col(f"_{c}"), F.col(c)))

    return joined.select(*[merged(c).alias(c) if c in columns else F.col(c) for c in left.columns])


def context_vote(mentions: DataFrame, doc: str, name: str, places: DataFrame, group: str, code: str, full: str | None = None) -> DataFrame:
    """Ambiguous names by context: names of one place vote for its group; others prefer the group with most votes.

    Ties go to the place whose full name (column ``full``) shares the longest beginning with
    the mention, then to the least code. ``places`` has (name, group, code, full). Gives (doc,
    name, group, code, certain). A mention meets only the groups its document votes for; one
    without any of them takes what is best for its name anywhere, found once a name.
    """
    near = -common_prefix(F.lower(F.col(full)), F.lower(F.col(name))) if full else F.lit(0)
    kept = places.select(name, group, code, near.alias("_near"))
    if not full:
        kept = kept.groupBy(name, group).agg(F.min(code).alias(code), F.lit(0).alias("_near"))
    choice = F.struct(group, code)
    default = kept.groupBy(name).agg(F.min_by(choice, F.struct("_near", code)).alias("_default"))
    default = default.join(places.groupBy(name).agg(F.count("*").alias("_n")), name)
    known = mentions.select(doc, name).distinct().join(default, name)
    votes = known.where("_n = 1").groupBy(doc, F.col("_default")[group].alias(group)).agg(F.count("*").alias("_votes"))
    voted = known.where("_n > 1").select(doc, name).join(votes, doc).join(kept, [name, group])
    voted = voted.groupBy(doc, name).agg(F.min_by(choice, F.struct((-F.col("_votes")).alias("v"), "_near", code)).alias("_voted"))
    best = known.join(voted, [doc, name], "left").withColumn("_b", F.coalesce("_voted", "_default"))
    return best.select(doc, name, F.col("_b")[group].alias(group), F.col("_b")[code].alias(code), (F.col("_n") == 1).alias("certain"))


def majority(votes: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, votes): the label with most votes; keys whose lead is shared have none."""
    counts = votes.groupBy(key, label).agg(F.count("*").alias("votes"))
    top = counts.groupBy(key).agg(F.max("votes").alias("_top"))
    best = counts.join(top, key).where("votes = _top").groupBy(key).agg(F.count("*").alias("_n"), F.min(label).alias(label), F.max("votes").alias("votes"))
    return best.where("_n = 1").drop("_n")


def staged(left: DataFrame, keys: list[tuple[str, Column, DataFrame, str, str]], id_: str, value: str) -> DataFrame:
    """Match stage after stage; later stages see only what earlier ones left. Stages are (label, key, table, table key, table value)."""
    found, rest = [], left
    for label, key, table, table_key, table_value in keys:
        side = table.groupBy(F.col(table_key).alias("_k")).agg(F.min(table_value).alias(value))
        hit = rest.withColumn("_k", key).join(side, "_k").select(*left.columns, value, F.lit(label).alias("method"))
        found.append(hit)
        rest = rest.join(hit.select(id_), id_, "left_anti")
    none = rest.select(*left.columns, F.lit(None).cast(dict(found[0].dtypes)[value]).alias(value), F.lit("none").alias("method"))
    return reduce(DataFrame.unionByName, [*found, none])


def aliases(name: Column, normal) -> Column:
    """Keys a name is known by: the whole, and its parts between ``ou``, ``et``, ``or``, commas and slashes; ``normal`` makes a key."""
    parts = F.split(F.lower(name), r"\s+(?:ou|et|or|and|o|e|oder|und)\s+|\s*[,/]\s*")
    return F.array_distinct(F.filter(F.concat(F.array(normal(name)), F.transform(parts, normal)), lambda k: k != ""))


def segment_of(targets: DataFrame, target: str, segments: DataFrame, doc: str, title: str, normal) -> DataFrame:
    """Each (doc, target) with the title of its segment: the only one, else one that shares an alias, else one that holds or is held by the other.

    ``targets`` has (doc, target), ``segments`` (doc, title). Ties go to the first title by
    code point. Targets of a document without a segment have null.
    """
    t = targets.select(doc, target).distinct()
    s = segments.select(doc, title).distinct()
    sizes = s.groupBy(doc).agg(F.count("*").alias("_n"), F.min(title).alias("_only"))
    by_alias = t.select(doc, target, F.explode(aliases(F.col(target), normal)).alias("_k")).join(s.select(doc, title, F.explode(aliases(F.col(title), normal)).alias("_k")), [doc, "_k"])
    by_alias = by_alias.groupBy(doc, target).agg(F.min(title).alias("_alias"))
    held = t.withColumn("_a", normal(F.col(target))).join(s.withColumn("_b", normal(F.col(title))), doc).where((F.length("_a") > 0) & (F.length("_b") > 0) & (F.col("_a").contains(F.col("_b")) | F.col("_b").contains(F.col("_a"))))
    held = held.groupBy(doc, target).agg(F.min(title).alias("_held"))
    joined = t.join(sizes, doc, "left").join(by_alias, [doc, target], "left").join(held, [doc, target], "left")
    found = F.coalesce(F.when(F.col("_n") == 1, F.col("_only")), F.col("_alias"), F.col("_held"))
    how = F.when(F.col("_n") == 1, "only").when(F.col("_alias").isNotNull(), "alias").when(F.col("_held").isNotNull(), "held")
    return joined.select(doc, target, found.alias(title), how.alias("how"))


def best_covered(candidates: DataFrame, key: str, hint: str, options: DataFrame, option: str, members: str) -> DataFrame:
    """(key, option or options, how): of several options of a key the one most of whose members the hint holds, then the one with most of them.

    ``candidates`` has (key, hint array), ``options`` (key, option, members array). A key
    with one option takes it; where no member is hinted, all options are taken (``union``).
    """
    joined = candidates.select(key, hint).join(options.select(key, option, F.array_distinct(members).alias("_m")), key)
    shared = F.size(F.array_intersect("_m", F.coalesce(hint, F.array().cast(dict(candidates.dtypes)[hint]))))
    scored = joined.withColumn("_s", shared).withColumn("_c", F.when(F.size("_m") > 0, F.col("_s") / F.size("_m")).otherwise(0.0))
    got = scored.groupBy(key).agg(F.count("*").alias("_n"), F.max("_s").alias("_top"), F.array_sort(F.collect_set(option)).alias("_all"), F.max_by(option, F.struct("_c", "_s", option)).alias("_best"))
    how = F.when(F.col("_n") == 1, "only").when(F.col("_top") > 0, "covered").otherwise("union")
    return got.select(key, F.when((F.col("_n") == 1) | (F.col("_top") > 0), F.array("_best")).otherwise(F.col("_all")).alias("options"), how.alias("how"))


def most_specific(parsed: DataFrame, key: str, levels: list[tuple[str, str, DataFrame, str, str]]) -> DataFrame:
    """(key, level, code): the codes of the first level that names anything; lower levels are not looked at.

    ``levels`` are (label, column of names (array), table, name column, code column), the
    most specific one first. A level whose names are all unknown still counts as the level.
    """
    said = F.coalesce(*[F.when(F.size(F.col(c)) > 0, F.lit(label)) for label, c, *_ in levels])
    rows = parsed.withColumn("level", said)
    found = []
    for label, column, table, name, code in levels:
        asked = rows.where(F.col("level") == label).select(key, "level", F.explode(F.array_distinct(column)).alias("_name"))
        found.append(asked.join(table.select(F.col(name).alias("_name"), F.col(code).alias("code")).distinct(), "_name").select(key, "level", "code"))
    return reduce(DataFrame.unionByName, found).distinct()


def all_but(parsed: DataFrame, key: str, wanted: list[tuple[str, DataFrame, str, str]], unwanted: str, places: DataFrame, name: str, code: str) -> DataFrame:
    """(key, code): the union of all wanted names' codes without those of the excluded names.

    ``wanted`` are (column of names, table, name column, code column) for areas of any
    size; ``unwanted`` is a column of names of ``places``.
    """
    got = [parsed.select(key, F.explode(c).alias("_name")).join(t.select(F.col(n).alias("_name"), F.col(k).alias("code")), "_name").select(key, "code") for c, t, n, k in wanted]
    out = parsed.select(key, F.explode(unwanted).alias("_name")).join(places.select(F.col(name).alias("_name"), F.col(code).alias("code")), "_name").select(key, "code")
    return reduce(DataFrame.unionByName, got).distinct().join(out, [key, "code"], "left_anti")


def chain(records: DataFrame, key: str, steps: list[tuple[str, DataFrame, bool]]) -> DataFrame:
    """Steps of a geometry or value chain: (key, value, step). Each step is (label, table (key, value), final).

    The first step that knows the key decides; a ``final`` step that knows it without a
    value ends the chain there, unlike one that is not final, behind which the next is asked.
    """
    rows = records.select(key).distinct()
    for n, (_, table, _) in enumerate(steps):
        side = table.groupBy(F.col(key)).agg(F.min("value").alias(f"_v{n}"), F.lit(True).alias(f"_k{n}"))
        rows = rows.join(side, key, "left")
    value, step = F.lit(None), F.lit("none")
    for n, (label, _, final) in reversed(list(enumerate(steps))):
        here = F.coalesce(F.col(f"_k{n}"), F.lit(False)) & (F.lit(final) | F.col(f"_v{n}").isNotNull())
        value, step = F.when(here, F.col(f"_v{n}")).otherwise(value), F.when(here, F.lit(label)).otherwise(step)
    return rows.select(key, value.alias("value"), F.when(value.isNull(), F.when(step == "none", "none").otherwise(F.concat(step, F.lit(":empty")))).otherwise(step).alias("step"))


def bounded_fuzzy(left: DataFrame, key: str, name: str, within: str, right: DataFrame, other: str, score, least: float) -> DataFrame:
    """(key, other, score): the best right names of the same ``within`` with a score of ``least`` or more; ties all stand.

    ``score`` makes a column of (left name, right name). Only rows that share ``within`` meet.
    """
    pairs = left.select(key, within, name).join(right.select(within, other).distinct(), within).select(key, name, other).distinct()
    scored = pairs.withColumn("score", score(F.col(name), F.col(other))).where(F.col("score") >= least)
    top = scored.groupBy(key).agg(F.max("score").alias("_top"))
    return scored.join(top, key).where("score = _top").select(key, other, "score")

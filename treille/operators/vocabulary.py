"""Entity resolution against a vocabulary: staged matching with a dead letter, synonyms, titles, search over aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treille.functions import keys
from treille.functions.similarity import shortened, token_sort_ratio
from treille.operators.grammar import colour_code


def _candidates(asked: DataFrame, surfaces: DataFrame, edits: int) -> DataFrame:
    """Pairs (k, surface) that share a form after ``edits`` deletions: all within that many edits, found by an equi-join."""
    left = asked.select("k", F.explode(shortened("k", F.lit(edits))).alias("x"))
    right = surfaces.select("surface", F.explode(shortened("surface", F.lit(edits))).alias("x"))
    return left.join(right.hint("merge"), "x").select("k", "surface").distinct()


def match_variety(tokens: DataFrame, token: str, vocabulary: DataFrame, ambient: Column | None = None, default: str = "none", least: float = 0.85, edits: int = 2) -> DataFrame:
    """(token, slug, how, colour, guess) for each distinct token.

    ``vocabulary`` has (surface, slug), surfaces as keys.transliterated makes them, one slug
    each. Stages: exact, without the colour code, a part of a hyphened name, the likeliest
    surface within ``edits`` edits whose sorted words agree by ``least`` (below 0.95 only with
    the same first letter). The colour is the token's own code, else ``ambient``, else
    ``default``. What no stage matches has no slug and, as ``guess``, its nearest surface.
    """
    extra = ambient if ambient is not None else F.lit(None).cast("string")
    rows = tokens.select(F.col(token), extra.alias("_amb")).where(F.trim(F.col(token)) != "").distinct()
    name, colour = colour_code(F.col(token))
    rows = rows.select(token, "_amb", name.alias("_bare"), colour.alias("_colour"))
    rows = rows.select(token, F.coalesce("_colour", "_amb", F.lit(default)).alias("colour"), keys.transliterated(F.col(token)).alias("k0"), keys.transliterated(F.col("_bare")).alias("k1"), F.transform(F.split("_bare", "-"), keys.transliterated).alias("pieces"))
    surfaces = vocabulary.select("surface", "slug").where("surface <> ''").dropDuplicates(["surface"])

    def exact(key: str, label: str) -> DataFrame:
        return surfaces.select(F.col("surface").alias(key), F.col("slug").alias(label))

    staged = rows.join(exact("k0", "s0"), "k0", "left").join(exact("k1", "s1"), "k1", "left")
    open_ = staged.where("s0 is null and s1 is null")
    piece = open_.where(F.size("pieces") > 1).select(token, "colour", F.posexplode("pieces").alias("i", "k")).where(F.length("k") > 3).join(surfaces.withColumnRenamed("surface", "k"), "k")
    piece = piece.groupBy(token, "colour").agg(F.min_by("slug", "i").alias("s2"))
    near = _candidates(open_.select(F.col("k1").alias("k")).where("k <> ''").distinct(), surfaces, edits)
    near = near.withColumn("score", token_sort_ratio(F.col("k"), F.col("surface"))).join(surfaces, "surface")
    best = near.groupBy("k").agg(F.max_by(F.struct("surface", "slug", "score"), F.struct("score", (-F.length("surface")).alias("x"), "surface")).alias("b"))
    sane = (F.col("b.score") >= 0.95) | (F.substring("k1", 1, 1) == F.substring("b.surface", 1, 1))
    out = staged.join(piece, [token, "colour"], "left").join(best.withColumnRenamed("k", "k1"), "k1", "left")
    s3 = F.when((F.col("b.score") >= least) & sane, F.col("b.slug"))
    how = F.when(F.col("s0").isNotNull(), "exact").when(F.col("s1").isNotNull(), "colour").when(F.col("s2").isNotNull(), "part").when(s3.isNotNull(), "fuzzy").otherwise("none")
    slug = F.coalesce("s0", "s1", "s2", s3)
    return out.select(token, slug.alias("slug"), how.alias("how"), "colour", F.when(slug.isNull(), F.col("b.surface")).alias("guess"))


def dead_letter(entries: DataFrame, doc: str, token: str, matched: DataFrame) -> DataFrame:
    """(doc, token, guess): the tokens no stage matched, once a document, for a reader to decide; sort by both for the queue's order."""
    return entries.select(doc, token).distinct().join(matched.where("slug is null").select(token, "guess").distinct(), token).select(doc, token, "guess")


def synonym_map(entries: DataFrame, slug: str, names: list[tuple[DataFrame, str, str]]) -> tuple[DataFrame, DataFrame]:
    """((term, slug), clashes(term, slugs)): the names of every entry; a term that two entries claim is a clash and maps to none.

    ``names`` are tables (table, slug column, name column); the entry's own slug is a name too.
    """
    rows = entries.select(F.col(slug).alias("slug"), F.col(slug).cast("string").alias("t"))
    for table, key, name in names:
        rows = rows.unionByName(table.select(F.col(key).alias("slug"), F.col(name).alias("t")))
    rows = rows.select("slug", keys.search_key(F.trim("t")).alias("term")).where("term <> ''").distinct()
    by = rows.groupBy("term").agg(F.count("*").alias("n"), F.min("slug").alias("slug"))
    clashes = rows.join(by.where("n > 1").select("term"), "term").groupBy("term").agg(F.sort_array(F.collect_set("slug")).alias("slugs"))
    return by.where("n = 1").select("term", "slug"), clashes


def canonical(values: DataFrame, value: str, terms: DataFrame) -> DataFrame:
    """``values`` with ``canonical``: the entry a value stands for, null for none."""
    return values.withColumn("_t", keys.search_key(F.trim(F.col(value)))).join(terms.select(F.col("term").alias("_t"), F.col("slug").alias("canonical")), "_t", "left").drop("_t")


def canonical_list(values: Column, table: dict[str, str], assumed: list[str] = ()) -> Column:
    """Values under their canonical name in the order given, each once, without those that go without saying."""
    to = F.create_map(*[F.lit(x) for kv in table.items() for x in kv]) if table else F.create_map().cast("map<string,string>")
    mapped = F.transform(values, lambda v: F.coalesce(F.try_element_at(to, F.lower(v)), F.lower(v)))
    return F.array_distinct(F.filter(mapped, lambda v: v.isNotNull() & ~v.isin(list(assumed)) if assumed else v.isNotNull()))


def title_matches(title: Column, slug: Column, labels: list[str], colours: list[str]) -> Column:
    """Whether a title names a slug: equal words, labels aside; colour words that only the slug has don't matter where the title has none."""
    words = lambda c: F.array_distinct(F.filter(F.split(keys.slugify(c), "-"), lambda w: ~w.isin(labels) & (w != "")))
    t, s = words(title), words(slug)
    coloured = F.arrays_overlap(t, F.array(*[F.lit(c) for c in colours]))
    bare = F.filter(s, lambda w: ~w.isin(colours))
    same = lambda a, b: (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)
    return (F.size(t) > 0) & (same(t, s) | (~coloured & same(t, bare)))


def flagged_surface(name: Column, slug: Column, terms: list[str]) -> Column:
    """What is wrong with a harvested name: ``style`` (a term of another kind), ``artifact`` (layout or prose), ``truncated`` (fewer words than its slug), or null."""
    words = F.size(F.split(F.trim(name), r"\s+"))
    prose = name.rlike(r"\S {3,}\S|[.;:!?]\s|[()\[\]]$") | (F.length(name) > 40) | (words > 5)
    return F.when(F.lower(F.trim(name)).isin(terms), "style").when(prose, "artifact").when(words < F.size(F.split(slug, "-")), "truncated")


def search_index(entries: DataFrame, slug: str, label: str, names: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """(slug, label, aliases array): one row per entry with the names of all tables (table, slug column, name column) in their order, each once, without the label."""
    rows = None
    for i, (table, key, name) in enumerate(names):
        part = table.select(F.col(key).alias(slug), F.lit(i).alias("_i"), F.col(name).alias("_n")).where("_n is not null")
        rows = part if rows is None else rows.unionByName(part)
    first = rows.groupBy(slug, "_n").agg(F.min("_i").alias("_i"))
    got = first.groupBy(slug).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_n"))), lambda x: x["_n"]).alias("_a"))
    joined = entries.select(slug, label).join(got, slug, "left")
    return joined.select(slug, label, F.array_remove(F.coalesce("_a", F.array().cast("array<string>")), F.col(label)).alias("aliases"))


def suggestions(entries: DataFrame, slug: str, label: str, aliases: DataFrame, alias: str, counts: DataFrame, query: str, k: int) -> DataFrame:
    """(slug, label, score, alias, n): the best ``k`` entries for a query.

    100 where the label begins with it, 80 where it holds it, 60 where an alias begins with
    it, 40 where an alias holds it; then by ``counts`` (slug, n). Entries without count are
    hidden; the first alias of the best kind is told where an alias was what fitted.
    ``aliases`` has a row (slug, alias) for each, so that an entry may have any number.
    """
    asked = query.lower()

    def kind(name: Column, begins: int, holds: int) -> Column:
        low = keys.search_key(name)
        return F.when(low.startswith(asked), begins).when(low.contains(asked), holds).otherwise(0)

    by_alias = aliases.select(slug, F.col(alias).alias("_a"), kind(F.col(alias), 60, 40).alias("_s")).where("_s > 0")
    by_alias = by_alias.groupBy(slug).agg(F.min_by(F.struct("_a", "_s"), F.struct((-F.col("_s")).alias("x"), "_a")).alias("_b"))
    rows = entries.select(slug, label, kind(F.col(label), 100, 80).alias("_l")).join(by_alias, slug, "left")
    score = F.when(F.col("_l") > 0, F.col("_l")).otherwise(F.coalesce("_b._s", F.lit(0)))
    rows = rows.select(slug, label, score.alias("score"), F.when(F.col("_l") == 0, F.col("_b._a")).alias("alias")).where("score > 0")
    return rows.join(counts.select(slug, "n").where("n > 0"), slug).orderBy(F.desc("score"), F.desc("n"), slug).limit(k)


def merged_counts(records: DataFrame, key: str, member: str, to: DataFrame) -> DataFrame:
    """(canonical, n): records by canonical entry, a record with several members of one entry once. ``to`` has (member, canonical); members outside it stand for themselves."""
    rows = records.select(key, F.col(member).alias("_m")).where("_m is not null").join(to.select(F.col("member").alias("_m"), "canonical"), "_m", "left")
    return rows.select(key, F.coalesce("canonical", "_m").alias("canonical")).distinct().groupBy("canonical").agg(F.count("*").alias("n"))


def expanded(chosen: DataFrame, value: str, to: DataFrame) -> DataFrame:
    """The chosen values with all others of their canonical entries. ``to`` has (member, canonical)."""
    hit = chosen.select(F.col(value).alias("member")).join(to, "member").select("canonical").distinct()
    return chosen.select(F.col(value)).union(to.join(hit, "canonical").select("member")).distinct()

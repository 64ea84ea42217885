"""Grammars of documents: header chains, routing to roles, bundles, columns, lists of places, parcels and varieties."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from treille.operators.documents import lines


def left_column(text: Column, gutter: int = 2) -> Column:
    """The left column of a text in two columns: each line up to its first run of ``gutter`` blanks behind a word; lines with an empty left side are dropped."""
    kept = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, rf"(?<=\S)\s{{{gutter},}}\S.*$", ""))
    return F.array_join(F.filter(kept, lambda x: ~x.rlike(rf"^\s{{{gutter},}}\S") & (F.trim(x) != "")), "\n")


def header_chain(headers: DataFrame, key: str, order: str, number: str, title: str, nested: str | None = None) -> DataFrame:
    """Headers (key, order, number, title, top) that form the one chain 1, 2, 3...

    A top number counts where it follows the last one and its title doesn't begin like
    ``nested`` (a pattern of titles of inner lists); a number such as 4.2 counts where it
    belongs to the present top. ``top`` is the top number a header belongs to.
    """
    parts = F.split(F.col(number), r"\.")
    rows = headers.select(key, order, number, title, F.element_at(parts, 1).cast("int").alias("_t"), (F.size(parts) > 1).alias("_sub"), (F.col(title).rlike(nested) if nested else F.lit(False)).alias("_n"))
    got = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_t").alias("t"), F.col("_sub").alias("s"), F.col("_n").alias("n")))).alias("h"))
    kind = dict(headers.dtypes)[order]
    start = F.struct(F.lit(0).alias("last"), F.array().cast(f"array<struct<o:{kind},top:int>>").alias("taken"))

    def step(s: Column, x: Column) -> Column:
        opens = ~x["s"] & (x["t"] == s["last"] + 1) & ~x["n"]
        inner = x["s"] & (x["t"] == s["last"])
        top = F.when(opens, x["t"]).otherwise(s["last"])
        taken = F.concat(s["taken"], F.array(F.struct(x["o"].alias("o"), top.alias("top"))))
        return F.when(opens | inner, F.struct(top.alias("last"), taken.alias("taken"))).otherwise(s)

    chain = got.select(key, F.explode(F.aggregate("h", start, step)["taken"]).alias("_c")).select(key, F.col("_c.o").alias(order), F.col("_c.top").alias("top"))
    return chain.join(headers.select(key, order, number, title), [key, order])


def sections_between(df: DataFrame, key: str, text: str, headers: DataFrame, line_no: str) -> DataFrame:
    """(key, line_no of the header, body): the text from each given header line to the next."""
    rows = lines(df, key, text)
    heads = headers.select(key, F.col(line_no).alias("line_no"), F.lit(True).alias("_h"))
    w = Window.partitionBy(key).orderBy("line_no")
    rows = rows.join(heads, [key, "line_no"], "left").withColumn("_from", F.last(F.when(F.col("_h"), F.col("line_no")), True).over(w)).where("_from is not null")
    body = F.array_sort(F.collect_list(F.when(F.col("_h").isNull(), F.struct("line_no", "line"))))
    return rows.groupBy(key, "_from").agg(F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("body")).select(key, F.col("_from").alias(line_no), "body")


def last_of(sections: DataFrame, key: str, number: str, order: str) -> DataFrame:
    """Of sections with one number the last one (a document that repeats its articles means the last)."""
    others = [c for c in sections.columns if c not in (key, number)]
    best = sections.groupBy(key, number).agg(F.max_by(F.struct(*others), F.col(order)).alias("_b"))
    return best.select(key, number, *[F.col("_b")[c].alias(c) for c in others])


def routed(sections: DataFrame, key: str, title: str, order: str, keywords: list[tuple[str, str]], blocked: list[str] = (), places: dict[str, int] | None = None) -> DataFrame:
    """(key, role, order, how): a section for each role.

    ``keywords`` are (role, keyword in lower case) by priority: the first keyword of a role
    that stands in any title decides, then the section's place. Titles with a ``blocked``
    word are no candidates. A role without a hit falls back to the section at its place in
    ``places`` (counted from 1), if that section has no role yet.
    """
    low = F.lower(F.col(title))
    free = reduce(lambda a, b: a & ~low.contains(b), blocked, F.lit(True))
    hits = F.array(*[F.when(low.contains(word), F.struct(F.lit(role).alias("role"), F.lit(rank).alias("rank"))) for rank, (role, word) in enumerate(keywords)])
    rows = sections.select(key, title, order)
    by_word = rows.where(free).select(key, order, F.explode(F.array_compact(hits)).alias("h")).groupBy(key, F.col("h.role").alias("role")).agg(F.min_by(order, F.struct("h.rank", order)).alias(order)).withColumn("how", F.lit("keyword"))
    if not places:
        return by_word
    counted = rows.where(free).withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    table = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(at).alias("at")) for role, at in places.items()])
    asked = counted.select(key, order, "_i", F.explode(table).alias("p")).where("_i = p.at").select(key, F.col("p.role").alias("role"), order)
    spare = asked.join(by_word.select(key, "role"), [key, "role"], "left_anti").join(by_word.select(key, order), [key, order], "left_anti")
    return by_word.unionByName(spare.groupBy(key, order).agg(F.min("role").alias("role")).withColumn("how", F.lit("place")))


def absorbed(sections: DataFrame, key: str, order: str, title: str, body: str, parent: str, child: str, short: int = 800, least: int = 40) -> DataFrame:
    """Sections (key, order, title, body): what follows a short parent is merged into it.

    A section whose title matches ``parent`` and whose body is shorter than ``short`` takes in
    the sections directly behind it whose titles match ``child``, with their titles; where
    its own body has ``least`` characters or fewer only theirs is kept.
    """
    w = Window.partitionBy(key).orderBy(order)
    rows = sections.select(key, order, title, F.coalesce(body, F.lit("")).alias("_b"))
    opens = F.col(title).rlike(parent) & (F.length(F.trim("_b")) < short)
    # a run goes on over children; any other section closes it
    mark = F.when(opens, F.col(order)).when(~F.col(title).rlike(child), F.lit(-1).cast(dict(sections.dtypes)[order]))
    rows = rows.withColumn("_open", opens).withColumn("_run", F.last(mark, True).over(w))
    owner = F.when(~F.col("_open") & (F.col("_run") >= 0) & F.col(title).rlike(child), F.col("_run")).otherwise(F.col(order))
    rows = rows.withColumn("_o", owner)
    kids = F.array_sort(F.collect_list(F.when(F.col("_o") != F.col(order), F.struct(F.col(order).alias("o"), F.concat_ws("\n", title, "_b").alias("t")))))
    own = F.max(F.when(F.col("_o") == F.col(order), F.col("_b")))
    got = rows.groupBy(key, "_o").agg(F.max(F.when(F.col("_o") == F.col(order), F.col(title))).alias(title), own.alias("_own"), kids.alias("_k"))
    text = F.concat_ws("\n", F.when((F.size("_k") == 0) | (F.length(F.trim("_own")) > least), F.col("_own")), F.when(F.size("_k") > 0, F.array_join(F.transform("_k", lambda x: x["t"]), "\n")))
    return got.select(key, F.col("_o").alias(order), title, text.alias(body), F.size("_k").alias("merged"))


def bundle(df: DataFrame, key: str, text: str, names: DataFrame, name: str, often: int = 3) -> DataFrame:
    """(key, name, first_line, body): a bundle cut at the lines that hold a name alone.

    A name that stands on ``often`` lines or more (in headers, too) starts at the first, any
    other at the last (behind a table of contents). ``names`` has (key, name).
    """
    rows = lines(df, key, text)
    told = rows.withColumn("_l", F.lower(F.trim("line"))).join(names.select(key, F.col(name), F.lower(F.trim(name)).alias("_l")).distinct(), [key, "_l"])
    starts = told.groupBy(key, name).agg(F.when(F.count("*") >= often, F.min("line_no")).otherwise(F.max("line_no")).alias("first_line"))
    heads = starts.groupBy(key, "first_line").agg(F.min(name).alias(name))
    bodies = sections_between(df, key, text, heads, "first_line")
    return heads.join(bodies, [key, "first_line"]).select(key, name, "first_line", "body")


def legal_references(text: Column, most: int | None = None) -> Column:
    """struct<decree, journal, date_text> of the references a header names; ``most`` bounds how far the header goes, null the whole text."""
    head = text if most is None else F.substring(text, 1, most)
    at = lambda pattern: F.nullif(F.regexp_extract(head, pattern, 1), F.lit(""))
    return F.struct(
        at(r"(?i)(?:décret|decreto|verordnung|regulation)\s+n[°ºo.]?\s*([\d\-/]+)").alias("decree"), at(r"(?i)\b(?:JORF|OJ|GU|BOE|Amtsblatt)\b[^\n]*?(\d{1,2}[./]\d{1,2}[./]\d{4})").alias("journal"),
        at(r"(?i)\b(?:du|del|vom|of)\s+(\d{1,2}(?:er)?\.?\s+\p{L}+\s+\d{4})").alias("date_text"),
    )


def places_by_area(df: DataFrame, key: str, text: str, area: str, split) -> DataFrame:
    """(key, area, places array): lists behind the name of an area and a colon, as in ``Department of X: A, B``.

    ``area`` is a pattern with the area's name as its group; ``split`` makes an array of names.
    """
    whole = F.col(text)
    found = df.where(whole.isNotNull()).select(key, F.explode(F.regexp_extract_all(whole, F.lit(rf"(?i){area}\s*:\s*([^:]*?)(?=(?:{area}\s*:)|$)"), F.lit(0))).alias("_m"))
    name = F.regexp_extract("_m", rf"(?i)^{area}\s*:", 1)
    listed = F.regexp_replace("_m", r"(?s)^[^:]*:\s*", "")
    return found.groupBy(key, name.alias("area")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(split(listed))))).alias("places"))


def place_token(t: Column, stop: list[str]) -> Column:
    """Whether a token can be a place: a capital first, at most five words and 40 letters, no stop word alone and no digit."""
    return t.rlike(r"(?U)^\p{Lu}") & (F.length(t) <= 40) & (F.size(F.split(F.trim(t), r"\s+")) <= 5) & ~t.rlike(r"\d") & ~F.lower(t).isin(stop)


def sub_areas(df: DataFrame, key: str, text: str, patterns: list[tuple[str, str]], least: int = 2) -> DataFrame:
    """(key, name, pattern): names that a layout pattern gives; a pattern counts only where it gives ``least`` names or more, and the first such pattern is taken.

    ``patterns`` are (label, pattern for a line with the name as its group).
    """
    rows = lines(df, key, text)
    hits = F.array(*[F.when(F.col("line").rlike(p), F.struct(F.lit(i).alias("i"), F.lit(label).alias("pattern"), F.trim(F.regexp_extract("line", p, 1)).alias("name"))) for i, (label, p) in enumerate(patterns)])
    found = rows.select(key, F.explode(F.array_compact(hits)).alias("h")).select(key, "h.i", "h.pattern", "h.name").where("name <> ''").distinct()
    counts = found.groupBy(key, "i").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).groupBy(key).agg(F.min("i").alias("i"))
    return found.join(counts, [key, "i"]).select(key, "name", "pattern")


def parcels(df: DataFrame, key: str, text: str, anchor: str, parcel: str, numbers) -> DataFrame:
    """(key, anchor, numbers array): parcel numbers under the anchor named last before them.

    ``anchor`` and ``parcel`` are patterns with a group, for the place and for its list of
    numbers; ``numbers`` makes an array of whole numbers. Lists before any anchor have none (null).
    """
    rows = df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(f"(?:{anchor})|(?:{parcel})"), F.lit(0))).alias("_p", "_m"))
    named = F.nullif(F.trim(F.regexp_extract("_m", anchor, 1)), F.lit(""))
    w = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("anchor", F.last(named, True).over(w)).where(named.isNull())
    listed = numbers(F.regexp_extract("_m", parcel, 1))
    return rows.groupBy(key, "anchor").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(listed)))).alias("numbers"))


# Colour codes behind a variety's name, Latin and Greek capitals that look alike.
COLOUR_CODES = {"B": "white", "N": "black", "G": "grey", "Rs": "pink", "Rg": "red", "Β": "white", "Ν": "black", "Ε": "pink"}


def colour_code(token: Column) -> list[Column]:
    """(name, colour): a token without the colour code at its end, and what the code stands for."""
    codes = "|".join(sorted(COLOUR_CODES, key=lambda x: -len(x)))
    table = F.create_map(*[F.lit(x) for kv in COLOUR_CODES.items() for x in kv])
    code = F.regexp_extract(token, rf"\S\s+({codes})\.?$", 1)
    return [F.trim(F.regexp_replace(token, rf"(?<=\S)\s+(?:{codes})\.?$", "")).alias("name"), F.when(code != "", F.try_element_at(table, code)).alias("colour")]


def varieties(df: DataFrame, key: str, text: str, roles: list[tuple[str, str]]) -> DataFrame:
    """(key, role, pos, name, synonyms array, colour): varieties of a text by role.

    ``roles`` are (role, pattern of the words that begin its part); text before the first
    such words is ``principal``. Lines that go on in small letters are joined; names stand
    between commas, semicolons, bullets and line ends; synonyms in brackets or behind ``o``,
    ``ou``, ``=`` belong to the name before.
    """
    flat = F.regexp_replace(F.regexp_replace(F.col(text), r"(?U)(?<=\p{Ll})-\n\s*(?=\p{Ll})", ""), r"(?U)\n\s*(?=\p{Ll})", " ")
    marks = "|".join(f"(?:{p})" for _, p in roles)
    parts = F.split(F.regexp_replace(flat, f"(?iu)({marks})", "\u0001$1"), "\u0001")
    chunk = df.where(F.col(text).isNotNull()).select(key, F.posexplode(parts).alias("_c", "_t"))
    role = reduce(lambda acc, r: F.when(F.col("_t").rlike(f"(?iu)^(?:{r[1]})"), r[0]).otherwise(acc), reversed(roles), F.lit("principal"))
    body = F.regexp_replace("_t", f"(?iu)^(?:{marks})[^:\n]{{0,80}}:?", "")
    masked = F.regexp_replace(body, r"[,;](?=[^()]*\))", "\u0002")
    rows = chunk.select(key, "_c", role.alias("role"), F.posexplode(F.split(masked, r"[,;\n•]|(?<=\s)[–-](?=\s)|\s+(?:et|y|e|und)\s+")).alias("_p", "_n"))
    token = F.trim(F.regexp_replace(F.regexp_replace("_n", "\u0002", ","), r"^[\s.:–-]+|[\s.:]+$", ""))
    rows = rows.select(key, "role", "_c", "_p", token.alias("_n")).where("_n rlike '(?U)\\\\p{L}{2}'")
    inner = F.regexp_extract("_n", r"\(([^()]*)\)", 1)
    bare = F.trim(F.regexp_replace("_n", r"\s*\([^()]*\)", ""))
    names = F.split(bare, r"\s+(?:o|ou|oder)\s+|\s*=\s*")
    rows = rows.withColumns({"_first": F.trim(names[0]), "_more": F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(1)))})
    more = F.concat(F.when(F.size(names) > 1, F.col("_more")).otherwise(F.array().cast("array<string>")), F.split(inner, r"\s*[,;]\s*"))
    name, colour = colour_code(F.col("_first"))
    out = rows.select(key, "role", F.struct("_c", "_p").alias("_at"), name, F.filter(F.transform(more, lambda x: F.trim(x)), lambda x: x != "").alias("synonyms"), colour).where("name <> ''")
    pos = F.row_number().over(Window.partitionBy(key).orderBy("_at"))
    return out.withColumn("pos", pos).select(key, "role", "pos", "name", "synonyms", "colour")


def best_template(found: list[tuple[str, DataFrame]], key: str, first: str | None = None) -> DataFrame:
    """(key, template, n): the template whose parse has most rows; ``first``, where it has any, wins at once, ties go to the order given."""
    counts = [df.groupBy(key).agg(F.count("*").alias("n")).withColumns({"template": F.lit(label), "_i": F.lit(-i), "_f": F.lit(int(label == first))}) for i, (label, df) in enumerate(found)]
    best = F.max_by(F.struct("template", "n"), F.struct("_f", "n", "_i"))
    return reduce(DataFrame.unionByName, counts).groupBy(key).agg(best.alias("b")).select(key, "b.template", "b.n")


def passport(df: DataFrame, key: str, cells: str) -> DataFrame:
    """(key, fields map): tables of two columns, label and value; of equal labels the first counts."""
    rows = df.where(F.size(cells) == 2).select(key, F.regexp_replace(F.trim(F.get(cells, F.lit(0))), r"\s*:$", "").alias("k"), F.trim(F.get(cells, F.lit(1))).alias("v"), "row").where("k <> ''")
    first = rows.groupBy(key, "k").agg(F.min_by("v", "row").alias("v"))
    return first.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("fields"))


def carried(df: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """Blank cells of a printed table filled from the row above, within ``by``."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.nullif(F.trim(c), F.lit("")), True).over(w) for c in columns})


def hints(sections: DataFrame, key: str, title: str, body: str, wanted: list[tuple[str, str]], most: int = 1500) -> DataFrame:
    """(key, topic, hint): the sections whose titles fit a topic, one after the other, cut at a word to ``most`` characters."""
    rows = sections.select(key, F.explode(F.array_compact(F.array(*[F.when(F.col(title).rlike(f"(?iu){p}"), F.lit(t)) for t, p in wanted]))).alias("topic"), F.struct("ord", F.trim(F.regexp_replace(body, r"\s+", " ")).alias("t")).alias("s"))
    text = rows.groupBy(key, "topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["t"]), " ").alias("hint"))
    cut_ = F.regexp_replace(F.substring("hint", 1, most + 1), r"\s+\S*$", "")
    return text.select(key, "topic", F.when(F.length("hint") <= most, F.col("hint")).otherwise(cut_).alias("hint"))


def concatenated(slugs: DataFrame, slug: str, vocabulary: DataFrame, word: str) -> DataFrame:
    """(slug, parts array): slugs outside the vocabulary that two or more entries put together make up, the longest first at each place."""
    asked = slugs.select(slug).where(F.col(slug).isNotNull()).distinct().join(vocabulary.select(F.col(word).alias(slug)), slug, "left_anti")
    pieces = F.split(F.col(slug), "-")
    n = F.size(pieces)
    spans = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda m: F.struct(i.alias("i"), m.alias("m"), F.array_join(F.slice(pieces, i, m), "-").alias("w")))))
    known = asked.select(slug, F.explode(spans).alias("_span")).select(slug, "_span.i", "_span.m", F.col("_span.w").alias(word)).join(vocabulary.select(word).distinct(), word)
    by = known.groupBy(slug, "i").agg(F.max(F.struct("m", word)).alias("b")).groupBy(slug).agg(F.map_from_entries(F.collect_list(F.struct("i", "b"))).alias("at"))

    # from place to place by the longest entry; a place without an entry ends the walk
    zero = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("parts"))
    walk = F.aggregate(F.sequence(F.lit(1), n), zero, lambda s, i: F.when((s["next"] == i) & F.try_element_at("at", i).isNotNull(), F.struct((i + F.try_element_at("at", i)["m"]).alias("next"), F.concat(s["parts"], F.array(F.try_element_at("at", i)[word])).alias("parts"))).otherwise(s))
    return by.withColumn("_w", walk).where((F.col("_w.next") == n + 1) & (F.size("_w.parts") > 1)).select(slug, F.col("_w.parts").alias("parts"))


def by_rules(text: Column, rules: list[tuple[str, str, str | None]], gate: dict[str, Column] | None = None) -> Column:
    """Labels whose rule holds: (label, pattern, pattern that forbids it); ``gate`` adds a condition to a label. In the rules' order, each once."""
    gate = gate or {}
    hits = [F.when(text.rlike(f"(?iu){p}") & (~text.rlike(f"(?iu){no}") if no else F.lit(True)) & gate.get(label, F.lit(True)), F.lit(label)) for label, p, no in rules]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def on_topic(text: Column, words: list[str]) -> Column:
    """Whether a text has one of the words, whole."""
    return F.coalesce(text.rlike(r"(?iU)\b(?:" + "|".join(words) + r")\b"), F.lit(False))


def earliest(text: Column, names: dict[str, str]) -> Column:
    """The value whose name stands first in a text; of names at one place the longest. ``names`` maps a name to its value."""
    low = F.lower(text)
    at = [F.struct(F.when(F.locate(n.lower(), low) > 0, F.locate(n.lower(), low)).otherwise(F.lit(2**31 - 1)).alias("p"), F.lit(-len(n)).alias("l"), F.lit(v).alias("v")) for n, v in names.items()]
    best = F.least(*at) if len(at) > 1 else at[0]
    return F.when(best["p"] < 2**31 - 1, best["v"])


def read_glyphs(text: Column, drift: dict[str, str]) -> Column:
    """Characters a text recognition confuses, put right by a table of single characters."""
    return F.translate(text, "".join(drift), "".join(drift.values()))


def chunked(records: DataFrame, key: str, sections: dict[str, Column], least: int = 200) -> DataFrame:
    """(key, part, text): the calls of a record, one for each section of ``least`` characters or more."""
    parts = F.array(*[F.when(F.length(F.trim(c)) >= least, F.struct(F.lit(name).alias("part"), c.alias("text"))) for name, c in sections.items()])
    return records.select(key, F.explode(F.array_compact(parts)).alias("_s")).select(key, "_s.part", "_s.text")


def tagged(df: DataFrame, key: str, text: str, buckets: dict[str, tuple[str, ...]], names: DataFrame, name: str, stop: str | None = None) -> DataFrame:
    """(key, bucket, name): names of a text under the bucket whose heading stands last before them.

    ``buckets`` maps a bucket to the words that open it; what follows a ``stop`` word up to
    the next heading is excluded (bucket ``not``). Longest names first; names before any heading are in bucket ``none``.
    """
    known = [r[0] for r in names.select(F.lower(name)).where(f"{name} is not null").distinct().limit(5001).collect()]
    if len(known) > 5000:
        raise ValueError("tag larger lists of names with documents.tag_terms")
    opened = {w.lower(): b for b, words in buckets.items() for w in words} | ({stop.lower(): "not"} if stop else {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        pattern = re.compile(r"(?<!\w)(?:" + "|".join(re.escape(x) for x in sorted({*known, *opened}, key=lambda x: (-len(x), x))) + r")(?!\w)")
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["k"], pdf["t"]):
                bucket = "none"
                for m in pattern.finditer(t.lower()):
                    word = m.group()
                    if word in opened:
                        bucket = opened[word]
                    else:
                        rows.append((k, bucket, word))
            yield pd.DataFrame(rows, columns=["k", "bucket", "name"]).drop_duplicates()

    kind = dict(df.dtypes)[key]
    found = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"k {kind}, bucket string, name string")
    return found.select(F.col("k").alias(key), "bucket", F.col("name").alias(name))

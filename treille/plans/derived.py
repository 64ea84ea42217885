"""Queries of derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from treille.operators import derive, grammar
from treille.operators.dedup import latest_per_key, once_per_key
from treille.plans.queries import query
from treille.sources import readers

LATEST = "SELECT * FROM wine_index QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1"


def _wines(t, *columns):
    return latest_per_key(t("wine_index").select("rec_id", *columns, "loaded_at"), ["rec_id"], ["loaded_at"])


@query("SELECT slug, file_number FROM gi_register WHERE substr(file_number, 1, 6) IN (SELECT substr(file_number, 1, 6) FROM gi_register WHERE status = 'applied')")
def code_prefix_join(t):
    """Entries that share the head of their file number with an open application."""
    g = t("gi_register").where("file_number is not null")
    return derive.by_code_prefix(g.where("status = 'applied'"), "file_number", g.select("slug", "file_number"), "file_number", 6)


_PARTS = """
p AS (SELECT o_orderkey k, o_orderkey % 7 a, n_name b FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def _parsed(t):
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    few = F.array(F.concat(F.lit("Supplier#"), (F.col("o_orderkey") % 7).cast("string")))
    parsed = o.select(F.col("o_orderkey").alias("k"), few.alias("places"), F.array("n_name").alias("districts"))
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return parsed, "k", [("places", s.select(F.concat(F.lit("Supplier#"), F.col("s_suppkey").cast("string")).alias("n"), "s_suppkey"), "n", "s_suppkey"), ("districts", s, "n_name", "s_suppkey")]


@query(f"""
WITH {_PARTS} SELECT k, s_suppkey AS code FROM p JOIN supplier ON s_suppkey = a UNION SELECT k, s_suppkey FROM p JOIN nation ON n_name = b JOIN supplier ON s_nationkey = n_nationkey
""")
def area_parts(t):
    """Places and districts of an area together."""
    return derive.resolved_parts(*_parsed(t))


@query(f"""
WITH {_PARTS}, d AS (SELECT DISTINCT n_name n FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT part, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(unmatched) AS BIGINT) AS unmatched FROM (
SELECT 'places' part, CASE WHEN a IN (SELECT s_suppkey FROM supplier) THEN 1 ELSE 0 END matched, CASE WHEN a IN (SELECT s_suppkey FROM supplier) THEN 0 ELSE 1 END unmatched FROM p
UNION ALL SELECT 'districts', CASE WHEN b IN (SELECT n FROM d) THEN 1 ELSE 0 END, CASE WHEN b IN (SELECT n FROM d) THEN 0 ELSE 1 END FROM p) GROUP BY 1
""")
def area_part_counts(t):
    """What was found of each part."""
    return derive.parts_found(*_parsed(t)).groupBy("part").agg(F.sum("matched").alias("matched"), F.sum("unmatched").alias("unmatched"))


@query(f"""
WITH w AS ({LATEST}), r AS (SELECT country, string_agg(DISTINCT kind, ';' ORDER BY kind) kinds FROM gi_register WHERE kind IS NOT NULL AND country IS NOT NULL GROUP BY 1) SELECT rec_id, kinds FROM w LEFT JOIN r USING (country)
""")
def regional_roster(t):
    """Records with what the register lists for their country."""
    g = t("gi_register").where("kind is not null and country is not null")
    got = derive.with_roster(_wines(t, "country"), g, "country", "kind", "kinds")
    return got.select("rec_id", F.array_join("kinds", ";").alias("kinds"))


@query(f"WITH w AS ({LATEST}) SELECT rec_id, (SELECT string_agg(r_name, ';' ORDER BY r_name) FROM region) AS roster FROM w")
def national_roster(t):
    """One roster for every record."""
    got = derive.with_roster(_wines(t), t("region"), None, "r_name", "roster")
    return got.select("rec_id", F.array_join("roster", ";").alias("roster"))


@query("""
WITH u AS (SELECT DISTINCT unnest(grapes_principal) slug FROM wine_index), p AS (SELECT slug, min(prime_name) v FROM vivc_passport WHERE trim(prime_name, ' ') <> '' AND vivc_id % 3 <> 0 GROUP BY 1), s AS (SELECT p.slug, min(s.name) v FROM vivc_synonym s JOIN vivc_passport p USING (vivc_id) WHERE trim(s.name, ' ') <> '' GROUP BY 1)
SELECT u.slug, coalesce(p.v, s.v, u.slug) AS value, CASE WHEN p.v IS NOT NULL THEN 'native' WHEN s.v IS NOT NULL THEN 'translated' ELSE 'id' END AS layer FROM u LEFT JOIN p ON p.slug = u.slug LEFT JOIN s ON s.slug = u.slug WHERE u.slug IS NOT NULL
""")
def layered_names(t):
    """Names of the varieties in use: native, else translated, else the id itself."""
    used = t("wine_index").select(F.explode("grapes_principal").alias("slug")).where("slug is not null")
    p = t("vivc_passport")
    names = t("vivc_synonym").join(p.select("vivc_id", "slug"), "vivc_id")
    return derive.layered(used, "slug", [("native", p.where("vivc_id % 3 <> 0"), "slug", "prime_name"), ("translated", names, "slug", "name")])


@query("""
WITH w AS (SELECT DISTINCT l_orderkey k, l_suppkey m FROM lineitem), f AS (SELECT k, m, m % 3 = 0 h FROM w), c AS (SELECT k, count(*) a, count(*) FILTER (h) i FROM f GROUP BY 1) SELECT f.k, f.m FROM f JOIN c ON c.k = f.k WHERE i = 0 OR i = a OR h
""")
def narrowed_members(t):
    """Members narrowed to those hit, where that leaves some."""
    w = t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("m"))
    return derive.narrowed(w, "k", "m", w.where("m % 3 = 0"))


@query(f"""
WITH w AS ({LATEST}), g AS (SELECT slug, country, kind, status FROM gi_register) SELECT w.rec_id, g.slug, coalesce(nullif(w.country, ''), g.country) AS country, coalesce(nullif(w.kind, ''), g.kind) AS kind, g.status FROM w JOIN g ON g.slug = w.parent_slug
""")
def child_copies(t):
    """Children as copies of their register entry, with what they have of their own."""
    w = _wines(t, "parent_slug", "country", "kind").select("rec_id", "parent_slug", F.nullif("country", F.lit("")).alias("country"), F.nullif("kind", F.lit("")).alias("kind"))
    g = t("gi_register").select("slug", F.lit(None).cast("bigint").alias("rec_id"), "country", "kind", "status")
    return derive.copies(g, "slug", w, "parent_slug", ["rec_id", "country", "kind"]).select("rec_id", "slug", "country", "kind", "status")


@query()
def fact_drift(t):
    """Snippets of an earlier audit against the present text of their items: drift, erosion and length."""
    f = t("audit_finding").select("finding_id", "item_id", "snippet", "chars", "confidence").where("snippet is not null")
    i = once_per_key(t("audit_item").select("item_id", "text"), "item_id")
    got = derive.drift(f.join(i, "item_id"), "snippet", "confidence", F.col("chars"), F.length("text").cast("bigint"), "text", 300)
    return got.select("finding_id", "covered", "drifted", "eroded", "too_long")


@query("""
WITH n AS (SELECT surface, item_id, count(*) c FROM audit_finding GROUP BY 1, 2) SELECT surface, CAST(sum(c) AS BIGINT) AS facts, count(*) AS records, min(c) AS least, median(c) AS median, max(c) AS most FROM n GROUP BY 1
""")
def fact_counts(t):
    """Findings by surface, and how many an item has."""
    return derive.fact_counts(t("audit_finding"), "item_id", "surface")


TERMS = {"coteaux": "slopes", "terroir": "terroir", "vallée": "valley", "Weinberg": "vineyard"}


@query(f"""
WITH d AS (SELECT doc_id, text, concat_ws(chr(10), {', '.join(f"CASE WHEN contains(lower(text), '{k.lower()}') THEN '{k} = {v}' END" for k, v in sorted(TERMS.items()))}) g FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha256('Translate.' || CASE WHEN g <> '' THEN chr(10) || g ELSE '' END || chr(10) || chr(10) || text) AS prompt_sha FROM d
""")
def glossary_prompts(t):
    """Prompts with the terms of the glossary that the text has."""
    d = t("documents").where("text is not null")
    return d.select("doc_id", F.sha2(derive.with_glossary(F.col("text"), "Translate.", TERMS), 256).alias("prompt_sha"))


@query("""
WITH c AS (SELECT DISTINCT cahier_id, lien_au_terroir t FROM cahier_extract) SELECT cahier_id, length(t) AS chars, true AS verbatim FROM c WHERE length(t) BETWEEN 1 AND 399
""")
def verbatim_payloads(t):
    """Payloads of the texts that pass as they are, read back."""
    c = once_per_key(t("cahier_extract").select("cahier_id", "slug", "lien_au_terroir"), "cahier_id").where("length(lien_au_terroir) between 1 and 399")
    back = F.from_json(derive.verbatim_payload(F.col("lien_au_terroir"), slug=F.col("slug")), "slug string, text string, verbatim boolean")
    return c.select("cahier_id", F.length(back["text"]).cast("bigint").alias("chars"), back["verbatim"].alias("verbatim"))


@query("""
SELECT c_custkey, CASE WHEN d IS NULL THEN 'NO-DATE' WHEN d <= DATE '1997-06-01' THEN 'OK' WHEN c_custkey % 5 = 0 THEN 'REVIEWED' ELSE 'FLAGGED' END AS state FROM (SELECT c_custkey, CAST(max(o_orderdate) AS DATE) d FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
""")
def dated_fallbacks(t):
    """What entries are worth that are younger than the snapshot they fall back to."""
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("d"))
    return t("customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", derive.dated_state(F.col("d"), "1997-06-01", F.col("c_custkey") % 5 == 0).alias("state"))


@query(f"""
WITH w AS ({LATEST}) SELECT rec_id, CASE WHEN kind = 'AOC' THEN CASE WHEN starts_with(slug, 'val') THEN 'valley' WHEN starts_with(slug, 'colli') THEN 'hills' ELSE 'rest' END ELSE kind END AS part FROM w
""")
def prefix_split(t):
    """One value told apart by what the record's name begins with; the others pass."""
    return _wines(t, "kind", "slug").select("rec_id", derive.by_prefix_rules(F.col("kind"), F.col("slug"), "AOC", [("val", "valley"), ("colli", "hills")], "rest").alias("part"))


@query(f"""
WITH w AS ({LATEST}) SELECT rec_id, CASE WHEN country = 'fr' THEN '{{"register":"fr","page":"' || page || '"}}' WHEN country = 'it' THEN '{{"register":"it"}}' ELSE '{{"page":"' || page || '"}}' END AS sources FROM w WHERE page IS NOT NULL
""")
def source_structs(t):
    """Where a record comes from, by the rule of its country."""
    w = _wines(t, "country", "page").where("page is not null")
    rules = {"fr": F.struct(F.lit("fr").alias("register"), "page"), "it": F.struct(F.lit("it").alias("register"))}
    return w.select("rec_id", derive.provenance(F.coalesce("country", F.lit("")), rules, F.struct("page")).alias("sources"))


@query("""
SELECT slug, CASE WHEN n % 3 = 2 THEN NULL ELSE slug END AS page FROM (SELECT slug, row_number() OVER (ORDER BY slug) n FROM gi_register) WHERE regexp_matches(slug, '^[a-z0-9-]+$')
""")
def page_routes(t):
    """Slugs from paths of the site."""
    from pyspark.sql import Window

    g = t("gi_register").select("slug", F.row_number().over(Window.orderBy("slug")).alias("n")).where("slug rlike '^[a-z0-9-]+$'")  # a fixed table of 600 rows
    path = F.when(F.col("n") % 3 == 0, F.concat(F.lit("/fr/wine/"), "slug")).when(F.col("n") % 3 == 1, F.concat(F.lit("/wine/"), "slug", F.lit("/?x=1"))).otherwise(F.concat(F.lit("/about/"), "slug"))
    return g.select("slug", derive.page_of(path, ["wine"]).alias("page"))


@query("""
WITH w AS (SELECT DISTINCT date_trunc('week', ts) AS week, event_type FROM events), d AS (SELECT DISTINCT date_trunc('week', ts) AS week, event_type FROM events WHERE user_id % 400 = 0) SELECT w.week, w.event_type FROM w LEFT JOIN d ON d.week = w.week AND d.event_type = w.event_type WHERE d.week IS NULL
""")
def resumed_weeks(t):
    """Weeks of a crawl that are still to do."""
    e = t("events").select(F.date_trunc("week", "ts").alias("week"), "event_type", "user_id")
    return readers.after_cursor(e.select("week", "event_type").distinct(), e.where("user_id % 400 = 0"), ["week", "event_type"])


@query("""
WITH x AS (SELECT DISTINCT name FROM match_result WHERE name IS NOT NULL) SELECT name, regexp_matches(name, '^\\p{Lu}') AND length(name) <= 40 AND len(regexp_split_to_array(trim(name, ' '), '[ \\t\\n\\f\\r\\x0B]+')) <= 5 AND NOT regexp_matches(name, '[0-9]') AND lower(name) NOT IN ('autres', 'todos') AS place FROM x
""")
def place_tokens(t):
    """Whether a token can be a name of a place."""
    return t("match_result").where("name is not null").select("name").distinct().select("name", grammar.place_token(F.col("name"), ["autres", "todos"]).alias("place"))

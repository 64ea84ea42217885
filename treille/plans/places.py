"""Queries of resolvers, trees, vocabularies and work lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from treille.functions import keys
from treille.operators import facets, geo, hierarchy, resolve, tables, vocabulary
from treille.operators.dedup import once_per_key
from treille.plans.queries import query

ASCII = "regexp_replace(lower(strip_accents({})), '[^\\x00-\\x7F]', '', 'g')"
SEARCH = "lower(strip_accents({}))"
MATCHES = "SELECT * FROM match_result QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC) = 1"


def _edges(t):
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("node"), F.col("r_name").alias("parent"))
    return n.unionByName(t("region").select(F.col("r_name").alias("node"), F.lit("all").alias("parent"))).unionByName(t("region").limit(1).select(F.lit("all").alias("node"), F.lit(None).cast("string").alias("parent")))


@query("""
SELECT 'all' AS node, NULL AS parent, CAST(0 AS INTEGER) AS depth, 'all' AS path UNION ALL SELECT r_name, 'all', 1, 'all/' || r_name FROM region UNION ALL SELECT n_name, r_name, 2, 'all/' || r_name || '/' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def tree_depth_first(t):
    """Nodes with their path, by which they sort depth first."""
    return hierarchy.depth_first(_edges(t)).select("node", "parent", "depth", F.array_join("path", "/").alias("path"))


@query("""
SELECT r_name AS parent, string_agg(n_name, ';' ORDER BY lower(n_name), n_name) AS children FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1 UNION ALL SELECT 'all', string_agg(r_name, ';' ORDER BY lower(r_name), r_name) FROM region
""")
def tree_children(t):
    return hierarchy.children(_edges(t)).select("parent", F.array_join("children", ";").alias("children"))


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 10 = 0 THEN 'other' ELSE r_name END AS root FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def root_buckets(t):
    """The root buckets of values; what the tree doesn't know is ``other``."""
    edges = _edges(t).where("parent is not null and parent <> 'all'").unionByName(t("region").select(F.col("r_name").alias("node"), F.lit(None).cast("string").alias("parent")))
    roots = hierarchy.roots_of(hierarchy.closure(edges), edges)
    values = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 10 == 0, "unknown").otherwise(F.col("n_name")).alias("v"))
    return hierarchy.buckets(values, "s_suppkey", "v", roots)


@query(r"""
WITH w AS (SELECT DISTINCT name FROM wine_index WHERE name <> ''), p AS (SELECT name, name x FROM w UNION ALL SELECT name, unnest(regexp_split_to_array(lower(name), '\s+(?:ou|et|or|and|o|e|oder|und)\s+|\s*[,/]\s*')) FROM w)
SELECT DISTINCT name, regexp_replace(regexp_replace(lower(strip_accents(x)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]', '', 'g') AS name_key FROM p WHERE regexp_replace(regexp_replace(lower(strip_accents(x)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]', '', 'g') <> ''
""")
def alias_keys(t):
    """Every key a name is known by."""
    names = t("wine_index").where("name <> ''").select("name").distinct()
    return names.select("name", F.explode(resolve.aliases(F.col("name"), keys.squeeze)).alias("name_key"))


@query(r"""
WITH g AS (SELECT DISTINCT parent_slug doc, parent_name title FROM wine_index WHERE parent_slug <> '' AND parent_name <> ''), t AS (SELECT DISTINCT parent_slug doc, name target FROM wine_index WHERE parent_slug <> '' AND name <> ''),
n AS (SELECT doc, count(*) n, min(title) only_ FROM g GROUP BY 1) SELECT t.doc, t.target, only_ AS title, 'only' AS how FROM t JOIN n USING (doc) WHERE n = 1
""")
def segment_lookup(t):
    """The segment of a bundle that a name means; here each bundle has one."""
    w = t("wine_index").where("parent_slug <> ''")
    got = resolve.segment_of(w.where("name <> ''").select(F.col("parent_slug").alias("doc"), F.col("name").alias("target")), "target", w.where("parent_name <> ''").select(F.col("parent_slug").alias("doc"), F.col("parent_name").alias("title")), "doc", "title", keys.squeeze)
    return got.where("how = 'only'")


@query("""
WITH o AS (SELECT DISTINCT s_nationkey k, s_suppkey % 5 opt, s_suppkey m FROM supplier), h AS (SELECT s_nationkey k, s_suppkey m FROM supplier WHERE s_suppkey % 3 = 0 AND s_nationkey % 4 <> 0),
c AS (SELECT o.k, o.opt, count(*) n, count(h.m) s FROM o LEFT JOIN h ON h.k = o.k AND h.m = o.m GROUP BY 1, 2), a AS (SELECT k, count(*) opts, max(s) top, string_agg(CAST(opt AS VARCHAR), ';' ORDER BY opt) all_, arg_max(opt, (s / n, s, opt)) best FROM c GROUP BY 1)
SELECT k AS s_nationkey, CASE WHEN opts = 1 OR top > 0 THEN CAST(best AS VARCHAR) ELSE all_ END AS options, CASE WHEN opts = 1 THEN 'only' WHEN top > 0 THEN 'covered' ELSE 'union' END AS how FROM a
""")
def best_covered_option(t):
    """Of several options the one a hint covers best; without a hint all of them."""
    s = t("supplier").select("s_nationkey", "s_suppkey", (F.col("s_suppkey") % 5).alias("opt"))
    options = s.groupBy("s_nationkey", "opt").agg(F.collect_set("s_suppkey").alias("m"))
    hint = s.groupBy("s_nationkey").agg(F.collect_set(F.when((F.col("s_suppkey") % 3 == 0) & (F.col("s_nationkey") % 4 != 0), F.col("s_suppkey"))).alias("h"))
    got = resolve.best_covered(hint, "s_nationkey", "h", options, "opt", "m")
    return got.select("s_nationkey", F.array_join(F.col("options").cast("array<string>"), ";").alias("options"), "how")


@query("""
WITH p AS (SELECT o_orderkey k, o_orderkey % 6 < 2 AS low, o_orderkey % 6 < 4 AS mid, o_custkey c FROM orders),
x AS (SELECT k, CASE WHEN low THEN 'customer' WHEN mid THEN 'nation' ELSE 'region' END AS level, c FROM p)
SELECT DISTINCT k, level, CASE level WHEN 'customer' THEN c WHEN 'nation' THEN CAST(n_nationkey AS BIGINT) ELSE CAST(r_regionkey AS BIGINT) END AS code FROM x JOIN customer ON c = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def most_specific_level(t):
    """Names of the most specific level only."""
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    none = F.array().cast("array<string>")
    k = F.col("o_orderkey") % 6
    parsed = o.select(F.col("o_orderkey").alias("k"), F.when(k < 2, F.array("c_name")).otherwise(none).alias("a"), F.when(k < 4, F.array("n_name")).otherwise(none).alias("b"), F.array("r_name").alias("c"))
    table = lambda n, name, code: t(n).select(F.col(name).alias("n"), F.col(code).cast("bigint").alias("c"))
    return resolve.most_specific(parsed, "k", [("customer", "a", table("customer", "c_name", "c_custkey"), "n", "c"), ("nation", "b", table("nation", "n_name", "n_nationkey"), "n", "c"), ("region", "c", table("region", "r_name", "r_regionkey"), "n", "c")])


@query("""
SELECT r_regionkey AS k, s_suppkey AS code FROM region JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0
UNION SELECT r_regionkey, s_suppkey FROM region, supplier WHERE s_suppkey % 50 = r_regionkey AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey % 5 = 0)
""")
def area_without_exclusions(t):
    """Areas of different size together, without the excluded ones."""
    nation, s = t("nation"), t("supplier")
    parsed = t("region").join(nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy(F.col("r_regionkey").alias("k"), F.col("r_name")).agg(F.collect_set(F.when(F.col("n_nationkey") % 5 == 0, F.col("n_name"))).alias("out"))
    parsed = parsed.select("k", F.array("r_name").alias("wide"), F.array(F.col("k").cast("string")).alias("few"), "out")
    placed = s.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return resolve.all_but(parsed, "k", [("wide", placed, "r_name", "s_suppkey"), ("few", s.select((F.col("s_suppkey") % 50).cast("string").alias("n"), "s_suppkey"), "n", "s_suppkey")], "out", placed, "n_name", "s_suppkey")


@query("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN o_orderpriority WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS value,
 CASE WHEN o_orderkey % 4 = 0 THEN 'parent:empty' WHEN o_orderkey % 4 = 1 THEN 'parent' WHEN o_orderkey % 3 = 0 THEN 'own' ELSE 'none' END AS step FROM orders
""")
def resolver_chain(t):
    """A chain whose first step ends it even where it knows no value."""
    o = t("orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority", "o_orderstatus")
    parent = o.where("k % 4 < 2").select("k", F.when(F.col("k") % 4 == 1, F.col("o_orderpriority")).alias("value"))
    own = o.where("k % 3 = 0 or k % 5 = 0").select("k", F.when(F.col("k") % 3 == 0, F.col("o_orderstatus")).alias("value"))
    return resolve.chain(o, "k", [("parent", parent, True), ("own", own, False)])


@query("""
WITH l AS (SELECT DISTINCT rec_id, country, name FROM wine_index WHERE name <> '' AND country IS NOT NULL AND is_sub_denomination), r AS (SELECT DISTINCT country, name other FROM gi_register WHERE name <> '' AND country IS NOT NULL),
s AS (SELECT DISTINCT rec_id, other, CASE WHEN name = other THEN 1.0 WHEN contains(name, other) THEN 0.85 WHEN contains(other, name) THEN 0.7 ELSE round(1 - levenshtein(name, other) / greatest(length(name), length(other)), 6) END AS score FROM l JOIN r USING (country))
SELECT rec_id, other, CAST(score AS DOUBLE) AS score FROM s WHERE score >= 0.7 QUALIFY score = max(score) OVER (PARTITION BY rec_id)
""")
def bounded_fuzzy_match(t):
    """The likeliest register names of the same country for each record."""
    left = t("wine_index").where("name <> '' and country is not null and is_sub_denomination").select("rec_id", "country", "name").distinct()
    right = t("gi_register").where("name <> '' and country is not null").select("country", F.col("name").alias("other"))

    def score(a, b):
        near = F.round(1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)), 6)
        return F.when(a == b, 1.0).when(F.contains(a, b), 0.85).when(F.contains(b, a), 0.7).otherwise(near)

    return resolve.bounded_fuzzy(left, "rec_id", "name", "country", right, "other", score, 0.7)


_TERMS = f"""
terms AS (SELECT DISTINCT vivc_id slug, {SEARCH.format("trim(CAST(vivc_id AS VARCHAR), ' ')")} term FROM vivc_passport UNION SELECT vivc_id, {SEARCH.format("trim(prime_name, ' ')")} FROM vivc_passport UNION SELECT vivc_id, {SEARCH.format("trim(name, ' ')")} FROM vivc_synonym WHERE name IS NOT NULL),
ok AS (SELECT term, count(*) n, min(slug) slug FROM terms WHERE term <> '' GROUP BY 1)
"""


def _terms(t):
    return vocabulary.synonym_map(t("vivc_passport"), "vivc_id", [(t("vivc_passport"), "vivc_id", "prime_name"), (t("vivc_synonym"), "vivc_id", "name")])


@query(f"WITH {_TERMS} SELECT term, slug FROM ok WHERE n = 1")
def synonym_terms(t):
    """Terms that name one variety."""
    return _terms(t)[0]


@query(f"WITH {_TERMS} SELECT term, string_agg(CAST(slug AS VARCHAR), ';' ORDER BY slug) AS slugs FROM terms WHERE term IN (SELECT term FROM ok WHERE n > 1) GROUP BY 1")
def synonym_clashes(t):
    """Terms that several varieties claim."""
    return _terms(t)[1].select("term", F.array_join(F.col("slugs").cast("array<string>"), ";").alias("slugs"))


@query(f"WITH {_TERMS}, m AS ({MATCHES}) SELECT entry_id, ok.slug AS canonical FROM m LEFT JOIN ok ON ok.n = 1 AND ok.term = {SEARCH.format("trim(m.name, ' ')")}")
def canonical_lookup(t):
    """The variety a name stands for, by equal terms."""
    m = once_per_key(t("match_result"), "entry_id").select("entry_id", "name")
    return vocabulary.canonical(m, "name", _terms(t)[0]).select("entry_id", "canonical")


TRANSLIT = "trim(regexp_replace(strip_accents({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"


def _latin(c: str) -> str:
    single = {k: v for k, v in keys.CYRILLIC.items() if len(v) == 1}
    out = f"replace(replace(translate(lower({c}), '{''.join(single)}', '{''.join(single.values())}'), 'ъ', ''), 'ь', '')"
    for k, v in keys.CYRILLIC.items():
        if len(v) > 1:
            out = f"replace({out}, '{k}', '{v}')"
    return TRANSLIT.format(out)


@query(rf"""
SELECT syn_id, {_latin("name")} AS latin, trim(regexp_replace(replace(upper(replace(replace(strip_accents(name), 'ﬁ', 'fi'), 'ﬂ', 'fl')), 'ẞ', 'SS'), '[ \t\n\f\r\x0B]+', ' ', 'g'), ' ') AS upper_name FROM (SELECT DISTINCT syn_id, name FROM vivc_synonym) WHERE name IS NOT NULL
""")
def script_keys(t):
    """Synonyms of three scripts in Latin spelling and in capitals without marks."""
    s = once_per_key(t("vivc_synonym").select("syn_id", "name"), "syn_id").where("name is not null")
    return s.select("syn_id", keys.transliterated(F.col("name")).alias("latin"), keys.upper_key(F.col("name")).alias("upper_name"))


CODE = r"\S\s+(Rs|Rg|Β|Ν|Ε|B|N|G)\.?$"


@query(rf"""
WITH v AS (SELECT {_latin("prime_name")} surface, min(slug) slug FROM vivc_passport GROUP BY 1), m AS (SELECT DISTINCT name FROM match_result WHERE trim(name, ' ') <> ''),
k AS (SELECT name, trim(regexp_replace(name, '(\S)\s+(?:Rs|Rg|Β|Ν|Ε|B|N|G)\.?$', '\1'), ' ') bare FROM m), x AS (SELECT name, {_latin("name")} k0, {_latin("bare")} k1 FROM k)
SELECT name, coalesce(a.slug, b.slug) AS slug, CASE WHEN a.slug IS NOT NULL THEN 'exact' ELSE 'colour' END AS how FROM x LEFT JOIN v a ON a.surface = k0 AND k0 <> '' LEFT JOIN v b ON b.surface = k1 AND k1 <> '' WHERE a.slug IS NOT NULL OR b.slug IS NOT NULL
""")
def variety_exact_stages(t):
    """Names that the first two stages of the variety cascade settle: equal, or equal without a colour code."""
    return _cascade(t).where("how in ('exact', 'colour')").select("name", "slug", "how")


def _cascade(t):
    p = t("vivc_passport").groupBy(keys.transliterated(F.col("prime_name")).alias("surface")).agg(F.min("slug").alias("slug"))
    return vocabulary.match_variety(t("match_result").select("name", "colour"), "name", p)


@query()
def variety_cascade(t):
    """The whole cascade: equal, without colour code, a part of a hyphened name, likeliest spelling; what is left with its nearest name."""
    return _cascade(t)


@query()
def unknown_varieties(t):
    """The queue of names that no stage matched, by document."""
    return vocabulary.dead_letter(t("match_result").where("pliego_slug is not null"), "pliego_slug", "name", _cascade(t))


@query(f"""
WITH u AS (SELECT g slug, count(DISTINCT rec_id) n FROM (SELECT rec_id, unnest(grapes_principal) g FROM wine_index) GROUP BY 1),
a AS (SELECT p.slug, s.name a, {SEARCH.format("s.name")} l FROM vivc_synonym s JOIN vivc_passport p USING (vivc_id) WHERE s.name IS NOT NULL),
b AS (SELECT slug, a, CASE WHEN starts_with(l, 'ber') THEN 60 WHEN contains(l, 'ber') THEN 40 ELSE 0 END s FROM a), c AS (SELECT slug, arg_min(a, (-s, a)) a, max(s) s FROM b WHERE s > 0 GROUP BY 1),
e AS (SELECT slug, prime_name, CASE WHEN starts_with({SEARCH.format("prime_name")}, 'ber') THEN 100 WHEN contains({SEARCH.format("prime_name")}, 'ber') THEN 80 ELSE 0 END l FROM vivc_passport)
SELECT e.slug, prime_name, CAST(CASE WHEN l > 0 THEN l ELSE s END AS INTEGER) AS score, CASE WHEN l = 0 THEN c.a END AS alias, u.n FROM e LEFT JOIN c USING (slug) JOIN u USING (slug) WHERE l > 0 OR s > 0 ORDER BY score DESC, n DESC, slug LIMIT 12
""")
def search_suggestions(t):
    """The best twelve varieties for what was typed, by name and by synonym."""
    p = t("vivc_passport")
    a = t("vivc_synonym").where("name is not null").join(p.select("vivc_id", "slug"), "vivc_id").select("slug", "name")
    u = t("wine_index").select("rec_id", F.explode("grapes_principal").alias("slug")).distinct().groupBy("slug").agg(F.count("*").alias("n"))
    return vocabulary.suggestions(p, "slug", "prime_name", a, "name", u, "ber", 12)


@query("""
WITH g AS (SELECT DISTINCT rec_id, unnest(grapes_principal) m FROM wine_index), c AS (SELECT DISTINCT rec_id, coalesce(lower(nullif(color, '')), m) canonical FROM g LEFT JOIN vivc_passport ON slug = m WHERE m IS NOT NULL) SELECT canonical, count(*) AS n FROM c GROUP BY 1
""")
def merged_facet_counts(t):
    """Records by the canonical value of their members, once each."""
    g = t("wine_index").select("rec_id", F.explode("grapes_principal").alias("m"))
    to = t("vivc_passport").where("color <> ''").select(F.col("slug").alias("member"), F.lower("color").alias("canonical"))
    return vocabulary.merged_counts(g, "rec_id", "m", to)


@query("SELECT DISTINCT b.slug FROM vivc_passport a JOIN vivc_passport b ON b.species = a.species AND b.country = a.country WHERE a.vivc_id % 97 = 0 UNION SELECT slug FROM vivc_passport WHERE vivc_id % 97 = 0")
def expanded_selection(t):
    """A selection with all that stand for the same."""
    p = t("vivc_passport")
    to = p.where("species is not null and country is not null").select(F.col("slug").alias("member"), F.concat_ws("/", "species", "country").alias("canonical"))
    return vocabulary.expanded(p.where("vivc_id % 97 = 0"), "slug", to)


@query(rf"""
WITH w AS (SELECT slug, string_split(trim(regexp_replace({ASCII.format("name")}, '[^a-z0-9]+', '-', 'g'), '-'), '-') t, string_split(slug, '-') s FROM gi_register WHERE name IS NOT NULL),
x AS (SELECT slug, list_sort(list_distinct(list_filter(t, lambda v: v NOT IN ('wine', '')))) t, list_sort(list_distinct(list_filter(s, lambda v: v NOT IN ('wine', '')))) s FROM w)
SELECT slug, len(t) > 0 AND (t = s OR (NOT list_has_any(t, ['blanc', 'noir']) AND t = list_filter(s, lambda v: v NOT IN ('blanc', 'noir')))) AS matches FROM x
""")
def title_matches(t):
    """Whether a register title names its slug."""
    g = t("gi_register").where("name is not null")
    return g.select("slug", vocabulary.title_matches(F.col("name"), F.col("slug"), ["wine"], ["blanc", "noir"]).alias("matches"))


@query(r"""
WITH m AS (SELECT DISTINCT name, slug FROM match_result WHERE trim(name, ' ') <> '' AND slug IS NOT NULL), f AS (SELECT name, slug, len(regexp_split_to_array(trim(name, ' '), '[ \t\n\f\r\x0B]+')) w FROM m)
SELECT name, slug, CASE WHEN lower(trim(name, ' ')) IN ('autres', 'divers') THEN 'style' WHEN regexp_matches(name, '[^ \t\n\f\r\x0B] {3,}[^ \t\n\f\r\x0B]|[.;:!?][ \t\n\f\r\x0B]|[()\[\]]$') OR length(name) > 40 OR w > 5 THEN 'artifact' WHEN w < len(string_split(slug, '-')) THEN 'truncated' END AS flag FROM f
""")
def flagged_surfaces(t):
    """What is wrong with harvested names."""
    m = t("match_result").where("trim(name) <> '' and slug is not null").select("name", "slug").distinct()
    return m.select("name", "slug", vocabulary.flagged_surface(F.col("name"), F.col("slug"), ["autres", "divers"]).alias("flag"))


@query(rf"""
WITH m AS ({MATCHES}), w AS (SELECT pliego_slug d, name, unnest(string_split(trim(regexp_replace({SEARCH.format("name")}, '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), ' ')) token FROM m WHERE name IS NOT NULL)
SELECT token, count(*) AS uses, count(DISTINCT d) AS documents, count(DISTINCT name) AS forms FROM w WHERE token <> '' GROUP BY 1
""")
def token_statistics(t):
    """Uses, documents and forms of each word of the entered names."""
    m = once_per_key(t("match_result").select("entry_id", "pliego_slug", "name"), "entry_id").where("name is not null")
    words = F.split(F.trim(F.regexp_replace(keys.search_key(F.col("name")), r"(?U)[^\p{L}\p{N}]+", " ")), " ")
    return m.select("pliego_slug", "name", F.explode(words).alias("token")).where("token <> ''").groupBy("token").agg(F.count("*").alias("uses"), F.countDistinct("pliego_slug").alias("documents"), F.countDistinct("name").alias("forms"))


@query("""
WITH c AS (SELECT c_mktsegment seg, n_name v, count(*) n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) SELECT seg, v, n, CAST(row_number() OVER (PARTITION BY seg ORDER BY n DESC, v) AS INTEGER) AS place FROM c
""")
def facet_listing(t):
    """Facet values in the order of the listing."""
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_mktsegment").alias("seg"), F.col("n_name").alias("v")).agg(F.count("*").alias("n"))
    return facets.listed(c, ["seg"], "v")


@query("""
WITH c(a, b) AS (VALUES ('bul', 'bg'), ('chi', 'zh'), ('deu', 'de'), ('dut', 'nl'), ('ell', 'el'), ('eng', 'en'), ('fra', 'fr'), ('fre', 'fr'), ('ger', 'de'), ('gre', 'el'), ('ita', 'it'), ('jpn', 'ja'), ('nld', 'nl'), ('por', 'pt'), ('spa', 'es'), ('tha', 'th'), ('zho', 'zh')),
h AS (SELECT surface, confidence, lower(regexp_extract(trim(expected, ' '), '^([A-Za-z]{2,3})(?:$|[-_])', 1)) e, lower(regexp_extract(trim(detected, ' '), '^([A-Za-z]{2,3})(?:$|[-_])', 1)) d FROM audit_finding),
x AS (SELECT surface, confidence, CASE WHEN length(e) = 2 THEN e ELSE ce.b END e, CASE WHEN length(d) = 2 THEN d ELSE cd.b END d FROM h LEFT JOIN c ce ON ce.a = e LEFT JOIN c cd ON cd.a = d)
SELECT surface, e AS expected, d AS detected, count(*) AS n, CAST(sum(CASE WHEN confidence >= 0.7 THEN 1 ELSE 0 END) AS BIGINT) AS sure FROM x WHERE e <> d GROUP BY 1, 2, 3
""")
def language_confusion(t):
    """Which language was found for which, by surface."""
    return tables.confusion(t("audit_finding"), "surface", keys.language_code(F.col("expected")), keys.language_code(F.col("detected")), F.coalesce(F.col("confidence") >= 0.7, F.lit(False)))


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_event_id, median(event_id) AS median_event_id, CAST(sum(user_id) AS BIGINT) AS sum_user_id, median(user_id) AS median_user_id FROM events GROUP BY 1")
def event_medians(t):
    """Totals and medians by kind."""
    return tables.medians(t("events"), ["event_type"], ["event_id", "user_id"])


@query("""
WITH b AS (SELECT p_partkey id, p_brand, p_partkey * 37 % 500 minx, p_partkey * 61 % 500 miny, p_size s FROM part),
j AS (SELECT a.id a, b.id b, least(a.p_brand, b.p_brand) AS first, greatest(a.p_brand, b.p_brand) AS second, (least(a.minx + a.s, b.minx + b.s) - greatest(a.minx, b.minx)) * (least(a.miny + a.s, b.miny + b.s) - greatest(a.miny, b.miny)) shared
  FROM b a JOIN b ON a.id < b.id AND a.p_brand <> b.p_brand AND a.minx < b.minx + b.s AND b.minx < a.minx + a.s AND a.miny < b.miny + b.s AND b.miny < a.miny + a.s)
SELECT first, second, count(*) AS pairs, arg_max(a, (shared, -a, -b)) AS a, arg_max(b, (shared, -a, -b)) AS b, CAST(max(shared) AS BIGINT) AS shared FROM j GROUP BY 1, 2
""")
def overlap_families(t):
    """Overlaps by pair of brands, with the largest of each."""
    x, y = F.col("p_partkey") * 37 % 500, F.col("p_partkey") * 61 % 500
    boxes = t("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), x.alias("minx"), y.alias("miny"), (x + F.col("p_size")).alias("maxx"), (y + F.col("p_size")).alias("maxy"))
    return geo.family_overlaps(boxes, "id", "brand", 50).withColumn("shared", F.col("shared").cast("bigint"))


@query("""
WITH j AS (SELECT doc_id FROM documents), d AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0), f AS (SELECT doc_id FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 8 = 0),
n AS (SELECT doc_id, count(*) c FROM f GROUP BY 1) SELECT j.doc_id, CAST(coalesce(c, 0) + 1 AS INTEGER) AS attempt, CAST(coalesce(c, 0) * 60 AS INTEGER) AS wait_s FROM j LEFT JOIN n USING (doc_id) WHERE j.doc_id NOT IN (SELECT doc_id FROM d) AND coalesce(c, 0) < 3
""")
def resumed_requests(t):
    """Requests of an interrupted batch that are still to send; answers and failures are made here by rule."""
    d = t("documents").select("doc_id")
    tries = d.where("doc_id % 2 = 0").union(d.where("doc_id % 4 = 0")).union(d.where("doc_id % 8 = 0"))
    return tables.retried(d, "doc_id", d.where("doc_id % 3 = 0"), tries)


@query("""
SELECT slug, CASE WHEN vivc_id % 2 = 0 THEN 'answer' WHEN vivc_id % 3 = 0 THEN 'ask' ELSE 'none' END AS use FROM vivc_passport
""")
def negative_cache(t):
    """Cached misses hold only while what they rest on is the same; the cache is made here by rule."""
    p = t("vivc_passport").select("slug", "vivc_id", keys.content_key(F.coalesce("country", F.lit(""))).alias("fingerprint"))
    cache = p.select("slug", (F.col("vivc_id") % 2 == 0).alias("found"), F.when(F.col("vivc_id") % 3 == 0, "old").otherwise(F.col("fingerprint")).alias("fingerprint"))
    return tables.negatives_still_valid(cache, "slug", p)


@query("SELECT p_brand, p_type, p_size, count(*) AS patches, string_agg(DISTINCT p_name, ';' ORDER BY p_name) AS names FROM part WHERE p_retailprice > 1500 GROUP BY 1, 2, 3 HAVING count(*) > 1")
def patch_clashes(t):
    """Keys for which a patch table says two things."""
    got = tables.patch_clashes(t("part").where("p_retailprice > 1500"), ["p_brand", "p_type", "p_size"], "p_name")
    return got.select("p_brand", "p_type", "p_size", "patches", F.array_join("values", ";").alias("names"))


@query("""
WITH r AS (SELECT country, CASE WHEN coalesce(stub, false) THEN 1 ELSE 0 END child, lower(name) l, rec_id FROM (SELECT * FROM wine_index QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1) WHERE name IS NOT NULL)
SELECT rec_id, CAST(row_number() OVER (PARTITION BY country ORDER BY child, l, rec_id) AS INTEGER) AS place FROM r
""")
def browse_order(t):
    """Records of a country in browsing order: placeholders last, then by name."""
    w = once_per_key(t("wine_index").select("rec_id", "country", "stub", "name"), "rec_id").where("name is not null")
    order = Window.partitionBy("country").orderBy(F.coalesce("stub", F.lit(False)), F.lower("name"), "rec_id")
    return w.select("rec_id", F.row_number().over(order).alias("place"))

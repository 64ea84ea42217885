"""Queries over the domain's registers and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from treille.functions import keys
from treille.operators import facets, hierarchy, resolve, tables
from treille.operators.dedup import latest_per_key, once_per_key
from treille.plans.queries import query
from treille.sources import sinks

LATEST = "SELECT * FROM wine_index QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1"


def _wines(t):
    return once_per_key(t("wine_index"), "rec_id")


@query(f"""
WITH w AS ({LATEST}), e AS (SELECT DISTINCT rec_id, unnest(styles) v FROM w) SELECT v AS value, count(*) AS n FROM e WHERE v IS NOT NULL GROUP BY 1
""")
def facet_histogram(t):
    """Records by style."""
    return facets.histogram(_wines(t), "rec_id", "styles")


@query(f"""
WITH w AS ({LATEST}) SELECT rec_id FROM w WHERE list_has_any(styles, ['rose', 'sweet']) AND country IN ('fr', 'it') AND NOT coalesce(stub, false)
""")
def synonym_expanded_filter(t):
    """Records with one of a set of styles, of two countries, without stubs."""
    df = _wines(t)
    return facets.matching(df, {"style": facets.any_of("styles", ["rose", "sweet"], True), "country": facets.any_of("country", ["fr", "it"]), "stub": ~F.coalesce("stub", F.lit(False))}).select("rec_id")


@query(f"""
WITH w AS ({LATEST}), c AS (SELECT *, nullif(trim(region), '') rg FROM w),
p AS (SELECT slug ps, any_value(nullif(trim(region), '')) pr FROM c GROUP BY 1)
SELECT rec_id, coalesce(rg, pr) AS region, rg IS NULL AND pr IS NOT NULL AS inherited FROM c LEFT JOIN p ON parent_slug = ps
""")
def inherit_from_parent(t):
    """A region that is missing is taken from the parent record."""
    df = _wines(t).select("rec_id", "slug", "parent_slug", keys.none_if_blank(F.col("region")).alias("region"))
    return hierarchy.inherit(df, "slug", "parent_slug", ["region"]).select("rec_id", "region", "inherited")


@query(f"""
WITH w AS ({LATEST}), ch AS (SELECT DISTINCT parent_slug s FROM w WHERE parent_slug <> '')
SELECT rec_id, CASE WHEN is_sub_denomination THEN 'fold' WHEN coalesce(stub, false) THEN 'fold' WHEN communes_count > 0 OR ch.s IS NOT NULL THEN 'index' ELSE 'fold' END AS gate,
 CASE WHEN is_sub_denomination THEN parent_slug END AS into_slug FROM w LEFT JOIN ch ON ch.s = w.slug
""")
def page_gate(t):
    """Whether a record gets a page of its own or is folded into its parent's."""
    df = _wines(t)
    kids = df.where("parent_slug <> ''").select(F.col("parent_slug").alias("slug"), F.lit(True).alias("kids")).distinct()
    gate = F.when(F.col("is_sub_denomination"), "fold").when(F.coalesce("stub", F.lit(False)), "fold").when((F.col("communes_count") > 0) | F.col("kids"), "index").otherwise("fold")
    return df.join(kids, "slug", "left").select("rec_id", gate.alias("gate"), F.when(F.col("is_sub_denomination"), F.col("parent_slug")).alias("into_slug"))


@query(f"""
WITH w AS ({LATEST}) SELECT rec_id, list_sort(list_distinct(list_filter(grapes_accessory, lambda x: x IS NOT NULL AND NOT list_contains(list_filter(coalesce(grapes_principal, []), lambda y: y IS NOT NULL), x)))) AS extra FROM w WHERE grapes_accessory IS NOT NULL
""")
def new_values_only(t):
    """Accessory values that are not principal ones already."""
    df = _wines(t).where("grapes_accessory is not null")
    principal = F.coalesce("grapes_principal", F.array().cast("array<string>"))
    return df.select("rec_id", F.array_sort(F.array_except(F.array_compact("grapes_accessory"), F.array_compact(principal))).alias("extra"))


@query(f"""
WITH w AS ({LATEST}), e AS (SELECT DISTINCT rec_id, country, unnest(list_concat(coalesce(grapes_principal, []), coalesce(grapes_accessory, []))) g FROM w),
c AS (SELECT g, country, count(*) n FROM e WHERE g IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2)
SELECT g AS grape, arg_min(country, (-n, country)) AS country, CAST(sum(n) AS BIGINT) AS uses FROM c GROUP BY 1
""")
def dominant_country(t):
    """Uses of each variety and the country with most of them."""
    both = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("grapes_principal", "grapes_accessory")])
    c = _wines(t).select("country", F.explode(F.array_distinct(both)).alias("grape")).where("grape is not null and country is not null").groupBy("grape", "country").agg(F.count("*").alias("n"))
    return c.groupBy("grape").agg(F.min_by("country", F.struct((-F.col("n")).alias("x"), "country")).alias("country"), F.sum("n").alias("uses"))


@query(f"""
WITH w AS ({LATEST}) SELECT country, region, count(*) AS n, min(name) AS first_name, max(name) AS last_name, count(DISTINCT upper(name[1:1])) AS letters FROM w WHERE NOT coalesce(stub, false) AND name IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2
""")
def browse_index(t):
    """The heads of the browsing pages by country and region; the names themselves are rows (browse_order), as a region may have any number."""
    w = _wines(t).where("not coalesce(stub, false) and name is not null and region is not null")
    return w.groupBy("country", "region").agg(F.count("*").alias("n"), F.min("name").alias("first_name"), F.max("name").alias("last_name"), F.countDistinct(F.upper(F.substring("name", 1, 1))).alias("letters"))


@query(f"""
WITH w AS ({LATEST}) SELECT rec_id, name, country, sha256(concat_ws(chr(0), slug, coalesce(page, ''), coalesce(array_to_string(categories, ';'), ''))) AS panel_sha FROM w
""")
def startup_panel_split(t):
    """The columns a start needs, and the hash of the rest."""
    rest = keys.content_key(F.col("slug"), F.coalesce("page", F.lit("")), F.coalesce(F.array_join("categories", ";"), F.lit("")))
    return _wines(t).select("rec_id", "name", "country", rest.alias("panel_sha"))


@query(f"""
WITH w AS ({LATEST}), k AS (SELECT parent_slug, count(*) n FROM w WHERE parent_slug <> '' GROUP BY 1) SELECT slug, rec_id, kind, CASE WHEN count(*) OVER (PARTITION BY parent_slug) > 1 AND parent_slug <> '' THEN slug || '-' || lower(coalesce(kind, 'none')) ELSE slug END AS page_slug FROM w
""")
def disambiguated_slugs(t):
    """Slugs of siblings get their kind as a suffix."""
    df = _wines(t)
    n = df.where("parent_slug <> ''").groupBy("parent_slug").agg(F.count("*").alias("n"))
    suffix = F.concat("slug", F.lit("-"), F.lower(F.coalesce("kind", F.lit("none"))))
    return df.join(n, "parent_slug", "left").select("slug", "rec_id", "kind", F.when(F.col("n") > 1, suffix).otherwise(F.col("slug")).alias("page_slug"))


@query(f"""
WITH w AS ({LATEST}), n AS (SELECT rec_id, upper(nullif(trim(kind), '')) k FROM w) SELECT rec_id, CASE WHEN k IN ('AOC', 'AOP', 'DOP') THEN 'AOP' WHEN k IN ('IGP') THEN 'IGP' WHEN k IS NULL THEN 'none' ELSE k END AS kind FROM n
""")
def derived_kind(t):
    """Kinds under one spelling."""
    k = F.upper(keys.none_if_blank(F.col("kind")))
    return _wines(t).select("rec_id", F.when(k.isin("AOC", "AOP", "DOP"), "AOP").when(k == "IGP", "IGP").when(k.isNull(), "none").otherwise(k).alias("kind"))


@query("""
WITH s AS (SELECT DISTINCT syn_id, vivc_id, name FROM vivc_synonym WHERE name IS NOT NULL)
SELECT lower(name) AS surface, count(DISTINCT vivc_id) AS claimants, min(vivc_id) AS first_id FROM s GROUP BY 1 HAVING count(DISTINCT vivc_id) > 1
""")
def ambiguous_synonyms(t):
    """Synonyms that several varieties claim."""
    return t("vivc_synonym").where("name is not null").groupBy(F.lower("name").alias("surface")).agg(F.countDistinct("vivc_id").alias("claimants"), F.min("vivc_id").alias("first_id")).where("claimants > 1")


@query("""
WITH s AS (SELECT vivc_id, name, max(CASE WHEN official_in IS NOT NULL THEN 1 ELSE 0 END) o FROM vivc_synonym WHERE name IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vivc_id ORDER BY o DESC, name) rank FROM s)
SELECT vivc_id, name, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10
""")
def top_synonyms(t):
    """The ten synonyms of each variety that come first, official ones before others."""
    s = t("vivc_synonym").where("name is not null").groupBy("vivc_id", "name").agg(F.max(F.when(F.col("official_in").isNotNull(), 1).otherwise(0)).alias("o"))
    return facets.top_per_group(s, "vivc_id", [F.desc("o"), "name"], 10).select("vivc_id", "name", "rank")


@query("""
SELECT coalesce(nullif(trim(canton), ''), cantons[1], nullif(lower(trim(abbrev)), '')) AS value, CASE WHEN nullif(trim(canton), '') IS NOT NULL THEN 'canton' WHEN cantons[1] IS NOT NULL THEN 'cantons' WHEN nullif(trim(abbrev), '') IS NOT NULL THEN 'abbrev' END AS source, entry_id
FROM (SELECT * FROM ofag_entry QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC) = 1)
""")
def canton_fallback(t):
    """The canton by the first field that has one."""
    df = once_per_key(t("ofag_entry"), "entry_id")
    return df.select(*resolve.first_by_priority([("canton", keys.none_if_blank(F.col("canton"))), ("cantons", F.get("cantons", F.lit(0))), ("abbrev", F.lower(keys.none_if_blank(F.trim("abbrev"))))]), "entry_id")


@query("""
WITH m AS (SELECT * FROM match_result QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC) = 1)
SELECT pliego_slug, count(*) AS entries, count(*) FILTER (slug IS NOT NULL) AS matched, count(*) FILTER (lower(method) LIKE 'exact%') AS exact, count(*) FILTER (lower(method) LIKE 'fuzzy%') AS fuzzy FROM m GROUP BY 1
""")
def match_audit(t):
    """How an earlier run dealt with each document's entries."""
    m = once_per_key(t("match_result"), "entry_id")
    return m.groupBy("pliego_slug").agg(F.count("*").alias("entries"), *tables.count_if(("matched", F.col("slug").isNotNull()), ("exact", F.coalesce(F.lower("method").startswith("exact"), F.lit(False))), ("fuzzy", F.coalesce(F.lower("method").startswith("fuzzy"), F.lit(False)))))


@query("""
WITH m AS (SELECT * FROM match_result QUALIFY row_number() OVER (PARTITION BY entry_id ORDER BY loaded_at DESC) = 1), x AS (SELECT entry_id, lower(trim(name)) k FROM m WHERE trim(name) <> ''),
p AS (SELECT lower(prime_name) k, min(vivc_id) v FROM vivc_passport GROUP BY 1), s AS (SELECT replace(slug, '-', ' ') k, min(vivc_id) v FROM vivc_passport GROUP BY 1)
SELECT entry_id, coalesce(p.v, s.v) AS vivc_id, CASE WHEN p.v IS NOT NULL THEN 'prime' WHEN s.v IS NOT NULL THEN 'slug' ELSE 'none' END AS method FROM x LEFT JOIN p ON p.k = x.k LEFT JOIN s ON s.k = x.k
""")
def staged_match(t):
    """Exact stages one after the other: prime name, then slug; later stages see only the rest."""
    m = once_per_key(t("match_result"), "entry_id").where("trim(name) <> ''").select("entry_id", F.lower(F.trim("name")).alias("k"))
    p = t("vivc_passport")
    stages = [("prime", F.col("k"), p.select(F.lower("prime_name").alias("pk"), "vivc_id"), "pk", "vivc_id"), ("slug", F.col("k"), p.select(F.replace(F.col("slug"), F.lit("-"), F.lit(" ")).alias("sk"), "vivc_id"), "sk", "vivc_id")]
    return resolve.staged(m, stages, "entry_id", "vivc_id").select("entry_id", "vivc_id", "method")


@query("""
WITH a AS (SELECT slug FROM gi_register WHERE status IS NULL OR lower(status) <> 'registered'), r AS (SELECT lower(coalesce(status, 'none')) AS status, lower(coalesce(kind, 'none')) AS kind, count(*) AS n, list_sort(list(DISTINCT country)) AS countries FROM gi_register GROUP BY 1, 2) SELECT * FROM r
""")
def register_statuses(t):
    """Register rows by status and kind under one spelling."""
    return t("gi_register").groupBy(F.lower(F.coalesce("status", F.lit("none"))).alias("status"), F.lower(F.coalesce("kind", F.lit("none"))).alias("kind")).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("country")).alias("countries"))


@query(f"""
WITH w AS ({LATEST}), o AS (SELECT rec_id, count(*) FILTER (communes_count > 0) OVER (PARTITION BY country) has, country, communes_count FROM w WHERE communes_count IS NOT NULL AND communes_count >= 0),
r AS (SELECT rec_id, country, communes_count, row_number() OVER (PARTITION BY country ORDER BY communes_count DESC, rec_id) rank FROM o)
SELECT rec_id, country, communes_count, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10
""")
def worst_ten(t):
    """The ten largest counters by country; -1 stands for not counted and is left out."""
    df = _wines(t).where("communes_count >= 0").select("rec_id", "country", "communes_count")
    return facets.top_per_group(df, "country", [F.desc("communes_count"), "rec_id"], 10)


@query("""
SELECT upper(substr(slug, 1, 1)) AS letter, count(*) AS n, min(slug) AS first_slug FROM gi_register GROUP BY 1
""")
def letter_index(t):
    """Entries by first letter."""
    return t("gi_register").groupBy(F.upper(F.substring("slug", 1, 1)).alias("letter")).agg(F.count("*").alias("n"), F.min("slug").alias("first_slug"))


@query(r"""
SELECT slug, trim(regexp_replace(regexp_replace(lower(strip_accents(name)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS made FROM gi_register WHERE name IS NOT NULL
UNION ALL SELECT slug, trim(regexp_replace(regexp_replace(lower(strip_accents(prime_name)), '[^\x00-\x7F]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') FROM vivc_passport WHERE prime_name IS NOT NULL
""")
def slugified_names(t):
    """Slugs made from names of places and of varieties."""
    names = tables.union_all([t("gi_register").select("slug", "name"), t("vivc_passport").select("slug", F.col("prime_name").alias("name"))])
    return names.where("name is not null").select("slug", keys.slugify(F.col("name")).alias("made"))


@query("""
SELECT slug, '<url><loc>https://example.org/' || replace(slug, '&', '&amp;') || '</loc><lastmod>' || strftime(max(loaded_at), '%Y-%m-%d') || '</lastmod></url>' AS entry FROM documents WHERE slug IS NOT NULL AND loaded_at IS NOT NULL GROUP BY slug
""")
def sitemap_entries(t):
    """Sitemap lines with the last change of each page."""
    d = t("documents").where("slug is not null and loaded_at is not null").groupBy("slug").agg(F.max("loaded_at").alias("at"))
    return d.select("slug", sinks.sitemap(F.concat(F.lit("https://example.org/"), "slug"), F.col("at")).alias("entry"))


@query("""
SELECT DISTINCT b.vivc_id, b.prime_name, min(a.vivc_id) OVER (PARTITION BY b.vivc_id) AS donor FROM vivc_passport b JOIN vivc_passport a ON a.species = b.species AND a.country = b.country AND a.color = b.color AND a.pedigree_confirmed AND NOT b.pedigree_confirmed
""")
def donor_records(t):
    """Records that borrow from the first confirmed one of the same species, country and colour."""
    p = t("vivc_passport")
    on = ["species", "country", "color"]
    donors = p.where("pedigree_confirmed").groupBy(*on).agg(F.min("vivc_id").alias("donor"))
    return p.where("not pedigree_confirmed").join(donors, on).select("vivc_id", "prime_name", "donor")


@query("""
WITH w AS (SELECT rec_id, name, row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) rn, count(*) OVER (PARTITION BY rec_id) c FROM wine_index) SELECT rec_id, name, c AS deliveries FROM w WHERE rn = 1 AND c > 1
""")
def redelivered_rows(t):
    """Keys delivered more than once, with their latest row."""
    n = t("wine_index").groupBy("rec_id").agg(F.count("*").alias("deliveries")).where("deliveries > 1")
    return latest_per_key(t("wine_index").select("rec_id", "name", "loaded_at"), ["rec_id"], ["loaded_at"]).join(n, "rec_id").select("rec_id", "name", "deliveries")


@query("""
WITH c(a, b) AS (VALUES ('bul', 'bg'), ('chi', 'zh'), ('deu', 'de'), ('dut', 'nl'), ('ell', 'el'), ('eng', 'en'), ('fra', 'fr'), ('fre', 'fr'), ('ger', 'de'), ('gre', 'el'), ('ita', 'it'), ('jpn', 'ja'), ('nld', 'nl'), ('por', 'pt'), ('spa', 'es'), ('tha', 'th'), ('zho', 'zh')),
h AS (SELECT DISTINCT finding_id, surface, confidence, lower(regexp_extract(trim(expected, ' '), '^([A-Za-z]{2,3})(?:$|[-_])', 1)) e, lower(regexp_extract(trim(detected, ' '), '^([A-Za-z]{2,3})(?:$|[-_])', 1)) d FROM audit_finding),
f AS (SELECT surface, confidence, CASE WHEN length(e) = 2 THEN e ELSE ce.b END e, CASE WHEN length(d) = 2 THEN d ELSE cd.b END d FROM h LEFT JOIN c ce ON ce.a = e LEFT JOIN c cd ON cd.a = d)
SELECT surface, count(*) AS total, count(*) FILTER (d IS NULL) AS undetected, count(*) FILTER (e = d) AS same, count(*) FILTER (e <> d AND confidence < 0.7) AS low, count(*) FILTER (e <> d AND confidence >= 0.7) AS mismatch FROM f GROUP BY 1
""")
def language_audit(t):
    """Counters of an earlier language audit by surface, labels however spelt."""
    f = once_per_key(t("audit_finding"), "finding_id").select("surface", keys.language_code(F.col("expected")).alias("e"), keys.language_code(F.col("detected")).alias("d"), "confidence")
    differ = F.col("e") != F.col("d")
    return f.groupBy("surface").agg(F.count("*").alias("total"), *tables.count_if(("undetected", F.col("d").isNull()), ("same", F.col("e") == F.col("d")), ("low", differ & (F.col("confidence") < 0.7)), ("mismatch", differ & (F.col("confidence") >= 0.7))))


@query("""
WITH u AS (SELECT 'ofag' source, name, CAST(NULL AS VARCHAR) country, tier FROM (SELECT DISTINCT entry_id, name, tier FROM ofag_entry) UNION ALL SELECT 'register', name, country, NULL FROM gi_register) SELECT source, count(*) AS n, count(country) AS with_country, count(tier) AS with_tier FROM u GROUP BY 1
""")
def corpus_union(t):
    """Corpora of different columns under one schema."""
    u = tables.union_all([once_per_key(t("ofag_entry"), "entry_id").select(F.lit("ofag").alias("source"), "name", "tier"), t("gi_register").select(F.lit("register").alias("source"), "name", "country")])
    return u.groupBy("source").agg(F.count("*").alias("n"), F.count("country").alias("with_country"), F.count("tier").alias("with_tier"))


@query(f"""
WITH w AS ({LATEST}), g AS (SELECT slug, country rc FROM gi_register) SELECT w.rec_id, CASE WHEN coalesce(stub, false) THEN coalesce(rc, country) ELSE coalesce(nullif(trim(country), ''), rc, country) END AS country FROM w LEFT JOIN g ON g.slug = w.parent_slug
""")
def sidecar_merge(t):
    """Stubs take the register's country, other records only where theirs is missing."""
    df = _wines(t).select("rec_id", "parent_slug", "country", F.coalesce("stub", F.lit(False)).alias("stub"))
    side = t("gi_register").select(F.col("slug").alias("parent_slug"), "country")
    return resolve.fill_empty(df, side, "parent_slug", ["country"], F.col("stub")).select("rec_id", "country")

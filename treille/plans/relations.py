"""Queries of joins, resolvers, trees, facets, boxes and differences."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from treille.functions import keys
from treille.functions.similarity import shortened
from treille.operators import facets, geo, hierarchy, resolve, tables
from treille.operators.dedup import latest_per_key
from treille.plans.lineage import new_path
from treille.plans.queries import query



def _band():
    return F.when(F.col("c_acctbal") < 0, "negative").when(F.col("c_acctbal") < 5000, "low").otherwise("high")


BAND_SQL = "CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END"


@query(f"""
WITH c AS (SELECT c_mktsegment seg, n_name nation, {BAND_SQL} band FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT *, seg IN ('BUILDING', 'MACHINERY') ps, nation IN ('NATION_0', 'NATION_3', 'NATION_7') pn, band IN ('low', 'high') pb FROM c)
SELECT 'segment' AS facet, seg AS value, count(*) AS n FROM p WHERE pn AND pb GROUP BY 2
UNION ALL SELECT 'nation', nation, count(*) FROM p WHERE ps AND pb GROUP BY 2
UNION ALL SELECT 'band', band, count(*) FROM p WHERE ps AND pn GROUP BY 2
""")
def facet_counts_excluding_own(t):
    """Counts by segment, nation and balance band, each under the filters of the others."""
    df = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("band", _band())
    chosen = {"segment": facets.any_of("c_mktsegment", ["BUILDING", "MACHINERY"]), "nation": facets.any_of("n_name", ["NATION_0", "NATION_3", "NATION_7"]), "band": facets.any_of("band", ["low", "high"])}
    return facets.counts_excluding_own(df, {"segment": F.col("c_mktsegment"), "nation": F.col("n_name"), "band": F.col("band")}, chosen)


@query(f"""
SELECT c_custkey, n_name, {BAND_SQL} AS band FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND n_name IN ('NATION_0', 'NATION_3', 'NATION_7') AND {BAND_SQL} <> 'negative'
""")
def facet_filter(t):
    """The rows that match every facet."""
    df = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("band", _band())
    return facets.matching(df, {"segment": facets.any_of("c_mktsegment", ["BUILDING", "MACHINERY"]), "nation": facets.any_of("n_name", ["NATION_0", "NATION_3", "NATION_7"]), "band": F.col("band") != "negative"}).select("c_custkey", "n_name", "band")


@query("""
SELECT r_name AS ancestor, count(DISTINCT o_custkey) AS records FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
UNION ALL SELECT n_name, count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT o_custkey) FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def tree_rollup_distinct(t):
    """Customers with orders by nation, region and over all, each counted once per node."""
    nations, regions = t("nation"), t("region")
    edges = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("node"), F.col("r_name").alias("parent")).unionByName(regions.select(F.col("r_name").alias("node"), F.lit("all").alias("parent")))
    buyers = t("orders").select("o_custkey").distinct().join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return hierarchy.roll_up(buyers, "o_custkey", "n_name", hierarchy.closure(edges))


@query("""
WITH RECURSIVE e AS (SELECT n_name node, r_name parent FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'all' FROM region),
c AS (SELECT node AS ancestor, node, 0 AS depth FROM (SELECT node FROM e UNION SELECT parent FROM e)
  UNION ALL SELECT e.parent, c.node, c.depth + 1 FROM c JOIN e ON c.ancestor = e.node)
SELECT ancestor, node, CAST(depth AS INTEGER) AS depth FROM c
""")
def descendants_closure(t):
    edges = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("node"), F.col("r_name").alias("parent")).unionByName(t("region").select(F.col("r_name").alias("node"), F.lit("all").alias("parent")))
    return hierarchy.closure(edges)


@query("""
SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 300000 THEN o_orderpriority END, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END, n_name) AS value,
  CASE WHEN o_totalprice > 300000 AND o_orderpriority IS NOT NULL THEN 'order' WHEN c_acctbal > 5000 AND c_mktsegment IS NOT NULL THEN 'customer' WHEN n_name IS NOT NULL THEN 'nation' END AS source
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def priority_resolver(t):
    """The first source that has a value, with its name."""
    df = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    steps = [("order", F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))), ("customer", F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment"))), ("nation", F.col("n_name"))]
    return df.select("o_orderkey", *resolve.first_by_priority(steps))


@query("""
WITH l AS (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) rn FROM orders)
SELECT c_custkey, o_orderkey AS last_order, o_orderdate AS last_date FROM customer LEFT JOIN l ON o_custkey = c_custkey AND rn = 1
""")
def rescue_join_latest(t):
    """Each customer with the latest order, found once per key and joined back."""
    last = latest_per_key(t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return t("customer").join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("o_orderkey").alias("last_order"), F.col("o_orderdate").alias("last_date"))


@query("""
SELECT DISTINCT o_custkey AS custkey, false AS stub, CAST(NULL AS VARCHAR) AS stub_reason FROM orders
UNION ALL SELECT c_custkey, true, 'no-order' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def stub_anti_union(t):
    """Placeholders for the spine's rows without a record."""
    seen = t("orders").select(F.col("o_custkey").alias("custkey")).distinct()
    missing = t("customer").select(F.col("c_custkey").alias("custkey")).join(seen, "custkey", "left_anti")
    return tables.union_all([seen.withColumn("stub", F.lit(False)), missing.withColumns({"stub": F.lit(True), "stub_reason": F.lit("no-order")})]).select("custkey", "stub", "stub_reason")


@query("""
WITH w AS (SELECT DISTINCT slug FROM wine_index), m AS (SELECT w.slug, g.slug AS umbrella FROM w JOIN gi_register g ON starts_with(w.slug, g.slug || '-'))
SELECT w.slug, (SELECT max_by(umbrella, length(umbrella)) FROM m WHERE m.slug = w.slug) AS umbrella FROM w
""")
def longest_prefix_umbrella(t):
    """Each record under the register entry with the longest name it begins with."""
    return resolve.longest_prefix(t("wine_index").select("slug").distinct(), "slug", t("gi_register").select(F.col("slug").alias("umbrella")), "umbrella")


@query("""
SELECT event_id, user_id, ts, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_error FROM events
""")
def asof_anchor(t):
    """Each event with the user's last error at or before it."""
    return resolve.preceding(t("events").select("event_id", "user_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "error", F.col("event_id")), "last_error").select("event_id", "user_id", "ts", "last_error")


@query("""
WITH places AS (SELECT 's' || CAST(s_suppkey % 7 AS VARCHAR) || '-' || CAST(s_suppkey % 3 AS VARCHAR) AS name, s_nationkey AS grp, s_suppkey AS code FROM supplier),
cnt AS (SELECT *, count(*) OVER (PARTITION BY name) n FROM places UNION ALL SELECT 'u' || CAST(s_suppkey AS VARCHAR), s_nationkey, s_suppkey, 1 FROM supplier),
m AS (SELECT DISTINCT l_orderkey doc, 's' || CAST(l_suppkey % 7 AS VARCHAR) || '-' || CAST(l_suppkey % 3 AS VARCHAR) AS name FROM lineitem UNION SELECT DISTINCT l_orderkey, 'u' || CAST(l_suppkey AS VARCHAR) FROM lineitem WHERE l_linenumber = 1),
j AS (SELECT m.doc, m.name, cnt.grp, cnt.code, cnt.n FROM m JOIN cnt USING (name)),
v AS (SELECT doc, grp, count(*) votes FROM j WHERE n = 1 GROUP BY 1, 2),
r AS (SELECT j.*, row_number() OVER (PARTITION BY j.doc, j.name ORDER BY coalesce(votes, 0) DESC, code) rn FROM j LEFT JOIN v ON v.doc = j.doc AND v.grp = j.grp)
SELECT doc, name, grp, code, n = 1 AS certain FROM r WHERE rn = 1
""")
def two_pass_context_vote(t):
    """Ambiguous supplier names settled by the nations of the certain ones in the same order."""
    short = lambda c: F.concat(F.lit("s"), (c % 7).cast("string"), F.lit("-"), (c % 3).cast("string"))
    full = lambda c: F.concat(F.lit("u"), c.cast("string"))
    s, li = t("supplier"), t("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    places = tables.union_all([s.select(f(F.col("s_suppkey")).alias("name"), F.col("s_nationkey").alias("grp"), F.col("s_suppkey").alias("code")) for f in (short, full)])
    mentions = tables.union_all([li.select(F.col("l_orderkey").alias("doc"), short(F.col("l_suppkey")).alias("name")), li.where("l_linenumber = 1").select(F.col("l_orderkey").alias("doc"), full(F.col("l_suppkey")).alias("name"))])
    return resolve.context_vote(mentions, "doc", "name", places, "grp", "code")


@query("""
SELECT DISTINCT w.parent_name, g.slug FROM wine_index w JOIN gi_register g
ON regexp_replace(lower(strip_accents(w.parent_name)), '[^a-z0-9]', '', 'g') = regexp_replace(lower(strip_accents(g.name)), '[^a-z0-9]', '', 'g') WHERE w.parent_name <> ''
""")
def normalised_key_join(t):
    """Parent names joined to the register by letters and digits only."""
    left = t("wine_index").where("parent_name <> ''").select("parent_name").distinct().withColumn("k", keys.squeeze(F.col("parent_name")))
    return left.join(t("gi_register").select("slug", keys.squeeze(F.col("name")).alias("k")), "k").select("parent_name", "slug").distinct()


@query("""
WITH s AS (SELECT lower(prime_name) surface, vivc_id, 1 tier, vivc_id ord FROM vivc_passport UNION ALL SELECT replace(slug, '-', ' '), vivc_id, 2, vivc_id FROM vivc_passport
  UNION ALL SELECT lower(name), vivc_id, CASE WHEN official_in IS NOT NULL THEN 3 ELSE 4 END, syn_id FROM vivc_synonym WHERE name IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY tier, ord, vivc_id) rn FROM s)
SELECT surface, vivc_id, CAST(tier AS INTEGER) AS tier FROM r WHERE rn = 1
""")
def vocabulary_precedence(t):
    """One variety per surface: the name of the first tier that has it."""
    p, s = t("vivc_passport"), t("vivc_synonym").where("name is not null")
    surfaces = tables.union_all([
        p.select(F.lower("prime_name").alias("surface"), "vivc_id", F.lit(1).alias("tier"), F.col("vivc_id").alias("ord")),
        p.select(F.replace(F.col("slug"), F.lit("-"), F.lit(" ")).alias("surface"), "vivc_id", F.lit(2).alias("tier"), F.col("vivc_id").alias("ord")),
        s.select(F.lower("name").alias("surface"), "vivc_id", F.when(F.col("official_in").isNotNull(), 3).otherwise(4).alias("tier"), F.col("syn_id").alias("ord")),
    ])
    best = surfaces.groupBy("surface").agg(F.min(F.struct("tier", "ord", "vivc_id")).alias("b"))
    return best.select("surface", F.col("b.vivc_id").alias("vivc_id"), F.col("b.tier").alias("tier"))


@query("""
WITH n AS (SELECT slug, name, CASE WHEN length(name) <= 6 THEN 1 WHEN length(name) <= 12 THEN 2 ELSE 3 END lim FROM gi_register)
SELECT a.slug AS slug_a, b.slug AS slug_b, CAST(levenshtein(a.name, b.name) AS INTEGER) AS edits FROM n a JOIN n b ON a.slug < b.slug
WHERE levenshtein(a.name, b.name) <= least(a.lim, b.lim) AND (substr(a.name, 1, 1) = substr(b.name, 1, 1) OR greatest(length(a.name), length(b.name)) > 6)
""")
def fuzzy_levenshtein_match(t):
    """Register names that may be one name mistyped, the first letter too unless both have up to 6 letters; found by shared forms after deletions."""
    n = t("gi_register").select("slug", "name", F.when(F.length("name") <= 6, 1).when(F.length("name") <= 12, 2).otherwise(3).alias("lim")).where("name is not null")
    forms = n.select("slug", F.explode(shortened("name", "lim")).alias("x"))
    pairs = forms.alias("a").join(forms.alias("b").hint("merge"), (F.col("a.x") == F.col("b.x")) & (F.col("a.slug") < F.col("b.slug"))).select(F.col("a.slug").alias("slug_a"), F.col("b.slug").alias("slug_b")).distinct()
    side = lambda s: n.select(F.col("slug").alias(f"slug_{s}"), F.col("name").alias(f"name_{s}"), F.col("lim").alias(f"lim_{s}"))
    d = F.levenshtein("name_a", "name_b")
    same = F.substring("name_a", 1, 1) == F.substring("name_b", 1, 1)
    hit = pairs.join(side("a"), "slug_a").join(side("b"), "slug_b").where((d <= F.least("lim_a", "lim_b")) & (same | (F.greatest(F.length("name_a"), F.length("name_b")) > 6)))
    return hit.select("slug_a", "slug_b", d.alias("edits"))


@query("""
WITH o AS (SELECT c_custkey, max(c_acctbal) bal FROM customer GROUP BY 1), n AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN c_acctbal + 1 ELSE c_acctbal END bal FROM customer WHERE c_custkey % 13 <> 0 UNION ALL SELECT c_custkey + 10000000, c_acctbal FROM customer WHERE c_custkey % 50 = 0),
x AS (SELECT * FROM o WHERE c_custkey % 17 <> 0)
SELECT coalesce(x.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN x.c_custkey IS NULL THEN 'added' WHEN n.c_custkey IS NULL THEN 'removed' WHEN x.bal <> n.bal THEN 'changed' ELSE 'same' END AS status FROM x FULL JOIN n ON x.c_custkey = n.c_custkey
""")
def snapshot_diff(t):
    """Two states of a table compared by content hash. The states are made here: rows changed, removed and added by rule."""
    c = t("customer").select("c_custkey", "c_acctbal")
    old = c.where("c_custkey % 17 <> 0").select("c_custkey", keys.content_key(F.col("c_acctbal").cast("string")).alias("sha"))
    now = c.where("c_custkey % 13 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("bal"))
    new = now.unionByName(c.where("c_custkey % 50 = 0").select((F.col("c_custkey") + 10000000).alias("c_custkey"), F.col("c_acctbal").alias("bal")))
    return tables.snapshot_diff(old, new.select("c_custkey", keys.content_key(F.col("bal").cast("string")).alias("sha")), "c_custkey", "sha")


@query("""
SELECT g.slug, w.s IS NOT NULL AS indexed, c.s IS NOT NULL AS extracted, d.s IS NOT NULL AS documented,
  CASE WHEN w.s IS NULL THEN 'indexed' WHEN c.s IS NULL THEN 'extracted' WHEN d.s IS NULL THEN 'documented' ELSE 'none' END AS lost_at
FROM gi_register g LEFT JOIN (SELECT DISTINCT parent_slug s FROM wine_index) w ON w.s = g.slug LEFT JOIN (SELECT DISTINCT slug s FROM cahier_extract WHERE raw_text IS NOT NULL) c ON c.s = g.slug LEFT JOIN (SELECT DISTINCT slug s FROM documents) d ON d.s = g.slug
""")
def funnel_audit(t):
    """Where each register entry drops out of the stages."""
    return tables.funnel(t("gi_register").select("slug"), "slug", [("indexed", t("wine_index"), "parent_slug"), ("extracted", t("cahier_extract").where("raw_text is not null"), "slug"), ("documented", t("documents"), "slug")])


@query("""
WITH p AS (SELECT p_brand, p_type, p_size, min(p_name) v, count(*) n FROM part WHERE p_retailprice > 1500 GROUP BY 1, 2, 3)
SELECT p_partkey, CASE WHEN p.n = 1 THEN p.v ELSE p_name END AS p_name, coalesce(p.n = 1, false) AS patched FROM part LEFT JOIN p USING (p_brand, p_type, p_size)
""")
def conditional_patch(t):
    """Names replaced where exactly one patch matches on all keys."""
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return tables.patch(part.drop("p_retailprice"), part.where("p_retailprice > 1500").select("p_brand", "p_type", "p_size", F.col("p_name").alias("new_name")), ["p_brand", "p_type", "p_size"], "p_name", "new_name", "skip").select("p_partkey", "p_name", "patched")


@query("""
SELECT user_id, min(value) AS minx, max(value) AS maxx, min(event_id) AS miny, max(event_id) AS maxy FROM events GROUP BY 1
""")
def dissolve_bbox(t):
    """The box around all points of a group."""
    return t("events").groupBy("user_id").agg(F.min("value").alias("minx"), F.max("value").alias("maxx"), F.min("event_id").alias("miny"), F.max("event_id").alias("maxy"))


@query("""
WITH p AS (SELECT s_suppkey k, s_nationkey nk, CAST(s_suppkey % 120 - 60 AS DOUBLE) lat, CAST(s_suppkey * 7 % 360 - 180 AS DOUBLE) lon FROM supplier),
l AS (SELECT k, lat, lon, lag(k) OVER w pk, lag(lat) OVER w plat, lag(lon) OVER w plon FROM p WINDOW w AS (PARTITION BY nk ORDER BY k))
SELECT pk AS a, k AS b, round(2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))), 3) AS km FROM l WHERE pk IS NOT NULL
""")
def haversine_steps(t):
    """Distances from each supplier of a nation to the next; the places are derived from their keys."""
    p = t("supplier").select(F.col("s_suppkey").alias("k"), "s_nationkey", (F.col("s_suppkey") % 120 - 60).cast("double").alias("lat"), (F.col("s_suppkey") * 7 % 360 - 180).cast("double").alias("lon"))
    w = Window.partitionBy("s_nationkey").orderBy("k")
    p = p.withColumns({"a": F.lag("k").over(w), "plat": F.lag("lat").over(w), "plon": F.lag("lon").over(w)}).where("a is not null")
    return p.select("a", F.col("k").alias("b"), F.round(geo.haversine(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon")), 3).alias("km"))


@query("""
WITH b AS (SELECT p_partkey id, p_partkey * 37 % 500 minx, p_partkey * 61 % 500 miny, p_partkey * 37 % 500 + p_size maxx, p_partkey * 61 % 500 + p_size maxy, p_size * p_size ar FROM part),
j AS (SELECT a.id a, b.id b, (least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * (least(a.maxy, b.maxy) - greatest(a.miny, b.miny)) shared, least(a.ar, b.ar) lo
  FROM b a JOIN b ON a.id < b.id AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy)
SELECT a, b, CAST(shared AS BIGINT) AS shared, CASE WHEN shared * 10 >= lo * 9 THEN 'nested' WHEN shared * 10 >= lo THEN 'partial' ELSE 'sliver' END AS class FROM j
""")
def overlap_classify(t):
    """Overlapping boxes by a grid join, classed by the shared part of the smaller."""
    x, y = F.col("p_partkey") * 37 % 500, F.col("p_partkey") * 61 % 500
    boxes = t("part").select(F.col("p_partkey").alias("id"), x.alias("minx"), y.alias("miny"), (x + F.col("p_size")).alias("maxx"), (y + F.col("p_size")).alias("maxy"))
    share = F.when(F.col("shared") * 10 >= F.least("area_a", "area_b") * 9, "nested").when(F.col("shared") * 10 >= F.least("area_a", "area_b"), "partial").otherwise("sliver")
    return geo.box_overlaps(boxes, "id", 50, {"class": share}).withColumn("shared", F.col("shared").cast("bigint"))


@query("""
WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey ROWS UNBOUNDED PRECEDING) - CAST(o_totalprice AS DECIMAL(18, 2)) AS before_, sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (PARTITION BY o_custkey) AS whole FROM orders)
SELECT o_custkey, o_orderkey FROM o WHERE before_ >= 0.95 * whole
""")
def outlier_parts(t):
    """Parts outside the main body: the largest ones until 95 % are reached."""
    o = t("orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    w = Window.partitionBy("o_custkey").orderBy(F.desc("p"), "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    o = o.withColumns({"before": F.sum("p").over(w) - F.col("p"), "whole": F.sum("p").over(Window.partitionBy("o_custkey"))})
    return o.where(F.col("before") >= F.lit(0.95).cast("decimal(3,2)") * F.col("whole")).select("o_custkey", "o_orderkey")


@query("""
WITH r AS (SELECT c_nationkey, c_custkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_name, c_custkey) rn FROM customer)
SELECT c_nationkey, c_custkey, c_name FROM r WHERE rn = 1
""")
def group_representative(t):
    """One member per group by a total order."""
    rank = F.struct((-F.col("c_acctbal")).alias("x"), "c_name", "c_custkey")
    return t("customer").groupBy("c_nationkey").agg(F.min_by(F.struct("c_custkey", "c_name"), rank).alias("b")).select("c_nationkey", "b.c_custkey", "b.c_name")


@query("""
WITH e AS (SELECT 'region' kind, lower(r_name) label, CAST(r_regionkey AS BIGINT) k FROM region UNION ALL SELECT 'nation', lower(n_name), CAST(n_nationkey AS BIGINT) FROM nation UNION ALL SELECT 'supplier', lower(s_name), s_suppkey FROM supplier UNION ALL SELECT 'customer', lower(c_name), c_custkey FROM customer),
s AS (SELECT *, CASE WHEN starts_with(label, 'n') THEN 100 WHEN contains(label, 'n') THEN 80 ELSE 0 END score FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY score DESC, label, k) AS rank FROM s WHERE score > 0)
SELECT kind, label, k, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
""")
def topk_federated_search(t):
    """The best five hits of each kind of entity for one query."""
    kinds = [("region", "r_name", "r_regionkey"), ("nation", "n_name", "n_nationkey"), ("supplier", "s_name", "s_suppkey"), ("customer", "c_name", "c_custkey")]
    rows = tables.union_all([t(k).select(F.lit(k).alias("kind"), F.lower(n).alias("label"), F.col(i).cast("bigint").alias("k")) for k, n, i in kinds])
    rows = rows.withColumn("score", facets.search_score(F.col("label"), "n")).where("score > 0")
    return facets.top_per_group(rows, "kind", [F.desc("score"), "label", "k"], 5)


@query("""
WITH b AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 1 AND p_retailprice > 1 THEN CAST(round((p_size - 1) * (p_retailprice - 1), 2) AS DOUBLE) END area FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY coalesce(area, 'infinity'::DOUBLE), p_partkey) rank FROM b)
SELECT p_partkey, p_brand, CAST(rank AS INTEGER) AS rank FROM r
""")
def locality_rank(t):
    """Hits under a point, the smallest box first and degenerate ones last."""
    area = geo.box_area(F.lit(1), F.lit(1), F.col("p_size"), F.col("p_retailprice"))
    df = t("part").select("p_partkey", "p_brand", F.coalesce(F.round(area, 2), F.lit(float("inf"))).alias("area"))
    return df.select("p_partkey", "p_brand", F.row_number().over(Window.partitionBy("p_brand").orderBy("area", "p_partkey")).alias("rank"))


@query("""
SELECT p_name, count(DISTINCT p_brand) AS brands, min(p_brand) AS first_brand FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1
""")
def ambiguous_keys(t):
    """Surfaces claimed by more than one owner."""
    return t("part").groupBy("p_name").agg(F.countDistinct("p_brand").alias("brands"), F.min("p_brand").alias("first_brand")).where("brands > 1")


@query("""
WITH o AS (SELECT c_nationkey, list_sort(list(o_totalprice)) a FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT c_nationkey, a[greatest(len(a) // 4, 1)] AS q1, a[3 * len(a) // 4 + 1] AS q3 FROM o WHERE len(a) >= 4
""")
def area_quartiles(t):
    """Quartiles by position: the value at n//4 - 1 and at 3n//4, counted from 0; only the ranges that hold them are ranked."""
    o = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "o_totalprice")
    n = F.col("n")
    return tables.value_at(o, "c_nationkey", "o_totalprice", {"q1": F.greatest(F.floor(n / 4), F.lit(1)), "q3": F.floor(n * 3 / 4) + 1}, least=4)


@query("""
WITH l AS (SELECT user_id, event_type, event_id, ts, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) rn FROM events)
SELECT user_id, event_type, event_id, ts, value FROM l WHERE rn = 1
""")
def incremental_upsert(t):
    """The state after a stream of all batches: the latest row per key, by the streaming upsert into hash buckets."""
    from treille.streaming.incremental import latest_version, upsert_stream

    e = t("events").select("user_id", "event_type", "event_id", "ts", "value")
    base = new_path(e.sparkSession, "upsert")
    e.repartition(3, "event_id").write.parquet(f"{base}/in")  # arrives in three files, in any order
    upsert_stream(e.sparkSession, f"{base}/in", e.schema, f"{base}/table", f"{base}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"], buckets=8)
    return latest_version(e.sparkSession, f"{base}/table", e.schema)


@query("""
SELECT n_regionkey, count(*) AS members, count(*) FILTER (n_nationkey % 3 = 0 OR n_regionkey = 2) AS selected,
 CASE WHEN count(*) FILTER (n_nationkey % 3 = 0 OR n_regionkey = 2) = 0 THEN 'none' WHEN count(*) FILTER (n_nationkey % 3 = 0 OR n_regionkey = 2) = count(*) THEN 'all' ELSE 'some' END AS state FROM nation GROUP BY 1
""")
def tri_state_selection(t):
    """Groups whose members are all, some or none selected."""
    g = t("nation").groupBy("n_regionkey").agg(F.count("*").alias("members"), *tables.count_if(("selected", (F.col("n_nationkey") % 3 == 0) | (F.col("n_regionkey") == 2))))
    return g.withColumn("state", F.when(F.col("selected") == 0, "none").when(F.col("selected") == F.col("members"), "all").otherwise("some"))


@query("""
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) votes FROM customer GROUP BY 1, 2), m AS (SELECT c_nationkey, max(votes) top FROM c GROUP BY 1)
SELECT c.c_nationkey, min(c_mktsegment) AS c_mktsegment, max(votes) AS votes FROM c JOIN m ON m.c_nationkey = c.c_nationkey AND votes = top GROUP BY 1 HAVING count(*) = 1
""")
def majority_vote_label(t):
    """The label with most votes; shared leads give none."""
    return resolve.majority(t("customer").select("c_nationkey", "c_mktsegment"), "c_nationkey", "c_mktsegment")


@query("""
WITH l0 AS (SELECT p_partkey, p_name, p_brand, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) i FROM part WHERE p_size <= 25), r0 AS (SELECT p_partkey k, p_name, p_brand, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) i FROM part WHERE p_size > 25),
s0 AS (SELECT l0.p_partkey, r0.k FROM l0 JOIN r0 USING (p_name, i)),
l1 AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) i FROM l0 WHERE p_partkey NOT IN (SELECT p_partkey FROM s0)), r1 AS (SELECT k, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY k) i FROM r0 WHERE k NOT IN (SELECT k FROM s0))
SELECT p_partkey, k AS other, 0 AS stage FROM s0 UNION ALL SELECT l1.p_partkey, r1.k, 1 FROM l1 JOIN r1 USING (p_brand, i)
""")
def one_to_one_assignment(t):
    """Rows paired one to one, by name first and by brand among what is left."""
    part = t("part").select("p_partkey", "p_name", "p_brand", "p_size")
    left, right = part.where("p_size <= 25"), part.where("p_size > 25").withColumnRenamed("p_partkey", "other")
    return tables.one_to_one(left, right, [("p_name", "p_name"), ("p_brand", "p_brand")], "p_partkey", "other")


@query("""
SELECT count(*) AS rows_seen, count(*) FILTER (c_acctbal < 0) AS hidden, min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def status_counts(t):
    """Matches, those only one gate hides, and the extent of the result, in one pass."""
    df = t("customer").where("c_mktsegment = 'BUILDING'")
    return df.agg(F.count("*").alias("rows_seen"), *tables.count_if(("hidden", F.col("c_acctbal") < 0)), F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))


@query("""
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS sum_price, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2
""")
def pricing_summary(t):
    """Totals and distinct counts over the largest table."""
    d = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(d("l_quantity").alias("sum_qty"), d("l_extendedprice").alias("sum_price"), F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("suppliers"))


@query("""
SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2
""")
def windowed_counts(t):
    """Tumbling windows, the batch form of the stream."""
    from treille.streaming.incremental import windowed_counts as counts

    return counts(t("events"), "ts", "event_type")


@query("""
WITH v AS (SELECT CAST(l_orderkey AS BIGINT) k, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) total FROM lineitem GROUP BY 1)
SELECT o_orderstatus, count(*) AS orders, CAST(sum(total) AS BIGINT) AS cents FROM orders JOIN v ON k = o_orderkey GROUP BY 1
""")
def order_totals(t):
    """A large fact table aggregated on the join key before it is joined."""
    v = t("lineitem").groupBy("l_orderkey").agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("total"))
    return t("orders").join(v, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.sum("total").alias("cents"))

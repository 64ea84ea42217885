"""Queries of scans, sinks and geometry; what a scan reads is first written from the tables to the shared folder."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from treille.functions import keys
from treille.operators import documents, geometry, grammar
from treille.operators.dedup import latest_per_key
from treille.plans.lineage import new_path
from treille.plans.queries import query
from treille.sources import geofiles, readers, sinks

LATEST = "SELECT * FROM wine_index QUALIFY row_number() OVER (PARTITION BY rec_id ORDER BY loaded_at DESC) = 1"


def _wines(t):
    w = t("wine_index").select("rec_id", "name", "kind", "stub", "id_appellation", "id_denomination_geo", "categories", "loaded_at")
    return latest_per_key(w, ["rec_id"], ["loaded_at"])


@query("SELECT slug, nullif(name, '') AS name, nullif(country, '') AS country, nullif(kind, '') AS kind, nullif(file_number, '') AS file_number, nullif(status, '') AS status FROM gi_register")
def csv_scan(t):
    """The register through delimited text in Latin-1 with a header."""
    df = t("gi_register")
    path = new_path(df.sparkSession, "csv")
    df.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return readers.delimited(df.sparkSession, path, "slug string, name string, country string, kind string, file_number string, status string", encoding="ISO-8859-1")


@query("SELECT CAST(n_regionkey AS VARCHAR) AS label, n_nationkey AS n_nationkey, n_name FROM nation")
def json_folder_scan(t):
    """Folders of JSON files, one record a file, under one schema with the folder's label."""
    df = t("nation")
    path = new_path(df.sparkSession, "json")
    df.select("n_regionkey", "n_nationkey", "n_name").write.partitionBy("n_regionkey").option("maxRecordsPerFile", 1).json(path)
    labels = [str(r[0]) for r in df.select("n_regionkey").distinct().orderBy("n_regionkey").collect()]  # a folder each
    got = readers.json_folders(df.sparkSession, {k: f"{path}/n_regionkey={k}" for k in labels}, "n_nationkey int, n_name string")
    return got.select("label", "n_nationkey", "n_name")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_suppkey % 120 - 60 AS DOUBLE) AS minx, CAST(s_suppkey % 70 AS DOUBLE) AS miny FROM supplier")
def geojson_split_scan(t):
    """Features of a collection that stands on one line, read in parts."""
    s = t("supplier")
    path = new_path(s.sparkSession, "geojson")
    x, y = F.col("s_suppkey") % 120 - 60, F.col("s_suppkey") % 70
    rows = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit('{"type":"Point","coordinates":['), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]}")).alias("g"))
    sinks.collection(rows, path, "g", ["id", "name"], ["id"])
    f = geofiles.split_features(s.sparkSession, path)
    # the coordinates of a point are a bare pair
    at = F.from_json("geometry", "coordinates array<double>")["coordinates"]
    return f.select(F.col("properties")["id"].alias("id"), F.col("properties")["name"].alias("name"), at[0].alias("minx"), at[1].alias("miny"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part")
def fixed_column_scan(t):
    """A printed table of fixed columns that names a brand only where it changes, filled again from above."""
    part = t("part").select("p_partkey", "p_brand", "p_size")
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    shown = F.when(F.row_number().over(w) % 40 == 1, F.col("p_brand")).otherwise("")
    block = F.floor((F.row_number().over(w) - 1) / 40)
    line = F.concat(F.rpad(shown, 16, " "), F.rpad(F.col("p_partkey").cast("string"), 12, " "), F.rpad(F.col("p_size").cast("string"), 6, " "))
    printed = part.select(F.concat_ws("/", "p_brand", block.cast("string")).alias("sheet"), F.col("p_partkey").alias("n"), line.alias("line"))
    cells = readers.fixed_columns(printed, "line", [("brand", 1, 16), ("p_partkey", 17, 12), ("p_size", 29, 6)])
    return grammar.carried(cells, ["sheet"], "n", ["brand"]).select("p_partkey", F.col("brand").alias("p_brand"), "p_size")


@query(r"""
WITH f AS (SELECT DISTINCT filename, regexp_extract(filename, '^(.*)-\d+\.pdf$', 1) family FROM cahier_extract WHERE filename IS NOT NULL) SELECT family, max(filename) AS filename FROM f WHERE family <> '' GROUP BY 1
""")
def newest_release(t):
    """Of the files of a family the one whose name comes last."""
    return geofiles.newest_release(t("cahier_extract").where("filename is not null"), "filename", r"^(.*)-\d+\.pdf$")


@query(f"""
WITH w AS ({LATEST}), f AS (SELECT * FROM w WHERE NOT coalesce(stub, false) AND upper(kind) IN ('AOC', 'AOP', 'DOP', 'IGP')), c AS (SELECT DISTINCT id_appellation, id_denomination_geo, unnest(categories) c FROM f)
SELECT f.id_appellation, f.id_denomination_geo, coalesce(string_agg(DISTINCT c.c, ';' ORDER BY c.c), '') AS categories FROM (SELECT DISTINCT id_appellation, id_denomination_geo FROM f) f
LEFT JOIN c ON c.id_appellation IS NOT DISTINCT FROM f.id_appellation AND c.id_denomination_geo IS NOT DISTINCT FROM f.id_denomination_geo AND c.c IS NOT NULL GROUP BY 1, 2
""")
def denomination_categories(t):
    """Denominations of published appellations with the union of their categories."""
    f = _wines(t).where(~F.coalesce("stub", F.lit(False)) & F.upper("kind").isin("AOC", "AOP", "DOP", "IGP"))
    rows = f.select("id_appellation", "id_denomination_geo", F.explode_outer("categories").alias("c"))
    return rows.groupBy("id_appellation", "id_denomination_geo").agg(F.array_join(F.array_sort(F.collect_set("c")), ";").alias("categories"))


@query(f"""
WITH w AS ({LATEST}) SELECT id_appellation, count(*) AS products, string_agg(DISTINCT kind, ';' ORDER BY kind) AS kinds FROM w WHERE id_appellation <> '' GROUP BY 1
""")
def appellation_products(t):
    """Appellations with their products."""
    return _wines(t).where("id_appellation <> ''").groupBy("id_appellation").agg(F.count("*").alias("products"), F.nullif(F.array_join(F.array_sort(F.collect_set("kind")), ";"), F.lit("")).alias("kinds"))


@query(f"""
WITH w AS ({LATEST}), k AS (SELECT regexp_replace(regexp_replace(lower(strip_accents(name)), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]', '', 'g') AS name_key, id_appellation, id_denomination_geo FROM w WHERE name <> '' AND id_denomination_geo <> '')
SELECT name_key, id_appellation, string_agg(DISTINCT id_denomination_geo, ';' ORDER BY id_denomination_geo) AS codes FROM k GROUP BY 1, 2
""")
def area_index(t):
    """Codes by name key and appellation."""
    w = _wines(t).where("name <> '' and id_denomination_geo <> ''")
    return w.groupBy(keys.squeeze(F.col("name")).alias("name_key"), "id_appellation").agg(F.array_join(F.array_sort(F.collect_set("id_denomination_geo")), ";").alias("codes"))


@query("SELECT vivc_id, prime_name, coalesce(color, '') AS color, country FROM vivc_passport")
def passport_fields(t):
    """Passports read from tables of two columns; the pages are made here, so the fields must come back."""
    p = t("vivc_passport")
    row = lambda k, c: F.coalesce(F.concat(F.lit(f"<tr><td>{k}:</td><td>"), F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("</td></tr>")), F.lit(""))
    html = F.concat(F.lit("<table>"), row("Prime name", F.col("prime_name")), row("Color", F.coalesce("color", F.lit(""))), row("Country", F.col("country")), F.lit("</table>"))
    cells = documents.tables(p.select("vivc_id", html.alias("h")), "vivc_id", "h")
    got = grammar.passport(cells, "vivc_id", "cells")
    field = lambda k: F.try_element_at("fields", F.lit(k))
    return got.select("vivc_id", field("Prime name").alias("prime_name"), field("Color").alias("color"), field("Country").alias("country"))


def _boxes(t):
    x, y = F.col("p_partkey") * 37 % 500, F.col("p_partkey") * 61 % 500
    return t("part").select("p_partkey", "p_brand", "p_size", x.alias("x0"), y.alias("y0"), geometry.rectangle(x, y, x + F.col("p_size"), y + F.col("p_size")).alias("g"))


@query("""
SELECT p_partkey, CAST(p_size * p_size AS DOUBLE) AS area, p_partkey * 37 % 500 + p_size / 2 AS cx, p_partkey * 61 % 500 + p_size / 2 AS cy FROM part
""")
def polygon_measures(t):
    """Area and centre of polygons from their rings."""
    c = geometry.centroid(F.col("g")[0]["outer"])
    return _boxes(t).select("p_partkey", geometry.area(F.col("g")).alias("area"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


@query("""
WITH p AS (SELECT s_suppkey, s_suppkey * 13 % 500 + 0.5 x, s_suppkey * 29 % 500 + 0.5 y FROM supplier), b AS (SELECT p_partkey, p_partkey * 37 % 500 x0, p_partkey * 61 % 500 y0, p_size FROM part)
SELECT s_suppkey, p_partkey FROM p JOIN b ON x > x0 AND x < x0 + p_size AND y > y0 AND y < y0 + p_size
""")
def points_in_polygons(t):
    """Places within polygons, by grid cells first and by their rings then."""
    points = t("supplier").select("s_suppkey", (F.col("s_suppkey") * 13 % 500 + 0.5).cast("double").alias("x"), (F.col("s_suppkey") * 29 % 500 + 0.5).cast("double").alias("y"))
    return geometry.points_in(points, "s_suppkey", _boxes(t), "p_partkey", "g", 50)


def _cells(t):
    x, y = F.col("p_partkey") * 7 % 40, F.col("p_partkey") * 11 % 40
    return t("part").select("p_brand", "p_partkey", geometry.rectangle(x, y, x + 1, y + 1).alias("g"))


@query("SELECT p_brand, CAST(count(DISTINCT (p_partkey * 7 % 40) * 40 + p_partkey * 11 % 40) AS DOUBLE) AS area FROM part GROUP BY 1")
def dissolved_area(t):
    """Area of the union of a brand's cells, from the outline that is left when shared borders cancel out."""
    return geometry.union_area(_cells(t), ["p_brand"], "g")


@query("SELECT p_brand, count(DISTINCT (p_partkey * 7 % 40) * 40 + p_partkey * 11 % 40) AS parts, count(*) AS members FROM part GROUP BY 1")
def dissolved_parts(t):
    """Parts of a brand's geometry, equal ones once."""
    return geometry.dissolve(_cells(t), ["p_brand"], "g").select("p_brand", F.size("g").cast("bigint").alias("parts"), "members")


@query("""
WITH b AS (SELECT DISTINCT p_brand, p_partkey * 37 % 500 x0, p_partkey * 61 % 500 y0, p_size FROM part), s AS (SELECT DISTINCT p_brand, p_partkey * 37 % 500 x0, p_partkey * 61 % 500 y0, p_size FROM part WHERE p_partkey % 50 = 0),
n AS (SELECT p_brand, count(*) n FROM s GROUP BY 1)
SELECT b.p_brand, count(*) - coalesce(max(n), 0) AS parts, CASE WHEN max(n) IS NULL THEN 'untouched' ELSE 'clipped' END AS status FROM b LEFT JOIN n USING (p_brand) GROUP BY 1
""")
def clipped_parts(t):
    """Parts that a list of centres and areas describes are taken out of a geometry."""
    whole = geometry.dissolve(_boxes(t), ["p_brand"], "g")
    specs = _boxes(t).where("p_partkey % 50 = 0").select("p_brand", (F.col("x0") + F.col("p_size") / 2).alias("cx"), (F.col("y0") + F.col("p_size") / 2).alias("cy"), (F.col("p_size") * F.col("p_size")).cast("double").alias("area"))
    return geometry.clipped(whole, "p_brand", "g", specs, 0.01, 0.001).select("p_brand", F.size("g").cast("bigint").alias("parts"), "status")


@query("SELECT c_custkey, round(c_custkey % 300 / 10.0 - 5, 6) AS lon, round(36 + c_custkey % 170 / 10.0, 6) AS lat FROM customer")
def equal_area_round_trip(t):
    """Places on the equal-area grid of Europe and back."""
    c = t("customer").select("c_custkey", (F.col("c_custkey") % 300 / 10.0 - 5).cast("double").alias("lon"), (36 + F.col("c_custkey") % 170 / 10.0).cast("double").alias("lat"))
    p = c.withColumn("p", geometry.to_equal_area(F.col("lon"), F.col("lat"))).withColumn("q", geometry.from_equal_area(F.col("p.x"), F.col("p.y")))
    return p.select("c_custkey", F.round("q.lon", 6).alias("lon"), F.round("q.lat", 6).alias("lat"))


@query("""
WITH p AS (SELECT c_custkey, c_custkey % 3600 / 10.0 - 180 lon, c_custkey % 1600 / 10.0 - 80 lat FROM customer)
SELECT '7/' || CAST(floor((lon + 180) / 360 * 128) AS INTEGER) || '/' || CAST(floor((0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 128) AS INTEGER) AS tile, count(*) AS places FROM p GROUP BY 1
""")
def tile_counts(t):
    """Places by map tile."""
    p = t("customer").select((F.col("c_custkey") % 3600 / 10.0 - 180).cast("double").alias("lon"), (F.col("c_custkey") % 1600 / 10.0 - 80).cast("double").alias("lat"))
    return p.groupBy(geometry.tile(F.col("lon"), F.col("lat"), 7).alias("tile")).agg(F.count("*").alias("places"))


@query(r"""
WITH p AS (SELECT rec_id, page, 'build/' || replace(page, '.md', '.' || substr(sha256(page), 1, 8) || '.md') f FROM wine_index WHERE page IS NOT NULL) SELECT DISTINCT 'build/' || page AS path FROM p WHERE NOT regexp_matches('build/' || page, '^build/val.*$')
""")
def logical_files(t):
    """Files of a build without the hashes in their names, but those a glob excludes."""
    hashed = F.concat(F.lit("build/"), F.replace(F.col("page"), F.lit(".md"), F.concat(F.lit("."), F.substring(F.sha2("page", 256), 1, 8), F.lit(".md"))))
    files = t("wine_index").where("page is not null").select(sinks.logical_path(hashed).alias("path")).distinct()
    return sinks.kept_files(files, "path", ["build/val*"])


@query("""
SELECT slug, '- [' || name || '](https://example.org/' || slug || ')' || CASE WHEN coalesce(status, '') <> '' THEN ': ' || status ELSE '' END AS line,
 '<xhtml:link rel="alternate" hreflang="fr" href="https://example.org/fr/' || slug || '"/><xhtml:link rel="alternate" hreflang="en" href="https://example.org/en/' || slug || '"/>' AS alternates FROM gi_register WHERE name IS NOT NULL
""")
def text_index(t):
    """Lines of a text index, with the links to other languages."""
    g = t("gi_register").where("name is not null")
    return g.select("slug", sinks.text_listing(F.col("name"), F.concat(F.lit("https://example.org/"), "slug"), F.col("status")).alias("line"), sinks.alternates(F.concat(F.lit("https://example.org/{locale}/"), "slug"), ["fr", "en"]).alias("alternates"))


@query("""
WITH b AS (SELECT slug, '<article><h1>' || name || '</h1>' || CASE WHEN coalesce(kind, '') || coalesce(country, '') = '' THEN '' ELSE '<dl>' || CASE WHEN coalesce(kind, '') = '' THEN '' ELSE '<dt>Kind</dt><dd>' || kind || '</dd>' END || CASE WHEN coalesce(country, '') = '' THEN '' ELSE '<dt>Country</dt><dd>' || country || '</dd>' END || '</dl>' END || '<p>' || name || ' &amp; more</p></article>' AS block FROM gi_register WHERE name IS NOT NULL)
SELECT slug, block, sha256(trim(regexp_replace(regexp_replace(block, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'))) AS signature FROM b
""")
def content_blocks(t):
    """Articles of the register with the hash of what can be read in them."""
    g = t("gi_register").where("name is not null")
    return g.select("slug", *sinks.content_block(F.col("name"), [("Kind", F.col("kind")), ("Country", F.col("country"))], F.array(F.concat("name", F.lit(" & more")), F.lit(" "))))

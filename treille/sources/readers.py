"""Scans: JSON folders, delimited and fixed-column text, GeoJSON, landed binaries, manifests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_folders(spark: SparkSession, folders: dict[str, str], schema: str) -> DataFrame:
    """Records of several folders of JSON files under one schema, with the folder's label; broken files give a null record, index files none."""
    def one(label: str, path: str) -> DataFrame:
        files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
        files = files.select(F.col("_metadata.file_name").alias("file"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
        return files.where("file <> '_index.json'").select(F.lit(label).alias("label"), "file", "r.*")

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [one(k, v) for k, v in folders.items()])


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a header and an explicit schema; a byte order mark and broken rows are borne."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep, encoding=encoding, mode="PERMISSIVE", enforceSchema=True)


def fixed_columns(df: DataFrame, line: str, columns: list[tuple[str, int, int]]) -> DataFrame:
    """Columns (name, start from 1, length) of lines of fixed width, blank ones null."""
    cut = {n: F.nullif(F.trim(F.substring(F.col(line), a, k)), F.lit("")) for n, a, k in columns}
    return df.withColumns(cut)


def features(spark: SparkSession, path: str) -> DataFrame:
    """(properties map, geometry json) of the features of GeoJSON collections, one row each."""
    whole = spark.read.text(path, wholetext=True)
    schema = "features array<struct<properties:map<string,string>,geometry:string>>"
    return whole.select(F.explode(F.from_json("value", schema)["features"]).alias("f")).select("f.properties", "f.geometry")


def bounds(geometry: Column) -> list[Column]:
    """minx, miny, maxx, maxy of a GeoJSON geometry's text, whatever its nesting."""
    points = F.regexp_extract_all(geometry, F.lit(r"\[\s*(-?[0-9.]+)\s*,\s*(-?[0-9.]+)"), F.lit(0))
    xy = F.transform(points, lambda p: F.split(F.regexp_replace(p, r"[\[\s]", ""), ",").cast("array<double>"))
    xs, ys = F.transform(xy, lambda p: p[0]), F.transform(xy, lambda p: p[1])
    return [F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")]


def landed_pdfs(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha, is_pdf) of landed files by their first bytes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha"), (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("is_pdf"))


def looks_like_document(html: Column, marks: str, least: int = 8192) -> Column:
    """No interstitial page: long enough and with one of the marks."""
    return (F.length(html) > least) & html.rlike(marks)


# Words for a corrigendum in the languages of the register.
CORRIGENDUM = r"(?i)corrigend|rectificat|berichtigung|rettific|retificaç|corrección|διορθωτ|поправк|oprav|helyesb|ispravak|popravek|rectificare|rettifika|parandus|labojum|klaidų"


def best_publication(publications: Column) -> Column:
    """Of (uri, text) structs the best link: a C series text (``C 12``) that is no corrigendum, any such, any link; then the first."""
    def rank(p: Column) -> Column:
        text = F.coalesce(p["text"], F.lit(""))
        c = text.rlike(r"(?U)(?<![\p{L}\p{N}])C\s?/?\d")
        return F.when(~F.coalesce(p["uri"].startswith("http"), F.lit(False)), 9).when(c & ~text.rlike(CORRIGENDUM), 0).when(c, 1).otherwise(2)

    ranked = F.transform(publications, lambda p, i: F.struct(rank(p).alias("r"), i.alias("i"), p["uri"].alias("uri")))
    best = F.array_min(F.filter(ranked, lambda x: x["r"] < 9))
    return best["uri"]


def response_kind(content_type: Column, content: Column) -> Column:
    """html, pdf or none of a response, by its first bytes before what its header claims."""
    head = F.substring(content, 1, 4)
    claimed = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(head == F.lit(b"%PDF"), "pdf").when(claimed.contains("html") & ~claimed.contains("pdf"), "html")


def link_candidates(override: Column, harvested: Column, most: int | None = None) -> Column:
    """Links to try in order: those set by hand, then those harvested, each once."""
    none = F.array().cast("array<string>")
    all_ = F.array_distinct(F.array_compact(F.concat(F.coalesce(override, none), F.coalesce(harvested, none))))
    return F.slice(all_, 1, most) if most else all_


def first_success(tries: DataFrame, key: str, order: str, ok: str) -> DataFrame:
    """The first try of each key that succeeded; keys without one have no row."""
    others = [c for c in tries.columns if c != key]
    best = tries.where(F.col(ok)).groupBy(key).agg(F.min_by(F.struct(*others), F.col(order)).alias("_b"))
    return best.select(key, *[F.col("_b")[c].alias(c) for c in others])


def after_cursor(weeks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Weeks (or other parts) of a crawl still to do: behind the last one done, and those before that were left out."""
    return weeks.join(done.select(*keys).distinct(), keys, "left_anti")


def upsert(manifest: DataFrame, news: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A fetch ledger with the latest row of each key."""
    from treille.operators.dedup import latest_per_key

    return latest_per_key(manifest.unionByName(news, allowMissingColumns=True), keys, order)

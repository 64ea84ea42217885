"""Sinks: ordered JSON, GeoJSON, split payloads, pages, work items, synchronisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_json(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines in a total order, sorted by range: files in order hold the whole in order."""
    df.orderBy(*order).write.mode("overwrite").json(path)


def feature_rows(df: DataFrame, geometry: str, properties: list[str]) -> DataFrame:
    """(feature): one GeoJSON feature per row as text."""
    body = F.to_json(F.struct(*properties))
    return df.select(F.concat(F.lit('{"type":"Feature","properties":'), body, F.lit(',"geometry":'), F.coalesce(F.col(geometry), F.lit("null")), F.lit("}")).alias("feature"))


def split_payload(df: DataFrame, key: str, startup: list[str]) -> tuple[DataFrame, DataFrame]:
    """(startup columns, the rest as JSON with its hash), both by key."""
    rest = [c for c in df.columns if c not in startup and c != key]
    panel = F.to_json(F.struct(*rest))
    return df.select(key, *[c for c in startup if c != key]), df.select(key, panel.alias("panel"), F.sha2(panel, 256).alias("sha"))


def changed_only(panel: DataFrame, before: DataFrame, key: str, sha: str = "sha") -> tuple[DataFrame, DataFrame]:
    """(rows to write, keys to delete) against what was written before."""
    write = panel.join(before.select(key, sha), [key, sha], "left_anti")
    return write, before.select(key).join(panel.select(key), key, "left_anti")


def markdown(title: Column, facts: list[tuple[str, Column]], body: Column) -> Column:
    """A page: title, a list of the facts that are known, the text."""
    items = [F.when(v.isNotNull() & (v != ""), F.concat(F.lit(f"- {k}: "), v)) for k, v in facts]
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.nullif(F.concat_ws("\n", *items), F.lit("")), F.nullif(body, F.lit("")))


def linked_data(kind: str, **fields: Column) -> Column:
    """schema.org JSON of a record; null fields are left out."""
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit(kind).alias("@type"), *[v.alias(k) for k, v in fields.items()]))


def escape(c: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def sitemap(url: Column, changed: Column) -> Column:
    return F.concat(F.lit("<url><loc>"), escape(url), F.lit("</loc><lastmod>"), F.date_format(changed, "yyyy-MM-dd"), F.lit("</lastmod></url>"))


def accept_items(todo: DataFrame, filled: DataFrame, keys: list[str]) -> DataFrame:
    """Filled work items with a status: accepted, empty, stale (another source hash) or unknown. Both have sha; ``filled`` has text."""
    asked = todo.select(*keys, F.col("sha").alias("_sha"), F.lit(True).alias("_known"))
    joined = filled.join(asked, keys, "left")
    status = F.when(F.col("_known").isNull(), "unknown").when(F.col("sha") != F.col("_sha"), "stale").when(F.trim(F.coalesce("text", F.lit(""))) == "", "empty").otherwise("accepted")
    return joined.withColumn("status", status).drop("_sha", "_known")


def collection(df: DataFrame, path: str, geometry: str, properties: list[str], order: list[str]) -> None:
    """A GeoJSON collection as text files in a total order: joined, they are its features; each file holds a run of them, separated by commas."""
    feature_rows(df.orderBy(*order), geometry, properties).write.mode("overwrite").option("lineSep", ",").text(path)


def alternates(url: Column, locales: list[str]) -> Column:
    """Links of a page to its other languages, as a sitemap has them."""
    return F.concat(*[F.concat(F.lit(f'<xhtml:link rel="alternate" hreflang="{x}" href="'), escape(F.replace(url, F.lit("{locale}"), F.lit(x))), F.lit('"/>')) for x in locales])


def text_listing(title: Column, url: Column, note: Column) -> Column:
    """One line of a text index."""
    return F.concat(F.lit("- ["), title, F.lit("]("), url, F.lit(")"), F.when(F.coalesce(note, F.lit("")) != "", F.concat(F.lit(": "), note)).otherwise(""))


def content_block(title: Column, facts: list[tuple[str, Column]], paragraphs: Column) -> list[Column]:
    """(block, signature): an article of a record and the hash of its visible text, blanks aside; parts without content are left out."""
    rows = F.concat_ws("", *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"<dt>{k}</dt><dd>"), escape(v), F.lit("</dd>"))) for k, v in facts])
    body = F.array_join(F.transform(F.filter(paragraphs, lambda p: F.trim(p) != ""), lambda p: F.concat(F.lit("<p>"), escape(F.trim(p)), F.lit("</p>"))), "")
    block = F.concat(F.lit("<article><h1>"), escape(title), F.lit("</h1>"), F.when(rows != "", F.concat(F.lit("<dl>"), rows, F.lit("</dl>"))).otherwise(""), F.coalesce(body, F.lit("")), F.lit("</article>"))
    visible = F.trim(F.regexp_replace(F.regexp_replace(block, "<[^>]+>", " "), r"\s+", " "))
    return [block.alias("block"), F.sha2(visible, 256).alias("signature")]


def kept_files(df: DataFrame, path: str, excluded: list[str]) -> DataFrame:
    """Rows whose path fits none of the glob patterns; ``*`` stands for any part, ``?`` for one character."""
    import re

    for glob in excluded:
        pattern = "^" + re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".") + "$"
        df = df.where(~F.col(path).rlike(pattern))
    return df


def logical_path(path: Column) -> Column:
    """A path without the content hash in its file name (eight hexadecimal digits or more before the extension)."""
    return F.regexp_replace(path, r"[.-][0-9a-f]{8,}(?=\.[A-Za-z0-9]+$)", "")


def work_items(jobs: DataFrame, path: str, order: list[str]) -> None:
    """Work items for completion elsewhere, in order."""
    ordered_json(jobs, path, order)


def urls(columns: list[Column], most: int) -> Column:
    """At most ``most`` links in the order given, each once, empty ones left out."""
    return F.slice(F.array_distinct(F.array_compact(F.array(*[F.nullif(F.trim(c), F.lit("")) for c in columns]))), 1, most)

"""Documents to rows: HTML to text, links, tables, sections, roles, spans, dictionary tags."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Entities that occur in the sources.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def html_to_text(c: Column) -> Column:
    """Block ends to line ends, tags dropped, entities decoded, lines trimmed, blank lines dropped."""
    out = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>", "")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|td)>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "")
    for entity, sign in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(sign))
    lines = F.transform(F.split(out, "\n"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, href, pos): anchors in document order, each target at its first place."""
    found = df.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"']+)[\"']"), F.lit(1))).alias("pos", "href"))
    return found.groupBy(key, "href").agg(F.min("pos").alias("pos"))


class _Table(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[tuple[str, int]]] = []
        self.cell: list[str] | None = None
        self.span = 1

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            given = dict(attrs).get("rowspan") or "1"
            self.cell, self.span = [], int(given) if given.isdigit() else 1

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append((" ".join("".join(self.cell).split()), self.span))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(html: str) -> list[list[str]]:
    """Cells of the rows of an HTML table; a cell that spans rows stands in each of them."""
    parser = _Table()
    parser.feed(html or "")
    open_: dict[int, tuple[str, int]] = {}
    out = []
    for row in parser.rows:
        cells, given, at = [], iter(row), 0
        while True:
            if at in open_:
                text, left = open_[at]
                cells.append(text)
                if left > 1:
                    open_[at] = (text, left - 1)
                else:
                    del open_[at]
                at += 1
                continue
            nxt = next(given, None)
            if nxt is None:
                break
            cells.append(nxt[0])
            if nxt[1] > 1:
                open_[at] = (nxt[0], nxt[1] - 1)
            at += 1
        out.append(cells)
    return out


def tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row, cells array<string>) of the HTML tables of each document."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, cells) for k, h in zip(pdf[key], pdf[html]) for i, cells in enumerate(table_rows(h))]
            yield pd.DataFrame(rows, columns=[key, "row", "cells"])

    return df.select(key, html).mapInPandas(run, f"{key} {kind}, row int, cells array<string>")


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line), lines counted from 0 at each line feed."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def sections(df: DataFrame, key: str, text: str, header: str) -> DataFrame:
    """(key, ord, mark, title, body): the text from each header line to the next.

    ``header`` is a pattern with two groups, mark and title, for a whole line. Lines
    before the first header belong to no section.
    """
    rows = lines(df, key, text)
    w = Window.partitionBy(key).orderBy("line_no")
    rows = rows.withColumn("is_head", F.col("line").rlike(header)).withColumn("ord", F.sum(F.col("is_head").cast("int")).over(w))
    rows = rows.where("ord > 0")
    body = F.array_sort(F.collect_list(F.when(~F.col("is_head"), F.struct("line_no", "line"))))
    out = rows.groupBy(key, "ord").agg(F.max(F.when(F.col("is_head"), F.col("line"))).alias("head"), F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("body"))
    return out.select(key, "ord", F.regexp_extract("head", header, 1).alias("mark"), F.regexp_extract("head", header, 2).alias("title"), "body")


def contiguous(df: DataFrame, key: str, order: str, number: str) -> DataFrame:
    """Headers of the one chain 1, 2, 3...: a number counts only when it follows the last one taken."""
    got = df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(number).alias("n")))).alias("h"))
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<int>").alias("taken"))
    step = lambda s, x: F.when(x["n"] == s["last"] + 1, F.struct(x["n"].alias("last"), F.concat(s["taken"], F.array(x["o"])).alias("taken"))).otherwise(s)
    chain = got.withColumn("_chain", F.aggregate("h", start, step)["taken"])
    return chain.select(key, F.explode("_chain").alias(order)).join(df, [key, order])


def route(titles: DataFrame, key: str, title: str, order: str, keywords: DataFrame) -> DataFrame:
    """(key, role, title, order): for each role the title with its first keyword; the keyword's rank decides, then place.

    ``keywords`` has (role, keyword, rank), lower case: a table that comes with the code, at
    most 1,000 rows, which each title is compared with in place, without a join.
    """
    table = keywords.select("role", "keyword", "rank").limit(1001).collect()
    if len(table) > 1000:
        raise ValueError("more than 1,000 keywords")
    low = F.lower(F.col(title))
    told = F.array_compact(F.array(*[F.when(low.contains(k), F.struct(F.lit(role).alias("role"), F.lit(rank).alias("rank"))) for role, k, rank in table])) if table else F.array().cast("array<struct<role:string,rank:int>>")
    hit = titles.select("*", F.explode(told).alias("_h")).select(*titles.columns, "_h.role", "_h.rank")
    return hit.groupBy(key, "role").agg(F.min_by(F.struct(F.col(title), F.col(order)), F.struct("rank", order)).alias("b")).select(key, "role", F.col(f"b.{title}").alias(title), F.col(f"b.{order}").alias(order))


def without_overlaps(spans: DataFrame, key: str) -> DataFrame:
    """Spans (start, end, ...) that begin at or behind the end of every earlier kept one."""
    got = spans.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s"))
    zero = F.struct(F.lit(-1).cast("bigint").alias("upto"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("kept"))
    step = lambda a, x: F.when(x["start"] >= a["upto"], F.struct(x["end"].alias("upto"), F.concat(a["kept"], F.array(x)).alias("kept"))).otherwise(a)
    kept = got.select(key, F.explode(F.aggregate(F.transform("s", lambda x: F.struct(x["start"].cast("bigint").alias("start"), x["end"].cast("bigint").alias("end"))), zero, step)["kept"]).alias("_kept"))
    return kept.select(key, "_kept.start", "_kept.end")


def tag_terms(df: DataFrame, key: str, text: str, terms: DataFrame, term: str, most: int = 5) -> DataFrame:
    """(key, term, pos): dictionary terms of up to ``most`` words, longest match first from the left.

    Words are runs of letters of any script in lower case. Every n-gram of a text is joined to the
    dictionary by equality; of overlapping hits the leftmost, then the longest is kept.
    """
    words = df.select(key, F.posexplode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(\p{L}+)"), F.lit(1))).alias("p", "w"))
    at = Window.partitionBy(key).orderBy("p")
    nexts = [F.col("w"), *[F.lead("w", k).over(at) for k in range(1, most)]]
    words = words.select(key, (F.col("p") + 1).alias("i"), *[c.alias(f"w{k}") for k, c in enumerate(nexts)])
    gram = [F.when(F.col(f"w{n - 1}").isNotNull(), F.struct(F.lit(n).alias("n"), F.concat_ws(" ", *[f"w{k}" for k in range(n)]).alias("g"))) for n in range(1, most + 1)]
    grams = words.select(key, "i", F.explode(F.array_compact(F.array(*gram))).alias("x")).select(key, "i", "x.n", "x.g")
    hits = grams.join(terms.select(F.col(term).alias("g")).distinct(), "g")
    got = hits.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("i", (-F.col("n")).alias("neg"), "g"))).alias("h"))
    zero = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<i:int,g:string>>").alias("kept"))
    step = lambda a, x: F.when(x["i"] >= a["next"], F.struct((x["i"] - x["neg"]).alias("next"), F.concat(a["kept"], F.array(F.struct(x["i"].alias("i"), x["g"].alias("g")))).alias("kept"))).otherwise(a)
    return got.select(key, F.explode(F.aggregate("h", zero, step)["kept"]).alias("_kept")).select(key, F.col("_kept.g").alias(term), F.col("_kept.i").alias("pos"))


def shorten(c: Column, whole: int, cut: int) -> Column:
    """Blanks collapsed; longer texts cut at the last sentence end within ``cut`` characters, else there."""
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    head = F.substring(flat, 1, cut)
    sentence = F.regexp_extract(head, r"^(.*[.!?])(?: |$)", 1)
    return F.when(F.length(flat) <= whole, flat).when(sentence != "", sentence).otherwise(head)


def unreadable(c: Column, stop_words: list[str], least: float = 0.01) -> Column:
    """Whether a text has too few of its language's stop words per character to be text."""
    pattern = r"(?i)\b(" + "|".join(stop_words) + r")\b"
    return F.regexp_count(c, F.lit(pattern)) / F.greatest(F.length(c), F.lit(1)) < least

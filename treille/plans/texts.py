"""Queries of the document-parsing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from treille.functions import keys
from treille.functions.similarity import coverage
from treille.operators import documents, grounded, tables
from treille.operators.dedup import once_per_key
from treille.plans.queries import query

HEADER = r"^\f?([a-j])\) (.+)$"
CAHIERS = "SELECT * FROM cahier_extract QUALIFY row_number() OVER (PARTITION BY cahier_id ORDER BY loaded_at DESC) = 1"
LANGS = ["de", "en", "es", "fr", "it"]


def _cahiers(t):
    return once_per_key(t("cahier_extract"), "cahier_id")


_SECTIONS = f"""
l AS (SELECT cahier_id, unnest(string_split(raw_text, chr(10))) line, generate_subscripts(string_split(raw_text, chr(10)), 1) - 1 n FROM ({CAHIERS})),
h AS (SELECT *, regexp_matches(line, '^\\f?([a-j])\\) (.+)$') head FROM l),
o AS (SELECT *, sum(CAST(head AS INTEGER)) OVER (PARTITION BY cahier_id ORDER BY n) ord FROM h),
s AS (SELECT cahier_id, ord, max(CASE WHEN head THEN regexp_extract(line, '^\\f?([a-j])\\) (.+)$', 1) END) mark, max(CASE WHEN head THEN regexp_extract(line, '^\\f?([a-j])\\) (.+)$', 2) END) title,
  coalesce(string_agg(CASE WHEN NOT head THEN line END, chr(10) ORDER BY n), '') body FROM o WHERE ord > 0 GROUP BY 1, 2)
"""


@query(f"WITH {_SECTIONS} SELECT cahier_id, CAST(ord AS BIGINT) AS ord, mark, title, sha256(body) AS body_sha FROM s")
def section_slice(t):
    """Sections of the specifications from header to header."""
    return documents.sections(_cahiers(t).where("raw_text is not null"), "cahier_id", "raw_text", HEADER).select("cahier_id", "ord", "mark", "title", F.sha2("body", 256).alias("body_sha"))


@query(f"""
WITH {_SECTIONS}, k(role, keyword, rank) AS (VALUES ('link', 'lien', 1), ('link', 'legame', 2), ('link', 'vínculo', 3), ('link', 'zusammenhang', 4), ('area', 'délimitation', 1), ('area', 'zona', 2), ('area', 'gebiet', 3), ('yield', 'rend', 1), ('yield', 'rese', 2), ('yield', 'erträge', 3)),
x AS (SELECT cahier_id, role, title, ord, row_number() OVER (PARTITION BY cahier_id, role ORDER BY rank, ord) rn FROM s JOIN k ON contains(lower(title), keyword))
SELECT cahier_id, role, title, CAST(ord AS BIGINT) AS ord FROM x WHERE rn = 1
""")
def role_route_first_keyword(t):
    """Sections by role: the first keyword in a title decides."""
    words = [("link", "lien", 1), ("link", "legame", 2), ("link", "vínculo", 3), ("link", "zusammenhang", 4), ("area", "délimitation", 1), ("area", "zona", 2), ("area", "gebiet", 3), ("yield", "rend", 1), ("yield", "rese", 2), ("yield", "erträge", 3)]
    df = _cahiers(t)
    table = df.sparkSession.createDataFrame(words, "role string, keyword string, rank int")
    titles = documents.sections(df.where("raw_text is not null"), "cahier_id", "raw_text", HEADER).select("cahier_id", "title", "ord")
    return documents.route(titles, "cahier_id", "title", "ord", table)


@query("""
WITH h AS (SELECT doc_id, '<html><head><script>x = "<p>";</script></head><p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), chr(10), '</p>' || chr(10) || '<p class="n">') || '</p></html>' AS html FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha256(coalesce((SELECT string_agg(x, chr(10) ORDER BY i) FROM (SELECT trim(regexp_replace(u, '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'), ' ') x, i FROM (SELECT unnest(string_split(text, chr(10))) u, generate_subscripts(string_split(text, chr(10)), 1) i)) WHERE x <> ''), '')) AS text_sha FROM documents WHERE text IS NOT NULL
""")
def html_to_text(t):
    """Text of pages; the pages are made from the documents, so the text must come back."""
    d = t("documents").where("text is not null")
    inner = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n"), F.lit('</p>\n<p class="n">'))
    html = F.concat(F.lit('<html><head><script>x = "<p>";</script></head><p>'), inner, F.lit("</p></html>"))
    return d.select("doc_id", F.sha2(documents.html_to_text(html), 256).alias("text_sha"))


@query("""
WITH w AS (SELECT DISTINCT rec_id, page, parent_slug, slug FROM wine_index WHERE page IS NOT NULL), h AS (SELECT rec_id, page AS href, 0 AS pos FROM w UNION ALL SELECT rec_id, '/' || parent_slug, 1 FROM w WHERE parent_slug <> '' UNION ALL SELECT rec_id, '/' || slug, CASE WHEN parent_slug <> '' THEN 3 ELSE 2 END FROM w)
SELECT rec_id, href, CAST(min(pos) AS INTEGER) AS pos FROM h GROUP BY 1, 2
""")
def link_harvest_dedup(t):
    """Links of pages in document order, each at its first place; a page is made for each record, its own link twice."""
    w = t("wine_index").where("page is not null").select("rec_id", "page", "parent_slug", "slug").distinct()
    link = lambda href: F.concat(F.lit('<a class="x" href="'), href, F.lit('">p</a> '))
    up = F.when(F.col("parent_slug") != "", link(F.concat(F.lit("/"), "parent_slug"))).otherwise("")
    html = F.concat(link(F.col("page")), up, F.lit('<A HREF="'), "page", F.lit('">again</A>'), link(F.concat(F.lit("/"), "slug")))
    return documents.links(w.select("rec_id", html.alias("html")), "rec_id", "html")


@query("""
WITH f AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'), ' ') f FROM documents WHERE text IS NOT NULL)
SELECT doc_id, sha256(CASE WHEN length(f) <= 600 THEN f WHEN regexp_extract(f[1:300], '^(.*[.!?])(?: |$)', 1) <> '' THEN regexp_extract(f[1:300], '^(.*[.!?])(?: |$)', 1) ELSE f[1:300] END) AS summary_sha FROM f
""")
def summary_truncate(t):
    """Short texts whole, longer ones cut at a sentence end."""
    return t("documents").where("text is not null").select("doc_id", F.sha2(documents.shorten(F.col("text"), 600, 300), 256).alias("summary_sha"))


@query(f"""
SELECT cahier_id, CASE WHEN lien_au_terroir IS NULL OR length(lien_au_terroir) = 0 THEN 'none' WHEN length(lien_au_terroir) < 400 THEN 'verbatim' ELSE 'extract' END AS route, coalesce(length(lien_au_terroir) < 30, false) AS flagged FROM ({CAHIERS})
""")
def quality_routing(t):
    """Short texts pass as they are, longer ones go on to extraction."""
    n = F.length("lien_au_terroir")
    return _cahiers(t).select("cahier_id", F.when(n.isNull() | (n == 0), "none").when(n < 400, "verbatim").otherwise("extract").alias("route"), F.coalesce(n < 30, F.lit(False)).alias("flagged"))


@query("""
WITH d AS (SELECT doc_id, text, sha256(text) sha FROM documents WHERE text IS NOT NULL), g AS (SELECT sha, min(doc_id) anchor, count(*) n FROM d GROUP BY 1) SELECT doc_id, anchor, n AS sharing, length(text) AS answer FROM d JOIN g USING (sha)
""")
def prompt_dedup_replay(t):
    """Each distinct text is asked about once, and every document gets its answer."""
    d = t("documents").where("text is not null").select("doc_id", "text")
    asked = grounded.ask_once(d, "text", lambda batch: [str(len(x)) for x in batch])
    g = asked.groupBy("prompt_sha").agg(F.min("doc_id").alias("anchor"), F.count("*").alias("sharing"))
    return asked.join(g, "prompt_sha").select("doc_id", "anchor", "sharing", F.col("answer").cast("bigint").alias("answer"))


@query("""
WITH l(lang) AS (VALUES ('de'), ('en'), ('es'), ('fr'), ('it')), w AS (SELECT doc_id, l.lang, sha256(text) sha FROM documents d, l WHERE text IS NOT NULL AND coalesce(d.lang, '') <> l.lang),
c AS (SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE sha END sha FROM w WHERE doc_id % 2 = 0)
SELECT w.doc_id, w.lang, w.sha FROM w LEFT JOIN c USING (doc_id, lang, sha) WHERE c.doc_id IS NULL
""")
def stale_job_enumeration(t):
    """Translations that are missing or of another content. The cache is made here: every second document, some of them of old content."""
    langs = F.array(*[F.lit(x) for x in LANGS])
    d = t("documents").where("text is not null").select("doc_id", F.explode(langs).alias("lang"), F.sha2("text", 256).alias("sha"), F.coalesce("lang", F.lit("")).alias("own"))
    wanted = d.where("own <> lang").select("doc_id", "lang", "sha")
    cache = wanted.where("doc_id % 2 = 0").withColumn("sha", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.col("sha")))
    return tables.stale_jobs(wanted, cache, ["doc_id", "lang"], "sha")


@query(r"""
WITH g AS (SELECT DISTINCT array_to_string(regexp_extract_all(lower(name), '(\p{L}+)', 1), ' ') term FROM gi_register WHERE len(regexp_extract_all(lower(name), '(\p{L}+)', 1)) BETWEEN 1 AND 5),
w AS (SELECT doc_id, regexp_extract_all(lower(text), '(\p{L}+)', 1) w FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(w) x, generate_subscripts(w, 1) i FROM w),
l AS (SELECT doc_id, i, x, lead(x) OVER d x2, lead(x, 2) OVER d x3, lead(x, 3) OVER d x4, lead(x, 4) OVER d x5 FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT doc_id, i, x t, 1 n FROM l UNION ALL SELECT doc_id, i, x || ' ' || x2, 2 FROM l WHERE x2 IS NOT NULL UNION ALL SELECT doc_id, i, x || ' ' || x2 || ' ' || x3, 3 FROM l WHERE x3 IS NOT NULL
  UNION ALL SELECT doc_id, i, x || ' ' || x2 || ' ' || x3 || ' ' || x4, 4 FROM l WHERE x4 IS NOT NULL UNION ALL SELECT doc_id, i, x || ' ' || x2 || ' ' || x3 || ' ' || x4 || ' ' || x5, 5 FROM l WHERE x5 IS NOT NULL),
h AS (SELECT doc_id, term, i, n FROM m JOIN g ON term = t),
b AS (SELECT doc_id, i, arg_max(term, n) term, max(n) n FROM h GROUP BY 1, 2),
r AS (SELECT *, max(i + n) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) e FROM b)
SELECT doc_id, term, CAST(i AS INTEGER) AS pos FROM r WHERE e IS NULL OR i >= e
""")
def ngram_dictionary_tag(t):
    """Register names of up to five words of any script in the documents, leftmost and longest first."""
    words = F.regexp_extract_all(F.lower("name"), F.lit(r"(\p{L}+)"), F.lit(1))
    terms = t("gi_register").where(F.size(words).between(1, 5)).select(F.array_join(words, " ").alias("term"))
    return documents.tag_terms(t("documents").where("text is not null"), "doc_id", "text", terms, "term", 5)


@query()
def fact_grounding(t):
    """Quotes of the audit grounded in the text they come from and in the current specification (the one fetched last) of the slug their item's file names."""
    f = t("audit_finding").select("finding_id", "item_id", "snippet").where("snippet is not null")
    i = once_per_key(t("audit_item"), "item_id").select("item_id", F.col("text").alias("first"), F.regexp_extract("file", r"([^/]+)-[0-9]+\.json$", 1).alias("slug"))
    current = _cahiers(t).where("raw_text is not null").groupBy("slug").agg(F.max_by("raw_text", F.struct("fetched_at", "cahier_id")).alias("second"))
    return grounded.ground(f.join(i, "item_id").join(current, "slug", "left"), "snippet", "first", "second").select("finding_id", "cover_first", "cover_second", "provenance")


@query()
def snippet_coverage(t):
    """How much of each snippet its item's text covers."""
    f = t("audit_finding").select("finding_id", "item_id", "snippet")
    i = once_per_key(t("audit_item"), "item_id").select("item_id", "text")
    return f.join(i, "item_id").select("finding_id", F.bround(coverage(F.col("snippet"), F.col("text")), 3).alias("covered"))


@query(f"""
WITH c AS ({CAHIERS}), l AS (SELECT cahier_id, unnest(string_split(raw_text, chr(10))) line FROM c) SELECT cahier_id, count(*) AS lines, count(*) FILTER (trim(line) = '') AS blank, count(*) FILTER (starts_with(line, chr(12))) AS page_starts FROM l GROUP BY 1
""")
def line_counts(t):
    """Lines, blank lines and page starts of the specifications."""
    x = documents.lines(_cahiers(t).where("raw_text is not null"), "cahier_id", "raw_text")
    return x.groupBy("cahier_id").agg(F.count("*").alias("lines"), *tables.count_if(("blank", F.trim("line") == ""), ("page_starts", F.col("line").startswith("\f"))))


@query("""
WITH d AS (SELECT doc_id, regexp_extract_all(text, '([0-9]+)', 1) y FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, unnest(y) y FROM d), n AS (SELECT doc_id, CAST(y AS INTEGER) y FROM u WHERE length(y) = 4 AND y BETWEEN '1700' AND '2099')
SELECT doc_id, min(y) AS first_year, max(y) AS last_year, count(DISTINCT y) AS years FROM n GROUP BY 1
""")
def year_mentions(t):
    """Years named in the documents."""
    d = t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))).alias("y"))
    d = d.where("length(y) = 4 and y between '1700' and '2099'").select("doc_id", F.col("y").cast("int").alias("y"))
    return d.groupBy("doc_id").agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.countDistinct("y").alias("years"))


@query("""
SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, count(DISTINCT sha256(text)) AS texts FROM documents GROUP BY 1
""")
def source_totals(t):
    """Documents, characters and distinct texts by source."""
    return t("documents").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.countDistinct(F.sha2("text", 256)).alias("texts"))


@query("""
SELECT doc_id, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS escaped FROM documents WHERE text IS NOT NULL
""")
def escaped_texts(t):
    """The whole texts, fit for a page."""
    from treille.sources.sinks import escape

    return t("documents").where("text is not null").select("doc_id", escape(F.col("text")).alias("escaped"))


@query(f"""
SELECT cahier_id, sha256(concat_ws(chr(0), coalesce(slug, ''), coalesce(raw_text, ''))) AS job_key FROM ({CAHIERS})
""")
def content_keys(t):
    """Keys of content that decide whether work is done again."""
    return _cahiers(t).select("cahier_id", keys.content_key(F.coalesce("slug", F.lit("")), F.coalesce("raw_text", F.lit(""))).alias("job_key"))

"""Queries of the document grammars: chains, roles, bundles, lists, rules and dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from treille.functions import keys
from treille.operators import documents, grammar
from treille.operators.dedup import once_per_key
from treille.plans.queries import query
from treille.plans.texts import _SECTIONS, CAHIERS, HEADER

DOCS = "SELECT doc_id, text FROM documents WHERE text IS NOT NULL"
LETTER = r"\p{L}\p{M}\p{N}_"


def _cahiers(t):
    return once_per_key(t("cahier_extract").select("cahier_id", "slug", "raw_text", "lien_au_terroir"), "cahier_id")


def _sections(t):
    return documents.sections(_cahiers(t).where("raw_text is not null"), "cahier_id", "raw_text", HEADER)


@query(f"""
WITH {_SECTIONS}, n AS (SELECT cahier_id, ord, title, ascii(mark) - 96 num FROM s), f AS (SELECT *, row_number() OVER (PARTITION BY cahier_id ORDER BY ord) rn FROM n),
b AS (SELECT *, min(CASE WHEN num = rn THEN 1 ELSE 0 END) OVER (PARTITION BY cahier_id ORDER BY ord) ok FROM f)
SELECT cahier_id, CAST(ord AS BIGINT) AS ord, CAST(num AS VARCHAR) AS number, title, CAST(num AS INTEGER) AS top FROM b WHERE ok = 1
""")
def header_chain(t):
    """Section headers that follow each other without a gap; behind a missing section none counts."""
    s = _sections(t).select("cahier_id", "ord", (F.ascii("mark") - 96).cast("string").alias("number"), "title")
    return grammar.header_chain(s, "cahier_id", "ord", "number", "title")


@query(f"""
WITH {_SECTIONS}, k(role, keyword, rank) AS (VALUES ('link', 'lien', 0), ('link', 'legame', 1), ('link', 'vínculo', 2), ('link', 'zusammenhang', 3), ('yield', 'rend', 4), ('yield', 'rese', 5)),
f AS (SELECT cahier_id, ord, title FROM s WHERE NOT contains(lower(title), 'contr')), w AS (SELECT cahier_id, role, arg_min(ord, (rank, ord)) ord FROM f JOIN k ON contains(lower(title), keyword) GROUP BY 1, 2),
c AS (SELECT cahier_id, ord, row_number() OVER (PARTITION BY cahier_id ORDER BY ord) i FROM f), p(role, spot) AS (VALUES ('name', 1), ('yield', 4)),
a AS (SELECT cahier_id, role, ord FROM c JOIN p ON i = spot), spare AS (SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.cahier_id = a.cahier_id AND w.role = a.role) AND NOT EXISTS (SELECT 1 FROM w WHERE w.cahier_id = a.cahier_id AND w.ord = a.ord))
SELECT cahier_id, role, CAST(ord AS BIGINT) AS ord, 'keyword' AS how FROM w UNION ALL SELECT cahier_id, min(role), CAST(ord AS BIGINT), 'place' FROM spare GROUP BY cahier_id, ord
""")
def routed_sections(t):
    """Roles by keyword first, by place where no title has one; titles with a blocked word are no candidates."""
    words = [("link", "lien"), ("link", "legame"), ("link", "vínculo"), ("link", "zusammenhang"), ("yield", "rend"), ("yield", "rese")]
    return grammar.routed(_sections(t), "cahier_id", "title", "ord", words, ["contr"], {"name": 1, "yield": 4}).select("cahier_id", "role", "ord", "how")


@query(f"""
WITH {_SECTIONS}, f AS (SELECT cahier_id, mark, ord, title, body, row_number() OVER (PARTITION BY cahier_id, mark ORDER BY ord DESC) rn FROM s) SELECT cahier_id, mark, CAST(ord AS BIGINT) AS ord, title FROM f WHERE rn = 1
""")
def last_sections(t):
    """Of sections of one mark the last."""
    return grammar.last_of(_sections(t).select("cahier_id", "mark", "ord", "title"), "cahier_id", "mark", "ord")


@query(f"""
WITH {_SECTIONS}, b AS (SELECT cahier_id, CASE WHEN contains(lower(title), 'lien') OR contains(lower(title), 'legame') THEN 'link' END a, CASE WHEN contains(lower(title), 'rend') THEN 'yield' END y, ord, trim(regexp_replace(body, '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g'), ' ') t FROM s),
u AS (SELECT cahier_id, a topic, ord, t FROM b WHERE a IS NOT NULL UNION ALL SELECT cahier_id, y, ord, t FROM b WHERE y IS NOT NULL), j AS (SELECT cahier_id, topic, string_agg(t, ' ' ORDER BY ord) h FROM u GROUP BY 1, 2)
SELECT cahier_id, topic, CASE WHEN length(h) <= 1500 THEN h ELSE regexp_replace(h[1:1501], '[ \\t\\n\\f\\r\\x0B]+[^ \\t\\n\\f\\r\\x0B]*$', '') END AS hint FROM j
""")
def section_hints(t):
    """What sections say to a topic, cut at a word."""
    return grammar.hints(_sections(t), "cahier_id", "title", "body", [("link", "lien|legame"), ("yield", "rend")])


@query(f"""
WITH c AS ({CAHIERS}), p AS (SELECT cahier_id, 'whole' part, raw_text t FROM c UNION ALL SELECT cahier_id, 'link', lien_au_terroir FROM c) SELECT cahier_id, part, sha256(t) AS text_sha FROM p WHERE length(trim(t, ' ')) >= 200
""")
def chunked_calls(t):
    """Calls of a record, one for each part that is long enough."""
    got = grammar.chunked(_cahiers(t), "cahier_id", {"whole": F.col("raw_text"), "link": F.col("lien_au_terroir")})
    return got.select("cahier_id", "part", F.sha2("text", 256).alias("text_sha"))


@query("""
SELECT CAST('atlas' AS VARCHAR) AS doc, r_name AS area, string_agg(n_name, ';' ORDER BY n_name) AS places FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name
""")
def places_by_area(t):
    """Lists of places behind the name of their area; the text is made from the nations of the regions."""
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("n_name")), ", ").alias("l"))
    text = rows.agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("Department of "), "r_name", F.lit(": "), "l", F.lit(".")))), " ").alias("text"))
    got = grammar.places_by_area(text.select(F.lit("atlas").alias("doc"), "text"), "doc", "text", r"Department of ([\w ]+?)", keys.place_list)
    return got.select("doc", "area", F.array_join("places", ";").alias("places"))


@query(rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) line FROM ({DOCS})), h AS (SELECT doc_id, CASE WHEN regexp_matches(line, '^\d{{1,2}}\. (\p{{Lu}}.*)$') THEN 0 WHEN regexp_matches(line, '^[*•–-] (\p{{L}}.*)$') THEN 1 END i, line FROM l),
n AS (SELECT DISTINCT doc_id, i, trim(CASE i WHEN 0 THEN regexp_extract(line, '^\d{{1,2}}\. (\p{{Lu}}.*)$', 1) ELSE regexp_extract(line, '^[*•–-] (\p{{L}}.*)$', 1) END, ' ') AS name FROM h WHERE i IS NOT NULL),
c AS (SELECT doc_id, i FROM n GROUP BY 1, 2 HAVING count(*) >= 2), m AS (SELECT doc_id, min(i) i FROM c GROUP BY 1)
SELECT doc_id, name, CASE i WHEN 0 THEN 'numbered' ELSE 'listed' END AS pattern FROM n JOIN m USING (doc_id, i)
""")
def sub_areas(t):
    """Names by the first layout that gives two or more."""
    return grammar.sub_areas(t("documents"), "doc_id", "text", [("numbered", r"^\d{1,2}\. (\p{Lu}.*)$"), ("listed", r"^[*•–-] (\p{L}.*)$")])


@query(rf"""
SELECT doc_id, regexp_matches(text, '(^|[^{LETTER}])(terroir|vallée|valle|tal)([^{LETTER}]|$)', 'i') AS on_topic FROM ({DOCS})
""")
def topic_guard(t):
    """Whether a text has one of the words of a topic."""
    return t("documents").where("text is not null").select("doc_id", grammar.on_topic(F.col("text"), ["terroir", "vallée", "valle", "tal"]).alias("on_topic"))


RULES = [("sparkling", "mousseux|espumoso|spumante", None), ("dry", "secs?|secos?|secchi|trocken", "liquoreux"), ("white", "blancs?|bianc[oh]i?|weiß", None), ("old", "vieux|alte|antigu", "garde")]


@query(f"""
SELECT doc_id, concat_ws(';', {', '.join("CASE WHEN regexp_matches(text, '" + p + "', 'i')" + (f" AND NOT regexp_matches(text, '{no}', 'i')" if no else "") + f" THEN '{label}' END" for label, p, no in RULES)}) AS labels FROM ({DOCS})
""")
def rule_labels(t):
    """Labels of texts by a table of rules, some of which another word forbids."""
    return t("documents").where("text is not null").select("doc_id", F.array_join(grammar.by_rules(F.col("text"), RULES), ";").alias("labels"))


FEATURES = {"vallée": "valley", "valle": "valley", "coteaux": "slopes", "colline": "hills", "collines": "hills", "tal": "valley", "hänge": "slopes", "plateau": "plateau"}


@query(f"""
WITH n(name, value) AS (VALUES {', '.join(f"('{k}', '{v}')" for k, v in FEATURES.items())}), h AS (SELECT doc_id, value, instr(lower(text), name) p, length(name) l FROM ({DOCS}), n WHERE contains(lower(text), name)),
b AS (SELECT doc_id, arg_min(value, (p, -l, value)) AS feature FROM h GROUP BY 1) SELECT d.doc_id, feature FROM ({DOCS}) d LEFT JOIN b USING (doc_id)
""")
def earliest_mention(t):
    """What is named first in a text; at one place the longer name counts."""
    return t("documents").where("text is not null").select("doc_id", grammar.earliest(F.col("text"), FEATURES).alias("feature"))


@query(rf"""
SELECT DISTINCT name, trim(regexp_replace(name, '(\S)\s+(?:Rs|Rg|Β|Ν|Ε|B|N|G)\.?$', '\1'), ' ') AS bare, CASE regexp_extract(name, '\S\s+(Rs|Rg|Β|Ν|Ε|B|N|G)\.?$', 1) WHEN 'B' THEN 'white' WHEN 'N' THEN 'black' WHEN 'G' THEN 'grey' WHEN 'Rs' THEN 'pink' WHEN 'Rg' THEN 'red' WHEN 'Β' THEN 'white' WHEN 'Ν' THEN 'black' WHEN 'Ε' THEN 'pink' END AS colour FROM match_result WHERE name IS NOT NULL
""")
def colour_codes(t):
    """Names without the colour code behind them."""
    name, colour = grammar.colour_code(F.col("name"))
    return t("match_result").where("name is not null").select("name").distinct().select("name", name.alias("bare"), colour)


@query(rf"""
WITH e AS (SELECT doc_id, regexp_extract(text, '(?i)(?:^|[^{LETTER}])(\d{{1,2}})(?:er)?[ \t\n\f\r\x0B]+(janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre)[ \t\n\f\r\x0B]+(\d{{4}})(?:[^{LETTER}]|$)', ['d', 'm', 'y']) x FROM ({DOCS}))
SELECT doc_id, try_strptime(x.y || '-' || list_position(['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre', 'octobre', 'novembre', 'décembre'], lower(x.m)) || '-' || x.d, '%Y-%m-%d')::DATE AS written FROM e WHERE x.d <> ''
""")
def written_dates(t):
    """The first date of a text that is written out in French."""
    return t("documents").where("text is not null").select("doc_id", keys.french_date(F.col("text")).alias("written")).where("written is not null")


@query(rf"""
WITH f AS (SELECT doc_id, trim(regexp_replace(text, '[ \t\n\f\r\x0B]+', ' ', 'g'), ' ') f FROM ({DOCS})),
h AS (SELECT doc_id, f, CASE WHEN f[160:160] = ' ' THEN f[1:159] ELSE regexp_replace(f[1:159], '[ \t\n\f\r\x0B]+[^ \t\n\f\r\x0B]*$', '') END h FROM f)
SELECT doc_id, CASE WHEN length(f) <= 160 THEN f ELSE regexp_replace(h, '[ \t\n\f\r\x0B,;:.]+$', '') || '…' END AS lead FROM h
""")
def clamped_leads(t):
    """Texts cut at a word to what a listing has room for."""
    return t("documents").where("text is not null").select("doc_id", keys.clamped(F.col("text")).alias("lead"))


@query(f"""
WITH c AS ({CAHIERS}) SELECT coalesce(source_lang, 'none') AS lang, count(*) FILTER (length(lien_au_terroir) BETWEEN 1 AND 399) AS verbatim, count(*) FILTER (length(lien_au_terroir) >= 400) AS extract, count(*) FILTER (coalesce(lien_au_terroir, '') = '') AS none FROM c GROUP BY 1
""")
def verbatim_counts(t):
    """Records whose text passes as it is, by language."""
    c = once_per_key(t("cahier_extract").select("cahier_id", "source_lang", "lien_au_terroir"), "cahier_id")
    n = F.coalesce(F.length("lien_au_terroir"), F.lit(0))
    return c.groupBy(F.coalesce("source_lang", F.lit("none")).alias("lang")).agg(F.count_if((n > 0) & (n < 400)).alias("verbatim"), F.count_if(n >= 400).alias("extract"), F.count_if(n == 0).alias("none"))

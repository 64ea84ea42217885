"""One consistent form for text that prints alike but is stored with different characters.

The text is exploded to positioned code points. A broadcast join with the decomposition
table splits composed and width forms, turns every blank into a space and every plain
hyphen into ``-`` and drops what is invisible. A second broadcast join knows the
look-alike letters; each word is written in the one script that its unmistakable letters
show. Combining marks are ordered by class, and the string is rebuilt and recomposed.
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treille.plans.lineage import cut

# Compatibility tags whose forms read as the same letters.
SAME_LETTER_TAGS = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<small>", "<vertical>", "<initial>", "<medial>", "<final>", "<isolated>")

# The lunate sigmas look like the letter c, not like the sigma they decompose to.
KEPT_WHOLE = "ϲϹ"

# Other marks that print as a hyphen or an apostrophe.
SAME_MARK = {"‐": "-", "‑": "-", "﹣": "-", "－": "-", "ʼ": "'", "’": "'"}

# Invisible characters that are not of category Cf.
INVISIBLE_RANGES = ((0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF))

# Letters that print alike, one line per shape: Latin, Greek, Cyrillic, Armenian ("." for none).
LOOK_ALIKES = """
A Α А .
B Β В .
C Ϲ С .
E Ε Е .
G . Ԍ .
H Η Н .
I Ι І .
J Ϳ Ј .
K Κ К .
M Μ М .
N Ν . .
O Ο О Օ
P Ρ Р .
Q . Ԛ .
S . Ѕ Տ
T Τ Т .
U . . Ս
V . Ѵ .
W . Ԝ .
X Χ Х .
Y Υ Ү .
Z Ζ . .
a α а .
c ϲ с .
d . ԁ .
e . е .
g . . ց
h . һ հ
i ι і .
j ϳ ј .
k κ . .
l . ӏ .
n . . ո
o ο о օ
p ρ р .
q . ԛ .
s . ѕ .
u υ . ս
v ν ѵ .
w . ԝ .
x χ х .
y . у .
"""

# Letters of one script that print as another letter of the same script.
SAME_SCRIPT = {"ɡ": "g", "ɑ": "a", "ı": "i"}

SCRIPTS = ("LATIN", "GREEK", "CYRILLIC", "ARMENIAN")


def _invisible(cp: int) -> bool:
    return unicodedata.category(chr(cp)) == "Cf" or any(a <= cp <= b for a, b in INVISIBLE_RANGES)


def _decomposed(ch: str) -> str:
    if ch in KEPT_WHOLE:
        return ch
    rule = unicodedata.decomposition(ch)
    if not rule:
        return unicodedata.normalize("NFD", ch)
    parts = rule.split()
    if parts[0].startswith("<"):
        if parts[0] not in SAME_LETTER_TAGS:
            return ch
        parts = parts[1:]
    return "".join(_decomposed(chr(int(p, 16))) for p in parts)


@functools.lru_cache(1)
def decomposition_rows() -> list[tuple[str, list[tuple[str, int]]]]:
    """(character, its parts with their combining class) for each character that isn't simply itself; bounded by Unicode."""
    rows = []
    for cp in range(0x80, 0x110000):
        ch = chr(cp)
        kind = unicodedata.category(ch)
        if kind in ("Cn", "Co", "Cs") or 0xAC00 <= cp <= 0xD7A3:  # Hangul syllables are recomposed by rule
            continue
        if _invisible(cp):
            rows.append((ch, []))
            continue
        text = " " if kind == "Zs" else SAME_MARK.get(ch) or _decomposed(ch)
        text = "".join(SAME_MARK.get(c, SAME_SCRIPT.get(c, c)) for c in text)
        text = "".join(c for c in text if not _invisible(ord(c)))
        if kind != "Zs" and text.startswith(" ") and len(text) > 1:
            text = ch  # spacing accents stay what they are
        if text != ch or unicodedata.combining(ch):
            rows.append((ch, [(c, unicodedata.combining(c)) for c in text]))
    return rows


@functools.lru_cache(1)
def look_alike_rows() -> list[tuple[str, str, str | None, str | None, str | None, str | None]]:
    """(letter, its script, its shape's letter in each script)."""
    rows = []
    for line in LOOK_ALIKES.split("\n"):
        shape = [None if x == "." else x for x in line.split()]
        rows += [(x, SCRIPTS[i], *shape) for i, x in enumerate(shape) if x]
    return rows


def _scripts_expr(ch: F.Column) -> F.Column:
    """Script of a decomposed letter from its block."""
    cp = F.ascii(ch)
    return (
        F.when(((cp >= 65) & (cp <= 90)) | ((cp >= 97) & (cp <= 122)) | ((cp >= 0xC0) & (cp <= 0x24F) & (cp != 0xD7) & (cp != 0xF7)), "LATIN")
        .when((cp >= 0x370) & (cp <= 0x3FF), "GREEK")
        .when((cp >= 0x400) & (cp <= 0x52F), "CYRILLIC")
        .when((cp >= 0x531) & (cp <= 0x587), "ARMENIAN")
    )


@F.pandas_udf(T.StringType())
def recompose(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def canonical_forms(df: DataFrame, text: str, out: str = "canonical") -> DataFrame:
    """Distinct non-null values of column ``text`` and their consistent form: columns ``text``, ``out``.

    Printable ASCII is consistent already and only passes (the same check normalisation
    forms define as their quick check). An empty text stays empty; a text of invisible
    characters alone becomes empty. Null texts have no row.
    """
    spark = df.sparkSession
    plain = F.col("t").rlike(r"^[\x20-\x7E\t\r\n]*$")
    distinct = df.select(F.col(text).alias("t")).where("t is not null").distinct()
    # a number for each text: its code points carry that, and the text is joined back once
    distinct = cut(distinct.select("t", plain.alias("plain"), F.monotonically_increasing_id().alias("id")), "texts")
    forms = distinct.where("plain").select("t", F.col("t").alias("c")).unionByName(_rebuilt(spark, distinct.where("not plain").select("id", "t")))
    return cut(forms.select(F.col("t").alias(text), F.col("c").alias(out)), "forms")


def _rebuilt(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(t, c): the consistent form of texts (id, t)."""
    parts = F.broadcast(spark.createDataFrame(decomposition_rows(), "ch string, parts array<struct<c:string,k:int>>"))
    alike = F.broadcast(spark.createDataFrame(look_alike_rows(), "l string, own string, latin string, greek string, cyrillic string, armenian string"))

    points = texts.select("id", F.posexplode(F.split("t", "")).alias("pos", "ch")).where("ch <> ''")
    points = (
        points.join(parts, "ch", "left")
        .select("id", "pos", F.posexplode(F.coalesce("parts", F.array(F.struct(F.col("ch").alias("c"), F.lit(0).alias("k"))))).alias("sub", "part"))
        .select("id", "pos", "sub", F.col("part.c").alias("c"), F.col("part.k").alias("k"))
    )
    points = points.join(alike, points["c"] == alike["l"], "left").withColumn("own", F.coalesce("own", _scripts_expr(F.col("c"))))

    line = Window.partitionBy("id").orderBy("pos", "sub")
    whole, word = Window.partitionBy("id"), Window.partitionBy("id", "w")
    boundary = F.when((F.col("own").isNull()) & (F.col("k") == 0), 1).otherwise(0)
    points = points.withColumns({"w": F.sum(boundary).over(line), "seg": F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).over(line)})
    sure = lambda s: F.when((F.col("own") == s) & F.col("l").isNull(), 1).otherwise(0)
    own = lambda s: F.when(F.col("own") == s, 1).otherwise(0)
    writable = lambda s: F.when((F.col("own") == s) | F.col(s.lower()).isNotNull(), 1).otherwise(0)

    def winner(w, *counts):
        best = F.greatest(*[F.struct(*[F.sum(count(s)).over(w).alias(f"n{j}") for j, count in enumerate(counts)], F.lit(-i).alias("o"), F.lit(s).alias("s")) for i, s in enumerate(SCRIPTS)])
        return F.when(best["n0"] > 0, best["s"])

    # letters that only one script has decide; where there are none, the script in which most of the word can be written
    points = points.withColumn("script", F.coalesce(winner(word, sure), winner(whole, sure), winner(word, writable, own)))
    told = F.coalesce(*[F.when(F.col("script") == s, F.col(s.lower())) for s in SCRIPTS], F.col("c"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg", "k", "pos", "sub", told.alias("c")))), lambda x: x["c"]), "")
    rebuilt = points.groupBy("id").agg(text.alias("c"))
    # texts of invisible characters alone have no points left
    return texts.join(rebuilt, "id", "left").select("t", recompose(F.coalesce("c", F.lit(""))).alias("c"))


def same_looking(df: DataFrame, key: str, text: str, within: list[str] | None = None) -> DataFrame:
    """(form, within..., id, text): the rows of the classes that hold one consistent form written in more than one way.

    ``within`` names columns that must be equal too. Rows with a null key, text or
    ``within`` column are in no class; a key delivered again counts once. The classes are
    linear in the rows; pairs are only made of them by same_looking_pairs.
    """
    within = within or []
    rows = df.select(F.col(key).alias("_id"), F.col(text).alias("_t"), *[F.col(c).alias(f"_w{i}") for i, c in enumerate(within)])
    rows = rows.dropna().distinct()
    rows = rows.join(canonical_forms(rows, "_t", "_c"), "_t")
    on = [f"_w{i}" for i in range(len(within))] + ["_c"]
    mixed = rows.groupBy(*on).agg(F.min("_t").alias("lo"), F.max("_t").alias("hi")).where("lo <> hi").select(*on)
    return cut(rows.join(mixed, on, "left_semi").select("_c", *on[:-1], "_id", "_t"), "classes")


def same_looking_pairs(df: DataFrame, key: str, text: str, within: list[str] | None = None) -> DataFrame:
    """Pairs (id_a < id_b) of different keys whose texts differ as stored but have one consistent form; see same_looking."""
    rows = same_looking(df, key, text, within)
    on = [c for c in rows.columns if c not in ("_id", "_t")]
    a, b = rows.alias("a"), rows.alias("b")
    cond = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on] + [F.col("a._id") < F.col("b._id"), F.col("a._t") != F.col("b._t")]
    return a.join(b, functools.reduce(lambda x, y: x & y, cond)).select(F.col("a._id").alias("id_a"), F.col("b._id").alias("id_b")).distinct()


def found(spark: SparkSession, folder: str) -> DataFrame:
    entries = same_looking_pairs(spark.read.parquet(f"{folder}/ofag_entry.parquet"), "entry_id", "name")
    synonyms = same_looking_pairs(spark.read.parquet(f"{folder}/vivc_synonym.parquet"), "syn_id", "name", ["vivc_id"])
    return entries.select(F.lit("ofag_entry").alias("tbl"), "id_a", "id_b").unionByName(synonyms.select(F.lit("vivc_synonym").alias("tbl"), "id_a", "id_b"))

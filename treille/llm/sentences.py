"""Sentence boundaries learned without supervision, language by language.

One pass counts, per language, how often each word stands with and without a period, what
follows the period, and which words open paragraphs; two neighbours count once a paragraph,
as a repeated phrase is no new evidence. Log-likelihood ratios turn the counts into
abbreviations (a short word nearly always before a period, after which sentences end less
often than after others, or small letters or digits follow more often), collocations (a
word or number, a period and what follows too often for chance) and sentence starters. A
sentence has ended where the paragraph ends or a capital follows that the word otherwise
hasn't inside sentences. A second pass classifies each end mark with them. Scripts without spaces end at their own full stops, Thai at the
blanks between Thai words; a blank line always ends a sentence.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.llm.language_mix import LanguageModel, language_code, train
from treille.plans.lineage import cut, spread

# Marks of the domain's scripts.
OPENERS = {"«": "»", "“": "”", "„": "“", "‘": "’", "「": "」", "『": "』", "（": "）", "‹": "›", "《": "》"}
CLOSERS = "»”“’」』）›》)]}\"'"
OWN_ENDS = "。！？｡"
LANGS = ["bg", "de", "el", "en", "es", "fr", "it", "ja", "nl", "pt", "th", "zh"]

ABBREVIATION = 0.3  # least score of an abbreviation
SURE = 7.88  # least log-likelihood ratio of a difference (0.5 %)
OFTEN = 0.02  # a word that closes paragraphs at this rate can end a sentence
RATE = 1e-5  # least part of its language's cases that a learned entry makes up: bounds each lexicon to 1/RATE entries a language

PARAGRAPH = re.compile(r"\n[^\S\n]*(?:\n|$)| |\f")
TOKEN = re.compile(r"\S+")
END = re.compile(r"[.!?…;;" + OWN_ENDS + "]+")
ITEM = re.compile(r"[^\S\n]*(?:(?P<bullet>[•*–—\-‣·▪◦])\s+|(?P<number>\(?(?:\d{1,3}|[ivxl]{1,5}|[a-z])[.)．])\s*(?=\D))")
BULLET_OR_NUMBER = re.compile(r"[^\S\n]*(?:[•*–—\-‣·▪◦]\s+\S|\(?(?:\d{1,3}|[a-z])[.)]\s+\S|\d{1,3}．)")
NUMBER = re.compile(r"[\d.,  '’/]*\d[\d.,]*$")
STRIP_LEFT = "«“„‘「『（([{\"'‹¿¡—–-"
QUOTE = re.compile("[«»“”„‘’「」『』\"‹›《》]")
THAI = re.compile(r"(?<=[ก-๛])[^\S\n]+(?=[ก-๛])|(?<=[ก-๛])\n(?=[ก-๛])")


@functools.lru_cache(200_000)
def _type(token: str) -> tuple[str, bool]:
    """(word type, does it end in a period) of a token; numbers become # and their number of digits."""
    core = token.lstrip(STRIP_LEFT).rstrip(CLOSERS + ",;:!?…")
    period = core.endswith(".")
    core = core.rstrip(".") if period else core
    core = re.split(r"['’]", core)[-1] if not core.endswith(("'", "’")) else core
    if NUMBER.match(core):
        return "#" + str(min(4, sum(c.isdigit() for c in core))), period
    return core.lower(), period


def _head(text: str, at: int) -> str:
    """The first telling character from ``at`` on, past blanks, opening marks and dashes."""
    while at < len(text) and (text[at].isspace() or text[at] in "«“„‘「『（([{\"'‹¿¡—–-"):
        at += 1
    return text[at] if at < len(text) else ""


def _class(ch: str) -> str:
    return "E" if not ch else "l" if ch.islower() else "U" if ch.isupper() else "D" if ch.isdigit() else "C" if ch.isalpha() else "o"


def paragraphs(text: str) -> Iterator[tuple[int, int]]:
    start = 0
    for m in PARAGRAPH.finditer(text):
        if m.start() >= start:
            yield start, m.start()
            start = m.end()
    yield start, len(text)


def _observe(model: LanguageModel, text: str, seen: Counter) -> None:
    for a, b in paragraphs(text):
        part = text[a:b]
        if not part.strip():
            continue
        lang = model.best(part)
        if lang in ("zh", "ja", "th"):
            continue
        listed = bool(BULLET_OR_NUMBER.match(part))
        tokens = TOKEN.findall(part)
        told: set[tuple[str, str]] = set()
        last = ("", True)
        for i, token in enumerate(tokens):
            word, period = _type(token)
            context = (token, tokens[i + 1] if i + 1 < len(tokens) else "")
            again = context in told
            told.add(context)
            first = token.lstrip(STRIP_LEFT)[:1]
            if not again:
                if first.isupper() and not listed:
                    upper = _type(token.rstrip("."))[0]
                    seen[lang, "start" if i == 0 else "after" if last[1] else "mid", upper, ""] += 1
                elif first.islower() and not last[1]:
                    seen[lang, "low", word, ""] += 1
                if i and last[1] and last[0] and first.isupper() and not listed:
                    seen[lang, "pair", last[0], _type(token.rstrip("."))[0]] += 1
                if word:
                    seen[lang, "period" if period else "plain", word, ""] += 1
                    if period:
                        following = _class(_head(tokens[i + 1], 0)) if i + 1 < len(tokens) else "E"
                        if not token.rstrip(CLOSERS).endswith("."):
                            following = "o"
                        seen[lang, "next", word, following] += 1
            if token.endswith(("!", "?")):
                period = True
                word = ""
            last = (word, period)


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(0.0)


def ratio(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Log-likelihood ratio of k1 of n1 against k2 of n2, positive where the first rate is higher."""
    k1, n1, k2, n2 = (x.cast("double") for x in (k1, n1, k2, n2))
    h = lambda k, n: _xlogx(k) + _xlogx(n - k) - _xlogx(n)
    g = 2 * (h(k1, n1) + h(k2, n2) - h(k1 + k2, n1 + n2))
    return F.when(k1 * n2 >= k2 * n1, g).otherwise(-g)


class Boundaries:
    """What the corpus taught, by language; sizes follow the lexicons, not the corpus."""

    def __init__(self, abbreviations: dict, starters: set, collocations: set):
        self.abbreviations, self.starters, self.collocations = abbreviations, starters, collocations


def learn(docs: DataFrame, text: str, model) -> Boundaries:
    """Statistics of all documents; ``model`` is a broadcast language model."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "kind", "a", "b", "n"])
            seen.clear()
            return out

        for pdf in batches:
            for t in pdf["t"]:
                _observe(model.value, t, seen)
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    rows = docs.select(F.col(text).alias("t")).where("t is not null").mapInPandas(count, "lang string, kind string, a string, b string, n long")
    counts = cut(rows.groupBy("lang", "kind", "a", "b").agg(F.sum("n").alias("n")), "counts")

    of = lambda kind, *b: F.coalesce(F.sum(F.when((F.col("kind") == kind) & (F.col("b").isin(*b) if b else F.lit(True)), F.col("n"))), F.lit(0))
    uppers = counts.where(F.col("kind").isin("start", "mid", "after", "low")).groupBy("lang", "a").agg(of("start").alias("s"), of("mid").alias("m"), of("low").alias("low"))
    uppers = cut(uppers, "capitals")
    pairs = counts.where("kind = 'pair'").select("lang", "a", "b", "n")
    # a capital that says a sentence began: of a word that isn't written so inside sentences; names without a case in their language are judged by all
    anywhere = uppers.groupBy(F.col("a").alias("b")).agg(*[F.sum(c).alias(f"any_{c}") for c in ("s", "m", "low")])
    opens = pairs.join(uppers.select("lang", F.col("a").alias("b"), "s", "m", "low"), ["lang", "b"]).join(anywhere, "b")
    own, any_ = F.col("s") + F.col("m") + F.col("low") > 0, F.col("any_s") + F.col("any_m") + F.col("any_low") > 0
    sure = F.when(own, F.col("m") < F.col("s") + F.col("low")).otherwise(F.col("any_m") < F.col("any_s") + F.col("any_low"))
    opens = opens.where(sure | ~any_).groupBy("lang", "a").agg(F.sum("n").alias("opened"), F.sum(F.when(sure, F.col("n")).otherwise(0)).alias("surely"))
    words = counts.where(F.col("kind").isin("plain", "period", "next")).groupBy("lang", "a").agg(
        of("plain").alias("plain"), of("period").alias("period"), of("next", "E").alias("e"), of("next", "l").alias("l"), of("next", "D").alias("d"), of("next", "l", "U", "D", "E", "C").alias("known")
    )
    words = words.join(opens, ["lang", "a"], "left").withColumn("ended", F.least(F.col("e") + F.coalesce("opened", F.lit(0)), F.col("known"))).withColumn("surely", F.coalesce("surely", F.lit(0)))
    words = cut(words, "words")
    totals = words.groupBy("lang").agg(*[F.sum(c).alias(f"t_{c}") for c in ("plain", "period", "e", "ended", "l", "d", "known")])
    words = words.where("period > 0").join(F.broadcast(totals), "lang")  # one row per language
    n, k = F.col("plain") + F.col("period"), F.col("period")
    base = F.col("t_period") / (F.col("t_plain") + F.col("t_period"))
    likely = -2 * (k * F.log(base) + F.col("plain") * F.log(1 - base) - k * F.log(F.lit(0.99)) - F.col("plain") * F.log(F.lit(0.01)))
    letters = F.greatest(F.length(F.regexp_replace("a", r"\.", "")), F.lit(1))
    dots = F.length("a") - F.length(F.regexp_replace("a", r"\.", "")) + 1
    score = likely * F.exp(-letters) * dots * F.pow(letters, -F.col("plain"))
    versus = lambda c: ratio(F.col(c), F.col("known"), F.col(f"t_{c}") - F.col(c), F.col("t_known") - F.col("known"))
    rated = words.where(k >= RATE * F.col("t_period")).select(
        "lang", "a", "surely", letters.alias("letters"), (F.col("e") / F.greatest("known", F.lit(1))).alias("closes"), score.alias("score"), versus("ended").alias("ve"), versus("e").alias("vc"), versus("l").alias("vl"), versus("d").alias("vd")
    )
    continuing = (F.col("ve") < -SURE) | (F.col("vl") > SURE) | (F.col("vd") > SURE)
    # before words that stand nowhere else: the shortest words, where they close no paragraph
    continuing = continuing | (F.col("vc") < -SURE) & (F.col("surely") == 0) & (F.col("letters") <= 3)
    taken = rated.where(F.col("a").rlike(r"(?U)^\p{L}") & (F.col("score") >= ABBREVIATION) & continuing)
    abbreviations = {(r["lang"], r["a"]): (r["closes"] >= OFTEN, r["vd"] > SURE) for r in taken.collect()}  # at most 1/RATE a language

    all_ = uppers.groupBy("lang").agg(F.sum("s").alias("ts"), F.sum("m").alias("tm"))
    uppers = uppers.join(F.broadcast(all_), "lang")  # one row per language
    opening = ratio(F.col("s"), F.col("s") + F.col("m"), F.col("ts") - F.col("s"), F.col("ts") + F.col("tm") - F.col("s") - F.col("m"))
    started = uppers.where((F.col("s") >= 3) & (F.col("s") >= RATE * F.col("ts")) & (opening > SURE) & (F.col("s") > 0.2 * (F.col("s") + F.col("m"))))
    starters = {(r["lang"], r["a"]) for r in started.select("lang", "a").collect()}  # at most 1/RATE a language

    by_a = pairs.groupBy("lang", "a").agg(F.sum("n").alias("na"))
    by_b = pairs.groupBy("lang", "b").agg(F.sum("n").alias("nb"))
    by_l = pairs.groupBy("lang").agg(F.sum("n").alias("nl"))
    joined = pairs.where("n >= 3").join(by_a, ["lang", "a"]).join(by_b, ["lang", "b"]).join(F.broadcast(by_l), "lang")
    together = ratio(F.col("n"), F.col("na"), F.col("nb") - F.col("n"), F.col("nl") - F.col("na"))
    strong = joined.where((together > SURE) & (F.col("n") > 0.5 * F.col("nb")) & (F.col("n") >= RATE * F.col("nl")))
    collocations = {(r["lang"], r["a"], r["b"]) for r in strong.select("lang", "a", "b").collect()}  # at most 1/RATE a language
    return Boundaries(abbreviations, starters, collocations)


def _before(part: str, at: int, stop: str = "") -> str:
    """What stands before ``at`` up to white space or a character of ``stop``."""
    i = at
    while i > 0 and not part[i - 1].isspace():
        i -= 1
        if part[i] in stop:
            break
    return part[i:at]


def _quotes(part: str) -> tuple[set[int], list[tuple[int, int]]]:
    """(positions of closing marks, quoted spans that a sentence goes on after)."""
    stack: list[tuple[str, int]] = []
    closing, spans = set(), []
    for m in QUOTE.finditer(part):
        i, c = m.start(), m.group()
        if stack and c == stack[-1][0] and not (c == "’" and i + 1 < len(part) and part[i + 1].isalpha()):
            spans.append((stack.pop()[1], i))
            closing.add(i)
        elif c == '"':
            stack.append((c, i))
        elif c in OPENERS and not (c == "‘" and i and part[i - 1].isalpha()):
            stack.append((OPENERS[c], i))
    going = []
    for a, b in spans:
        j = b + 1
        while j < len(part) and j in closing:
            j += 1
        k = j
        while k < len(part) and part[k].isspace():
            k += 1
        if k >= len(part):
            continue
        c = part[k]
        if c in ",;:，；：、" or c.islower() or (k == j and c.isalpha()) or (c in "–—" and k > j):
            going.append((a, b))
    return closing, going


def _ends(part: str, lang: str, know: Boundaries) -> list[int]:
    """End offsets (exclusive) of the sentences of a paragraph, but for its last."""
    lines = part.split("\n")
    if BULLET_OR_NUMBER.match(part) and all(BULLET_OR_NUMBER.match(x) for x in lines if x.strip()):
        ends, at = [], 0
        for line in lines:
            ends.append(at + len(line.rstrip()))
            at += len(line) + 1
        return ends
    closing, going = _quotes(part)
    guard = ITEM.match(part)
    guard_end = guard.end() if guard else 0
    found = []
    for m in END.finditer(part):
        marks, j = m.group(), m.end()
        if ";" in marks or ";" in marks:
            before = part[: m.start()].rstrip()[-1:]
            if marks.strip(";;") == "" and not ("Ͱ" <= before <= "Ͽ" or "ἀ" <= before <= "῿" or lang == "el"):
                continue
        if j <= guard_end:
            continue
        while True:  # closing marks, also after a blank, and end marks behind them
            k = j
            while k < len(part) and part[k] in "   ":
                k += 1
            if k < len(part) and k in closing and (k == j or part[k] in "»›"):
                j = k + 1
            elif j < len(part) and part[j] in ")]}）" or (j < len(part) and part[j] in ".!?…" and j > m.end()):
                j += 1
            else:
                break
        if any(a < m.start() <= b for a, b in going):
            continue
        own = marks[-1] in OWN_ENDS
        if j < len(part) and not part[j].isspace() and not own:
            # a lost blank: a word of small letters, the mark, then a capitalised word
            if marks != "." or not part[j].isupper():
                continue
            word = _before(part, m.start(), ".").lstrip(STRIP_LEFT)
            whole = len(word) > 1 and word[-1:].islower() or word.endswith("%")
            if not whole or "." in word:
                continue
            if not part[j + 1 : j + 2].islower() and (lang, _type(TOKEN.match(part, j).group().rstrip("."))[0]) not in know.starters:
                continue
        ahead = _head(part, j)
        kind = _class(ahead)
        if kind == "E" or (own and "…" not in marks):
            found.append(j)
            continue
        if kind == "l" or kind == "o" and ahead in ",;:":
            continue
        if marks != "." or part[m.end() : j].strip("»”“’\"'   ") != "":
            if kind != "C" or "…" not in marks:
                found.append(j)
            continue
        word, _ = _type(_before(part, m.end()))
        following = TOKEN.search(part, j)
        nxt = _type(following.group().rstrip("."))[0] if following else ""
        known = know.abbreviations.get((lang, word))
        if word.startswith("#"):
            if kind == "U" and (lang, word, nxt) in know.collocations and (lang, nxt) not in know.starters:
                continue
        elif kind == "U" and (known or (len(word) == 1 and word.isalpha())):
            if (lang, nxt) not in know.starters or (lang, word, nxt) in know.collocations and not known:
                continue
        elif kind == "D" and known and (known[1] or not known[0]):
            continue
        found.append(j)
    if lang == "th" or re.search("[ก-๛]", part):
        found = sorted({*found, *(m.start() for m in THAI.finditer(part))})
    return found


def split(text: str, model: LanguageModel, know: Boundaries) -> list[int]:
    """End positions of the sentences of a text, each after the last character that is no white space."""
    out = []
    for a, b in paragraphs(text):
        part = text[a:b]
        if not part.strip():
            continue
        lang = model.best(part)
        start = 0
        for end in [*_ends(part, lang, know), len(part)]:
            body = part[start:end].rstrip()
            if body.strip():
                out.append(a + start + len(body))
                start = end
    return out


def sentence_ends(docs: DataFrame, key: str, text: str, label: str, sample: int = 20_000) -> DataFrame:
    """(key, end_pos) for each sentence of every document.

    The language model behind the statistics is fitted on at most about ``sample``
    labelled rows; the statistics themselves are counted over all documents. Null and
    blank texts have no sentences.
    """
    spark = docs.sparkSession
    docs = docs.select(key, text, label)
    model = train(docs.select(F.col(text).alias("text"), language_code(F.col(label)).alias("lang")), LANGS, sample)
    shared = spark.sparkContext.broadcast(model)
    docs = spread(docs.where(F.col(text).isNotNull()).select(key, text))
    know = spark.sparkContext.broadcast(learn(docs, text, shared))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys, ends = [], []
            for k, t in zip(pdf["k"], pdf["t"]):
                found = split(t, shared.value, know.value)
                keys += [k] * len(found)
                ends += found
            yield pd.DataFrame({key: keys, "end_pos": ends})

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(run, f"{key} {kind}, end_pos bigint")


def found(spark: SparkSession, folder: str) -> DataFrame:
    return sentence_ends(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text", "lang")

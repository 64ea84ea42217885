"""Languages of documents and of their segments.

A model of hashed n-gram likelihoods per language is trained on labelled texts: once from
the labels as they are, then again from the clauses relabelled by the first model, so
wrong labels and mixed texts fade out. A document is a mixture: expectation-maximisation
over its clauses estimates the share of each language, and a language joins the set only
while it raises the likelihood by more than a penalty. Clauses are then given to the
languages of the set; neighbours of one language form a segment with its posterior.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.operators.dedup import once_per_key
from treille.plans.lineage import cut, spread

BITS = 18  # n-grams are hashed into 2**BITS rows, which bounds the model's size
SMOOTH = 2e-6
WEIGHTS = {1: 0.02, 2: 0.05, 3: 0.1, 4: 0.15, 0: 1.0}  # by order; 0 is the whole word
CLIP = 5.0  # most a single word may speak for or against a language
PENALTY = 7.0  # log-likelihood that one more language has to bring
MIN_WORDS = 4

# Three-letter codes of ISO 639-2 (both kinds) and their two-letter codes.
THREE_LETTERS = {
    "bul": "bg", "deu": "de", "dut": "nl", "ell": "el", "eng": "en", "fra": "fr", "fre": "fr", "ger": "de", "gre": "el",
    "ita": "it", "jpn": "ja", "nld": "nl", "por": "pt", "spa": "es", "tha": "th", "zho": "zh", "chi": "zh",
}

WORD = re.compile(r"[^\W\d_]+")
# a clause ends at punctuation (a full stop or comma inside a number doesn't count), a dash between blanks or a line end
CLAUSE = re.compile(r"[!?;:…\n\r\f\"“”„«»‹›()\[\]{}|—–·。！？；：、，「」『』（）]+|[.,]+(?!\d)|(?<=\s)[-/]+(?=\s)|(?<=\s)['‘’](?=\w)|['’](?=\s|$)")


def language_code(label: F.Column) -> F.Column:
    """Two-letter lower-case code of a label however spelt; null for null, empty, ``und`` and what is no code."""
    head = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:$|[-_])", 1))
    table = F.create_map(*[F.lit(x) for kv in THREE_LETTERS.items() for x in kv])
    return F.when(F.length(head) == 2, head).when(F.length(head) == 3, table[head])


class _Bare(dict):
    """What is left of a character without its marks, by code point; filled as characters are met."""

    def __missing__(self, cp: int) -> str:
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(cp)) if not unicodedata.combining(c) or "฀" <= c <= "๿")
        self[cp] = bare
        return bare


BARE = _Bare()
MARK = re.compile("[" + "".join(chr(cp) for cp in range(0x300, 0x10000) if unicodedata.combining(chr(cp)) and not 0xE00 <= cp <= 0xE7F) + "]")
ASTRAL = re.compile("[\U00010000-\U0010FFFF]")  # characters beyond 16 bits, some of them marks


def fold(text: str) -> str:
    """Lower case without accents, so capitals and lost accents don't matter."""
    return text.lower().translate(BARE)


def folded_words(text: str) -> list[str]:
    """The words of the folded text; a mark that stands alone joins what is around it."""
    if MARK.search(text) or ASTRAL.search(text):
        return WORD.findall(fold(text))
    return [x for x in map(_folded, WORD.findall(text)) if x]


@functools.lru_cache(300_000)
def _folded(word: str) -> str:
    return fold(word)


def _joined(word: str) -> bool:
    """Scripts written without spaces, whose words can't be cut by blanks."""
    c = word[0]
    return "฀" <= c <= "໿" or "぀" <= c <= "鿿" or "豈" <= c <= "﫿" or c >= "\U00020000"


def features(word: str) -> list[tuple[int, int]]:
    """(order, bucket) of the n-grams of a folded word; characters of scripts without blanks as 1- and 2-grams."""
    if _joined(word):
        grams = [(n, word[i : i + n]) for n in (1, 2) for i in range(len(word) - n + 1)]
    else:
        marked = f"^{word}$"
        grams = [(n, marked[i : i + n]) for n in (2, 3, 4) for i in range(len(marked) - n + 1)] + [(0, "=" + word)]
    return [(n, zlib.crc32(g.encode()) & ((1 << BITS) - 1)) for n, g in grams]


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # float32 [2**BITS, languages]: log-likelihood ratio against the mean over languages
    cache: dict[str, np.ndarray] = field(default_factory=dict)
    raw: dict[str, np.ndarray] = field(default_factory=dict)  # by the word as written

    def __getstate__(self):
        return {"langs": self.langs, "table": self.table, "cache": {}, "raw": {}}

    def word(self, word: str) -> np.ndarray:
        got = self.cache.get(word)
        if got is None:
            got = np.zeros(len(self.langs))
            joined = _joined(word)
            for order, bucket in features(word):
                got += (4 if joined else 1) * WEIGHTS[order] * self.table[bucket]
            if not joined:
                got = np.clip(got, -CLIP, CLIP)
            if len(word) <= 24:
                if len(self.cache) > 300_000:
                    self.cache.clear()
                self.cache[word] = got
        return got

    def best(self, text: str) -> str:
        """The likeliest single language of a text; the first one for a text without words."""
        total = None
        for w in WORD.findall(text):
            got = self.raw.get(w)
            if got is None:
                got = self.word(fold(w)) if fold(w) else np.zeros(len(self.langs))
                if len(w) <= 24:
                    if len(self.raw) > 300_000:
                        self.raw.clear()
                    self.raw[w] = got
            total = got if total is None else total + got
        return self.langs[int(total.argmax())] if total is not None else self.langs[0]

    def clauses(self, text: str) -> list[tuple[int, int, int, np.ndarray]]:
        """(start, end, words, log-likelihoods) of the clauses that have a word."""
        found, start = [], 0
        for stop in [m.span() for m in CLAUSE.finditer(text)] + [(len(text), len(text))]:
            words = folded_words(text[start : stop[0]])
            if words:
                count = sum(max(1, len(w) // 3) if _joined(w) else 1 for w in words)
                found.append((start, stop[0], count, sum(self.word(w) for w in words)))
            start = stop[1]
        return found

    def mixture(self, scores: np.ndarray, penalty: float = PENALTY, rounds: int = 12) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(language set, shares, posterior by clause) of a text from its clauses' log-likelihoods."""

        def em(chosen: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
            x = scores[:, chosen]
            share = np.full(len(chosen), 1 / len(chosen))
            for _ in range(rounds if len(chosen) > 1 else 1):
                z = x + np.log(share + 1e-9)
                top = z.max(1, keepdims=True)
                post = np.exp(z - top)
                total = post.sum(1, keepdims=True)
                post /= total
                share = post.mean(0)
            return float((top + np.log(total)).sum()), share, post

        chosen = [int(scores.sum(0).argmax())]
        best = em(chosen)
        while len(chosen) < scores.shape[1]:
            # the language with the most to gain on the clauses it suits better
            gains = np.maximum(scores - scores[:, chosen].max(1, keepdims=True), 0).sum(0)
            if gains.max() <= penalty:
                break
            tried = [*chosen, int(gains.argmax())]
            new = em(tried)
            if new[0] - best[0] <= penalty:
                break
            chosen, best = tried, new
        return chosen, best[1], best[2]

    def segments(self, text: str) -> list[tuple[int, int, str, float, int]]:
        """(start, end, language, confidence, words of its longest clause) of the runs of clauses in one language."""
        clauses = self.clauses(text)
        if not clauses:
            return []
        chosen, _, post = self.mixture(np.array([c[3] for c in clauses]))
        runs: list[list] = []
        for (start, end, words, score), p in zip(clauses, post):
            k = int(p.argmax())
            lang = self.langs[chosen[k]]
            others = np.delete(score, chosen[k])
            sure = float(1 / (1 + np.exp(-np.clip(score[chosen[k]] - others.max(), -50, 50)))) if len(chosen) == 1 else float(p[k])
            if runs and (runs[-1][2] == lang or words < 2):
                runs[-1][1] = end
                if runs[-1][2] == lang:
                    runs[-1][3].append((words, sure))
            else:
                runs.append([start, end, lang, [(words, sure)]])
        return [(a, b, lang, sum(w * s for w, s in parts) / sum(w for w, _ in parts), max(w for w, _ in parts)) for a, b, lang, parts in runs]


def _counts(rows: DataFrame, model=None) -> DataFrame:
    """(lang, ord, bucket, n): n-gram counts of labelled texts (text, lang), by their label or, with a model, by clause."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()

        def flush() -> pd.DataFrame:
            grams: Counter = Counter()
            for (lang, word), n in words.items():
                for order, bucket in features(word):
                    grams[lang, order, bucket] += n
            words.clear()
            return pd.DataFrame([(*k, n) for k, n in grams.items()], columns=["lang", "ord", "bucket", "n"])

        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                if model is None:
                    for w in folded_words(text):
                        words[lang, w] += 1
                else:
                    m = model.value
                    clauses = m.clauses(text)
                    if not clauses:
                        continue
                    chosen, _, post = m.mixture(np.array([c[3] for c in clauses]))
                    for (a, b, count_, _), p in zip(clauses, post):
                        if count_ >= 3 and p.max() > 0.9:
                            label = m.langs[chosen[int(p.argmax())]]
                            for w in folded_words(text[a:b]):
                                words[label, w] += 1
            if len(words) > 200_000:
                yield flush()
        yield flush()

    parts = rows.select("text", "lang").mapInPandas(count, "lang string, ord int, bucket int, n long")
    return parts.groupBy("lang", "ord", "bucket").agg(F.sum("n").alias("n"))


def _model(counts: DataFrame, langs: list[str]) -> LanguageModel:
    pdf = counts.toPandas()  # at most languages x orders x 2**BITS rows
    table = np.zeros((1 << BITS, len(langs)), dtype=np.float32)
    for order, part in pdf.groupby("ord"):
        raw = np.zeros((1 << BITS, len(langs)))
        np.add.at(raw, (part["bucket"].to_numpy(), part["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()), part["n"].to_numpy())
        rate = raw / np.maximum(raw.sum(0), 1) + SMOOTH
        ratio = np.log(rate) - np.log(rate.mean(1, keepdims=True))
        seen = raw.sum(1) > 0
        table[seen] = ratio[seen]
    return LanguageModel(langs, table)


def train(rows: DataFrame, langs: list[str], sample: int = 100_000) -> LanguageModel:
    """A model from (text, lang), fitted on about ``sample`` labelled rows chosen by a hash of the text.

    The bound makes training cost the same at every size. Rows with another or no label
    and null texts are left out; a language without rows is never chosen.
    """
    spark = rows.sparkSession
    labelled = rows.where(F.col("lang").isin(langs) & F.col("text").isNotNull()).select("text", "lang")
    total = labelled.count()
    if total > sample:
        labelled = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    parts = max(2, spark.sparkContext.defaultParallelism)
    labelled = labelled.repartition(parts)
    first = _model(_counts(labelled), langs)
    return _model(_counts(labelled, spark.sparkContext.broadcast(first)), langs)


SEGMENTS = "segments array<struct<start:int,end:int,lang:string,confidence:double,words:int>>"


def identify(df: DataFrame, key: str, text: str, model: LanguageModel, *carried: str) -> DataFrame:
    """(key, carried..., langs array<struct<lang,share,confidence>>, segments) of every row of ``df``.

    ``share`` is the part of the text's words, ``confidence`` the word-weighted posterior.
    Null texts and texts without a word have empty arrays. Offsets count code points.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            found = [m.segments(t) if t else [] for t in pdf["t"]]
            langs = []
            for segments in found:
                total = sum(b - a for a, b, *_ in segments) or 1
                by: dict[str, list] = {}
                for a, b, lang, sure, _ in segments:
                    got = by.setdefault(lang, [0, 0.0])
                    got[0] += b - a
                    got[1] += (b - a) * sure
                langs.append([{"lang": k, "share": n / total, "confidence": s / max(n, 1)} for k, (n, s) in sorted(by.items(), key=lambda x: (-x[1][0], x[0]))])
            told = {"langs": langs, "segments": [[dict(zip(("start", "end", "lang", "confidence", "words"), x)) for x in s] for s in found]}
            yield pd.concat([pdf.drop(columns="t").reset_index(drop=True), pd.DataFrame(told)], axis=1)

    kinds = dict(df.dtypes)
    named = [F.col(key).alias("k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)]]
    schema = f"k {kinds[key]}, {''.join(f'c{i} {kinds[c]}, ' for i, c in enumerate(carried))}langs array<struct<lang:string,share:double,confidence:double>>, {SEGMENTS}"
    out = df.select(*named, F.col(text).alias("t")).mapInPandas(run, schema)
    return out.select(F.col("k").alias(key), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "langs", "segments")


# The languages of the domain's texts.
AUDITED = ["bg", "de", "el", "en", "es", "fr", "it", "nl", "pt"]


def found(spark: SparkSession, folder: str) -> DataFrame:
    items = once_per_key(spark.read.parquet(f"{folder}/audit_item.parquet").select("item_id", "expected", "text"), "item_id")
    items = cut(items.select("item_id", "text", language_code(F.col("expected")).alias("expected")), "items")  # deduplicated once for every use
    model = train(items.select("text", F.col("expected").alias("lang")), AUDITED)
    segments = identify(spread(items.where(F.length("text") >= 15)), "item_id", "text", model, "expected").select("item_id", "expected", F.explode("segments").alias("s"))
    occurs = segments.where((F.col("s.words") >= MIN_WORDS) & (F.col("s.confidence") >= 0.5)).select("item_id", "expected", F.col("s.lang").alias("lang"))
    return occurs.where(~F.col("lang").eqNullSafe(F.col("expected"))).select("item_id", "lang").distinct()

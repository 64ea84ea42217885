"""Text of scanned pages made whole: page furniture, broken words and misread characters.

Furniture: the outer lines of the pages are reduced to a key (numbers, roman numbers and
the words of the document's own title replaced); keys that the corpus shows at page edges
and hardly elsewhere, keys that return on the document's own pages, and bare page numbers
are furniture. Misreads: every word of the corpus is counted by language; for words that
are rare, a Levenshtein automaton is run over a trie of the well-attested words of nearly
the same length, which gives all candidates; they are ranked by how scanners misread, by
frequency, and for words that could be right by their context. Broken words: the joined
and the hyphenated form and their parts are looked up in the same counts. ``repaired``
removes the furniture, joins and corrects the words and reflows the paragraphs.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.llm.canonical_map import distance
from treille.llm.language_mix import LanguageModel, fold, language_code, train
from treille.operators.dedup import once_per_key
from treille.plans.lineage import cut, spread

# How scanners misread, "right>read read ...".
MISREADS = """
o>0 a O Q   0>O o Q   i>1 l ! | j t   l>1 | ! I i t   I>l 1 ! |   1>l I ! | i   e>c o 6   c>e o   a>o u   u>ii v n   v>y u   y>v   n>ri u r h   r>n t f
m>rn in ni nn   rn>m   in>m   ni>m   nn>m   ti>h   ri>n   ir>n   d>cl   cl>d   h>li b n ii   li>h   b>6 h lo   B>8 R   8>B   s>5 S   S>5 8   5>S   g>9 q   9>g   q>9 g
t>f l i   f>t   z>2 Z   Z>2   2>Z   é>6 e'   ll>U ii   U>ll   w>vv   vv>w   tt>ft   ff>tt   6>b   ü>ii   ä>o   ö>o 6   x>z
"""

HYPHENS = "-­‐¬"
EDGE = 4  # lines at either edge of a page that can be furniture
TITLE = 4  # lines with text, from the top, of which one is the title
RATE = 1e-6  # least part of all edge lines that a furniture key makes up: at most 1/RATE keys are learned
SALT_ROWS = 200_000  # suspects of a language and length that are looked up in one task
WORD = re.compile(r"[^\s]+")
OUTER = ".,;:?()[]{}«»“”„\"‘’'…–—•*·/\\"
ROMAN = re.compile(r"^[ivxlc]+$")
PAGE_WORDS = {"page", "seite", "pagina", "p", "pag", "s", "pg", "de", "von", "di", "sur", "of", "n"}
DIGITLIKE = re.compile(r"^(?=.*\d)[0-9OoQIl|!SsZzBbgq.,/]+$")
LIKELY_DIGITS = re.compile(r"^[OQIl|!SZB]{1,4}$")
ODD_RATE = 1e-3  # an odd word without a reading is misread up to this part of its language's words, and always up to ODD_SEEN times
ODD_SEEN = 20
BITS = 22  # the filter for words worth a join has 2**BITS bits, whatever the corpus


def _misread_table() -> dict[str, list[str]]:
    table: dict[str, list[str]] = {}
    for rule in MISREADS.replace("\n", "  ").split("  "):
        if ">" in rule:
            right, _, read = rule.strip().partition(">")
            table.setdefault(right, []).extend(read.split())
    return table


TABLE = _misread_table()


def channel(right: str, read: str, most: int = 3) -> int:
    """Least number of misreadings that turn ``right`` into ``read``, or most+1; a lost accent is one."""
    best = {0: 0}
    inf = most + 1
    rows: list[dict[int, int]] = [best]
    for i in range(len(right) + 1):
        if i >= len(rows) or not rows[i]:
            if i == len(right):
                break
            if all(not r for r in rows[i:]):
                return inf
        for j, cost in list((rows[i] if i < len(rows) else {}).items()):
            if cost > most or i == len(right):
                continue
            while len(rows) < i + 3:
                rows.append({})
            if j < len(read):
                c, r = right[i], read[j]
                if c == r:
                    rows[i + 1][j + 1] = min(rows[i + 1].get(j + 1, inf), cost)
                elif fold(c) == r or fold(c) == fold(r):
                    rows[i + 1][j + 1] = min(rows[i + 1].get(j + 1, inf), cost + 1)
            for width in (1, 2):
                for out in TABLE.get(right[i : i + width], ()) if i + width <= len(right) else ():
                    if read.startswith(out, j):
                        rows[i + width][j + len(out)] = min(rows[i + width].get(j + len(out), inf), cost + 1)
    return min(rows[len(right)].get(len(read), inf), inf) if len(rows) > len(right) else inf


class Automaton:
    """Levenshtein automata up to ``most`` edits, one set of states for all words.

    After d letters a state holds the edits at the word's positions d - most to d + most,
    counted up to most + 1. The next state follows from the state and the bits that tell
    which of those positions hold the letter read, so a step is one lookup; steps are
    computed when first met.
    """

    def __init__(self, most: int):
        self.most, self.width = most, 2 * most + 1
        self.full = (1 << self.width) - 1
        first = tuple(min(max(i - most, 0) if i >= most else most + 1, most + 1) for i in range(self.width))
        self.states, self.known = [first], {first: 0}
        self.steps: list[dict[int, int]] = [{}]

    def step(self, state: int, bits: int) -> int:
        """The state behind ``state``, -1 where every position has more than ``most`` edits."""
        edits, dead = self.states[state], self.most + 1
        new: list[int] = []
        for i in range(self.width):
            right = edits[i] + (not bits >> i & 1)
            new.append(min(right, edits[i + 1] + 1 if i + 1 < self.width else dead, new[-1] + 1 if new else dead, dead))
        found = tuple(new)
        if min(found) == dead:
            at = -1
        elif found in self.known:
            at = self.known[found]
        else:
            at = self.known[found] = len(self.states)
            self.states.append(found)
            self.steps.append({})
        self.steps[state][bits] = at
        return at


AUTOMATA = {most: Automaton(most) for most in (1, 2, 3)}


class Trie:
    """Words by their letters; ``near`` intersects it with the Levenshtein automaton of a word."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str, most: int) -> list[tuple[str, int]]:
        automaton = AUTOMATA[most]
        steps, states, full = automaton.steps, automaton.states, automaton.full
        bits: dict[str, int] = {}
        for i, c in enumerate(word):
            bits[c] = bits.get(c, 0) | 1 << (i + most)  # position d - most is bit 0 after a shift by d
        found, size = [], len(word)
        stack = [(self.root, 0, 0)]
        while stack:
            node, depth, state = stack.pop()
            known = steps[state]
            for c, child in node.items():
                if c == "":
                    at = size - depth + most
                    if 0 <= at <= 2 * most and states[state][at] <= most:
                        found.append((child, states[state][at]))
                    continue
                seen = bits.get(c, 0) >> depth & full
                new = known.get(seen)
                if new is None:
                    new = automaton.step(state, seen)
                if new >= 0:
                    stack.append((child, depth + 1, new))
        return found


# Signs read for letters, put back to compare lines.
PUT_BACK = str.maketrans("0156!|9", "olsbilg")


def _title_line(lines: list[str]) -> int:
    """The line with the document's title: the first in capitals among its first few, else its first; -1 in an empty text."""
    first = list(itertools.islice((i for i, x in enumerate(lines) if x.strip()), TITLE))
    capitals = [i for i in first if lines[i].upper() == lines[i] and sum(c.isalpha() for c in lines[i]) > 3]
    return (capitals or first or [-1])[0]


def _title(lines: list[str]) -> set[str]:
    at = _title_line(lines)
    return {w for w in re.findall(r"[^\W\d_]+", fold(lines[at])) if len(w) > 3} if at >= 0 else set()


def line_key(line: str, title: set[str], near: bool = False, told: dict[str, bool] | None = None) -> str:
    """A line without what changes from page to page and document to document; ``near`` knows the title's words also misread.

    ``told`` keeps what was found for the words of one title.
    """
    told = {} if told is None else told

    def misread(w: str) -> bool:
        if w not in told:
            told[w] = any(abs(len(t) - len(w)) <= 2 and distance(w, t, 2) <= (2 if len(t) > 5 else 1) for t in title)
        return told[w]

    out = []
    for w in re.findall(r"(?:[^\W_]|[!|](?=\w))+", fold(line)):
        if not w.isalpha() and sum(c.isalpha() for c in w) >= 2:
            w = w.translate(PUT_BACK)
        if ROMAN.match(w) or any(c.isdigit() for c in w):
            w = "#"
        elif w in title or near and len(w) > 3 and misread(w):
            w = "@"
        if not (w in "#@" and out and out[-1] == w):
            out.append(w)
    return " ".join(out)


def core(key: str) -> str:
    """A key without its words of one or two letters."""
    out: list[str] = []
    for w in key.split():
        if (len(w) > 2 or w in "#@") and not (w in "#@" and out and out[-1] == w):
            out.append(w)
    return " ".join(out)


def _pages(lines: list[str]) -> list[int]:
    page, at = [], 0
    for line in lines:
        at += line.count("\f")
        page.append(at)
    return page


def _edges(lines: list[str]) -> Iterator[tuple[str, list[int]]]:
    """(zone, lines from the edge inwards) of each page."""
    page = _pages(lines)
    by: dict[int, list[int]] = {}
    for i, p in enumerate(page):
        if lines[i].strip():
            by.setdefault(p, []).append(i)
    for p, rows in by.items():
        yield "top", rows[:EDGE]
        yield "bottom", rows[::-1][:EDGE]


def _is_number(key: str) -> bool:
    words = key.split()
    return "#" in words and all(w == "#" or w in PAGE_WORDS for w in words) and len(words) <= 5


def furniture(text: str, patterns: dict[str, set[str]], alike: dict[tuple[str, str], bool] | None = None) -> set[int]:
    """Numbers of the lines of a text that are page furniture; ``alike`` keeps which keys are near a pattern."""
    alike = {} if alike is None else alike
    lines = text.split("\n")
    title, heading = _title(lines), _title_line(lines)
    keys: dict[int, str] = {}
    zones = list(_edges(lines))
    edge = {i for _, rows in zones for i in rows}
    own: Counter = Counter()
    words: dict[str, bool] = {}
    for i in edge:
        keys[i] = line_key(lines[i], title, True, words)
    for zone, rows in zones:
        for k in {keys[i] for i in rows}:
            own[zone, k] += 1
    inside: set[str] = set()  # keys of the other lines, made when first asked for
    found: set[int] = set()

    def in_body(key: str) -> bool:
        if not inside:
            inside.update(line_key(x, title) for i, x in enumerate(lines) if i not in edge and x.strip())
            inside.add("")
        return key in inside

    def near_pattern(zone: str, short: str) -> bool:
        if (zone, short) not in alike:
            alike[zone, short] = any(abs(len(short) - len(q)) <= 2 and len(q) >= 6 and distance(short, q, 2) <= (2 if len(q) > 9 else 1) for q in patterns[zone])
        return alike[zone, short]

    n = max(1, len(set(_pages(lines))))

    def told(zone: str, i: int) -> bool:
        k = keys[i]
        if not k or not k.strip("@ ") or i == heading:
            return False
        if _is_number(k) and len(lines[i].strip()) <= 24 and "%" not in lines[i] and lines[i].strip()[-1] not in ".;)":
            return True
        short = core(k)
        if short in patterns[zone]:
            return True
        listed = lines[i].strip()[:1] in "–-•*" and lines[i].strip()[-1:] in ";."
        if own[zone, k] >= 2 and own[zone, k] >= 0.5 * (n - 1) and not listed and ("#" in k or "@" in k or len(k) > 12) and not in_body(k):
            return True
        return ("@" in k or "#" in k) and near_pattern(zone, short)

    for zone, rows in zones:
        flags = [told(zone, i) for i in rows]
        # furniture lies outermost: up to the last told line only told ones count
        for i, flag in zip(rows, flags):
            if flag:
                found.add(i)
            else:
                break
    return found


def tokens(line: str) -> list[str]:
    out = []
    for m in WORD.findall(line.replace("\f", " ")):
        w = m.strip(OUTER)
        if w:
            out.append(w)
    return out


def pieces(token: str) -> list[str]:
    """A token and, where it has apostrophes, its parts."""
    if "'" not in token and "’" not in token:
        return [token]
    parts = [p for p in re.split(r"['’]", token) if p]
    return parts if len(parts) > 1 else [token]


@functools.lru_cache(200_000)
def _normal(token: str) -> str:
    return "#" if re.fullmatch(r"[\d.,/  ]+", token) else token.lower() if not re.search(r"[a-zà-ÿ][A-ZÀ-Ý]", token) else token


class Page:
    """The text lines of a document: furniture apart, with their words and broken ends."""

    def __init__(self, text: str, running):
        self.lines = text.split("\n")
        self.running = set(running)
        self.body = [i for i, x in enumerate(self.lines) if i not in self.running and x.replace("\f", "").strip()]

    def broken(self) -> Iterator[tuple[int, int, str, str]]:
        """(line, next line, last part, first part) where a line ends in a hyphen."""
        for a, b in zip(self.body, self.body[1:]):
            end = self.lines[a].rstrip()
            if end[-1:] in HYPHENS and end[-2:-1].isalnum() | (end[-2:-1] in "!|"):
                left = pieces(end.split()[-1].rstrip(HYPHENS).lstrip(OUTER))[-1:]
                right = self.lines[b].replace("\f", " ").split()[0].strip(OUTER)
                if left and right:
                    yield a, b, left[0], pieces(right)[0]

    def words(self) -> Iterator[tuple[int, list[str]]]:
        """(line, its whole words): the parts of a word broken at the line's end are left out."""
        skip = {b for _, b, _, _ in self.broken()}
        for i in self.body:
            got = tokens(self.lines[i])
            end = self.lines[i].rstrip()
            if end[-1:] in HYPHENS and got:
                got = got[:-1] + pieces(got[-1])[:-1]
            if i in skip and got:
                got = pieces(got[0])[1:] + got[1:]
            yield i, got


def _edge_counts(docs: DataFrame) -> DataFrame:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text in pdf["text"]:
                lines = text.split("\n")
                title = _title(lines)
                edge: dict[int, str] = {}
                for zone, rows in _edges(lines):
                    for i in rows[:2]:
                        edge.setdefault(i, zone)
                heading = _title_line(lines)
                for i, line in enumerate(lines):
                    if line.strip() and i != heading:
                        seen[core(line_key(line, title, i in edge)), edge.get(i, "body")] += 1
            if len(seen) > 200_000:
                yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["key", "zone", "n"])
                seen.clear()
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["key", "zone", "n"])

    rows = docs.select("text").mapInPandas(count, "key string, zone string, n long")
    return rows.groupBy("key").agg(*[F.sum(F.when(F.col("zone") == z, F.col("n")).otherwise(0)).alias(z) for z in ("top", "bottom", "body")])


def learn_furniture(docs: DataFrame) -> dict[str, set[str]]:
    """Keys of lines that stand at page edges at least 9 times in 10, 4 times or more and at a rate of RATE: at most 1/RATE of either zone."""
    counts = cut(_edge_counts(docs), "edges")
    sums = counts.agg(F.sum("top"), F.sum("bottom")).first()
    all_ = {"top": sums[0] or 0, "bottom": sums[1] or 0}
    told = lambda z: counts.where(f"key <> '' and {z} >= 4 and {z} >= 0.9 * ({z} + body) and key rlike '[a-z]'").where(F.col(z) >= RATE * all_[z])
    return {z: {r[0] for r in told(z).select("key").collect()} for z in ("top", "bottom")}


def _vocabulary(docs: DataFrame) -> DataFrame:
    """(lang, a, b, n): counts of words (b empty) and of neighbours, over all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for text, lang, running in zip(pdf["text"], pdf["lang"], pdf["running"]):
                for _, got in Page(text, running).words():
                    words = [_normal(p) for t in got for p in pieces(t)]
                    for t in got:
                        if "'" in t or "’" in t:
                            seen[lang, _normal(t), ""] += 1
                    for w in words:
                        seen[lang, w, ""] += 1
                    for pair in zip(words, words[1:]):
                        seen[lang, *pair] += 1
            if len(seen) > 300_000:
                yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "a", "b", "n"])
                seen.clear()
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "a", "b", "n"])

    return docs.select("text", "lang", "running").mapInPandas(count, "lang string, a string, b string, n long").groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))


def _breaks(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for id_, lang, text, running in zip(pdf["id"], pdf["lang"], pdf["text"], pdf["running"]):
                for a, b, left, right in Page(text, running).broken():
                    rows.append((id_, lang, a, b, left, right, _normal(left + right), _normal(left + "-" + right), _normal(left), _normal(right)))
            yield pd.DataFrame(rows, columns=["id", "lang", "line", "below", "first", "second", "whole", "hyphened", "l", "r"])

    return docs.mapInPandas(run, "id bigint, lang string, line int, below int, first string, second string, whole string, hyphened string, l string, r string")


def odd(token: str) -> bool:
    """Signs or digits among the letters, or a capital after small ones: no word is printed so."""
    core = token.strip("!?")
    letters = sum(c.isalpha() for c in core)
    return letters > 0 and (bool(re.search(r"[a-zà-ÿ][A-ZÀ-Ý]", core)) or any(c in "!|0123456789" for c in core))


def _candidates(suspects: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, t, v, edits): all words within 2 edits (3 from nine letters on), from tries by language and length.

    The suspects of a language and length are dealt over as many tasks as their number asks for.
    """
    groups = suspects.groupBy("lang", F.length("t").alias("size")).agg(F.count("*").alias("n"))
    salts = max(8, -(-(groups.agg(F.max("n")).first()[0] or 0) // SALT_ROWS))
    left = suspects.select(F.col("lang").alias("lang_t"), F.length("t").alias("size_t"), F.pmod(F.xxhash64("t"), F.lit(salts)).alias("salt_t"), F.col("t").alias("t"))
    span = F.sequence(F.greatest(F.length("v") - 3, F.lit(1)), F.length("v") + 3)
    right = words.select("lang", F.explode(span).alias("size"), "v").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(a) and len(b):
            trie = Trie(list(b["v"]))
            for t in a["t"]:
                most = 3 if len(t) >= 9 else 2 if len(t) >= 3 else 1
                rows += [(key[0], t, v, e) for v, e in trie.near(t, most) if v != t]
        return pd.DataFrame(rows, columns=["lang", "t", "v", "edits"])

    schema = "lang string, t string, v string, edits int"
    right = right.select(F.col("lang").alias("lang_v"), F.col("size").alias("size_v"), F.col("salt").alias("salt_v"), F.col("v").alias("v"))
    return left.groupBy("lang_t", "size_t", "salt_t").cogroup(right.groupBy("lang_v", "size_v", "salt_v")).applyInPandas(run, schema)


def _judge(candidates: DataFrame) -> DataFrame:
    """(lang, t, v, sure): the best reading of each suspect, and whether frequency alone decides."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cost = [channel(v, t) for t, v in zip(pdf["t"], pdf["v"])]
            yield pdf.assign(cost=cost)[["lang", "t", "v", "edits", "cost", "nt", "nv"]]

    scored = candidates.mapInPandas(run, "lang string, t string, v string, edits int, cost int, nt long, nv long")
    typical = F.col("cost") <= F.when(F.length("t") >= 7, 3).when(F.length("t") >= 4, 2).otherwise(1)
    ratio = F.col("nv") / F.greatest(F.col("nt"), F.lit(1))
    sure = (typical & (ratio >= F.when(F.length("t") >= 4, 15).otherwise(60))) | ((ratio >= 60) & (F.length("t") >= 5) & (F.col("edits") <= F.when(F.length("t") >= 7, 2).otherwise(1)))
    doubtful = typical & (ratio >= 4) | typical & (F.col("nt") <= 2) & (ratio >= 2)
    rank = F.struct(sure.alias("sure"), typical.alias("typical"), (-F.col("cost")).alias("c"), F.col("nv"), F.col("v"))
    best = scored.where(sure | doubtful).groupBy("lang", "t").agg(F.max(rank).alias("x"), F.first("nt").alias("nt"))
    return best.select("lang", "t", "nt", F.col("x.v").alias("v"), F.col("x.sure").alias("sure"))


@functools.lru_cache(200_000)
def _hash(lang: str, word: str) -> int:
    return zlib.crc32(f"{lang} {word}".encode()) & ((1 << BITS) - 1)


def _occurrences(docs: DataFrame, marked) -> DataFrame:
    """Words that may be misread where they stand: (id, lang, line, t, before, after, plain), plain: no lookup needed, but of ``after`` where before is ``unit``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = marked.value
        for pdf in batches:
            rows = []
            for id_, lang, text, running in zip(pdf["id"], pdf["lang"], pdf["text"], pdf["running"]):
                page = Page(text, running)
                for line, got in page.words():
                    for t in got:
                        if DIGITLIKE.match(t) and re.search(r"[A-Za-z|!]", t):
                            rows.append((id_, lang, line, t, "", "", True))
                    words = [_normal(p) for t in got for p in pieces(t)]
                    if len(words) != len(got):
                        for t in got:
                            if len(pieces(t)) > 1 and bits[_hash(lang, _normal(t))]:
                                rows.append((id_, lang, line, _normal(t), "", "", False))
                    for k, w in enumerate(words):
                        after = words[k + 1] if k + 1 < len(words) else ""
                        if bits[_hash(lang, w)]:
                            rows.append((id_, lang, line, w, words[k - 1] if k else "", after, False))
                    for a, b in zip(got, got[1:]):
                        if LIKELY_DIGITS.match(a) and b == _normal(b):  # a number, where a unit follows
                            rows.append((id_, lang, line, a, "unit", _normal(b), True))
                    # a small i read as an exclamation mark at the end of a word
                    for m in re.finditer(r"([^\W\d_]+)!(?=\s+[a-zà-ÿ])", page.lines[line]):
                        rows.append((id_, lang, line, m.group(1), "", "", True))
            yield pd.DataFrame(rows, columns=["id", "lang", "line", "t", "before", "after", "plain"])

    return docs.mapInPandas(run, "id bigint, lang string, line int, t string, before string, after string, plain boolean")


def _with_running(docs: DataFrame, patterns) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alike: dict[tuple[str, str], bool] = {}
        for pdf in batches:
            if len(alike) > 300_000:
                alike.clear()
            yield pdf.assign(running=[sorted(furniture(t, patterns.value, alike)) for t in pdf["text"]])

    return docs.select("id", "lang", "text").mapInPandas(run, "id bigint, lang string, text string, running array<int>")


def with_language(df: DataFrame, text: str, label: str, langs: list[str], sample: int = 4_000) -> DataFrame:
    """``df`` with column lang: the label's code, or for rows without one the likeliest by a model fitted on the whole texts of at most about ``sample`` labelled rows."""
    labelled = df.withColumn("lang", language_code(F.col(label)))
    model = df.sparkSession.sparkContext.broadcast(train(labelled.select(F.col(text).alias("text"), "lang"), langs, sample))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m: LanguageModel = model.value
        for pdf in batches:
            lang = [x if x else m.best(t) for x, t in zip(pdf["lang"], pdf[text])]
            yield pdf.assign(lang=lang)

    return labelled.mapInPandas(fill, labelled.schema)


def marks(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(running(id, line), hyphen(id, line, below, whole), glyph(id, line, t, v)) of documents (id bigint, lang string, text string not null).

    Lines count from 0 at each line feed. Empty texts have no rows.
    """
    sc = docs.sparkSession.sparkContext
    docs = cut(spread(docs.select("id", "lang", "text")), "pages")
    docs = cut(_with_running(docs, sc.broadcast(learn_furniture(docs))), "furnished")
    counts = cut(_vocabulary(docs), "words")
    words = counts.where("b = ''").select("lang", F.col("a").alias("t"), F.col("n").alias("nt"))
    breaks = cut(_breaks(docs), "breaks")

    forms = breaks.select("lang", F.explode(F.array("whole", "hyphened", "l", "r")).alias("t")).distinct().join(words, ["lang", "t"], "left")
    wholes = breaks.select("lang", F.col("whole").alias("t")).distinct().join(words, ["lang", "t"], "left_anti").withColumn("nt", F.lit(0).cast("long"))
    suspects = words.where(F.col("t").rlike(r"(?U)\p{L}")).unionByName(wholes)
    trusted = words.where((F.col("nt") >= 3) & F.col("t").rlike(r"(?U)^[\p{L}-]+$") & ~F.col("t").rlike(r"(?U)\p{Ll}\p{Lu}")).select("lang", F.col("t").alias("v"), F.col("nt").alias("nv"))
    # a word more frequent than a fifteenth of the most frequent one can't be a misreading of any
    most = words.where("t <> '#'").groupBy("lang").agg(F.max("nt").alias("top"))
    suspects = suspects.join(F.broadcast(most), "lang").where(F.col("nt") * 4 <= F.col("top")).select("lang", "t", "nt")  # one row per language
    near = _candidates(suspects.select("lang", "t"), trusted.select("lang", "v"))
    near = near.join(suspects, ["lang", "t"]).join(trusted, ["lang", "v"])
    verdicts = cut(_judge(near.where("nv > nt")), "verdicts")
    totals = words.groupBy("lang").agg(F.sum("nt").alias("all"))  # one row per language
    odd_words = words.where(_odd("t")).join(F.broadcast(totals), "lang").select("lang", "t", "nt", (F.col("nt") <= F.greatest(F.lit(ODD_SEEN), ODD_RATE * F.col("all"))).alias("rare"))
    verdicts = cut(
        verdicts.join(odd_words.select("lang", "t", F.lit(True).alias("odd")), ["lang", "t"], "left").select("lang", "t", "nt", "v", (F.col("sure") | F.coalesce("odd", F.lit(False))).alias("sure"))
        .unionByName(odd_words.join(verdicts, ["lang", "t"], "left_anti").where((F.length("t") >= 4) & F.col("rare") & F.col("t").rlike(r"(?U)\p{L}.*[!|]|\p{L}\d\p{L}|^\d\p{Ll}{3,}|\p{L}{3,}\d$")).select("lang", "t", "nt", F.lit(None).cast("string").alias("v"), F.lit(True).alias("sure"))),
        "judged",
    )

    seen = cut(_occurrences(docs, sc.broadcast(_filter(verdicts))), "seen")
    told = seen.where("plain and before <> 'unit'").unionByName(seen.where("plain and before = 'unit'").join(_units(counts), ["lang", "after"], "left_semi").select(*seen.columns))
    exclaimed = told.withColumn("low", F.lower("t"))
    known = words.select("lang", F.col("t").alias("low"), "nt")
    plain = exclaimed.where(F.col("t").rlike(r"\d|^[OQIl|!SZB]+$")).select("id", "line", "t", F.lit(None).cast("string").alias("v"))
    cut_off = exclaimed.where(~F.col("t").rlike(r"\d|^[OQIl|!SZB]+$")).withColumn("full", F.concat("low", F.lit("i")))
    cut_off = cut_off.join(known, ["lang", "low"], "left").join(known.select("lang", F.col("low").alias("full"), F.col("nt").alias("nf")), ["lang", "full"]).where(F.col("nf") > 3 * F.coalesce("nt", F.lit(0)))
    judged = seen.where("not plain").join(verdicts, ["lang", "t"])
    glyph = judged.where("sure").select("id", "line", "t", "v").unionByName(plain).unionByName(cut_off.select("id", "line", "t", F.col("full").alias("v")))
    glyph = glyph.unionByName(_by_context(judged.where("not sure"), counts))

    table = forms.select("lang", "t", F.coalesce("nt", F.lit(0)).alias("n"))
    b = breaks
    for c in ("whole", "hyphened", "l", "r"):
        b = b.join(table.select("lang", F.col("t").alias(c), F.col("n").alias(f"n_{c}")), ["lang", c], "left")
    b = b.join(verdicts.where("v is not null").select("lang", F.col("t").alias("whole"), F.col("v").alias("meant")), ["lang", "whole"], "left")
    found_whole = (F.col("n_whole") > 0) | F.col("meant").isNotNull()
    both = (F.col("n_l") >= 3) & (F.col("n_r") >= 3)
    joined = F.when(F.col("n_hyphened") > F.col("n_whole"), False).when(found_whole, True).when(both, False).otherwise(True)
    b = cut(b.withColumn("joined", joined), "joined")
    hyphen = b.where("joined").select("id", "line", "below", F.coalesce("meant", "whole").alias("whole"))
    parts = b.where("joined and meant is not null and n_whole = 0").select("id", "line", "below", "first", "second", "whole", "meant")
    left_bad = ~F.col("meant").startswith(F.lower("first"))
    right_bad = ~F.col("meant").endswith(F.lower("second"))
    torn = parts.where(left_bad).select("id", "line", F.col("whole").alias("t"), F.col("meant").alias("v")).unionByName(parts.where(right_bad).select("id", F.col("below").alias("line"), F.col("whole").alias("t"), F.col("meant").alias("v")))
    sign = r"(?U)\p{L}[0-9!|]|[0-9!|]\p{Ll}{2,}"
    bare = b.where("meant is null or n_whole > 0")
    torn = torn.unionByName(bare.where(F.col("first").rlike(sign)).select("id", "line", F.col("first").alias("t"), F.lit(None).cast("string").alias("v")))
    torn = torn.unionByName(bare.where(F.col("second").rlike(sign)).select("id", F.col("below").alias("line"), F.col("second").alias("t"), F.lit(None).cast("string").alias("v")))
    return docs.select("id", F.explode("running").alias("line")), hyphen, glyph.unionByName(torn)


def _filter(words: DataFrame) -> np.ndarray:
    """One bit per hash of (lang, t): a bitmap of 2**BITS bits in parts of 64 KiB, put together before the driver sees them."""
    size = 1 << 16
    parts = words.select(_bucket("lang", "t").alias("b")).select(F.expr(f"b div {8 * size}").cast("int").alias("part"), F.expr(f"b % {8 * size}").cast("int").alias("bit")).distinct()

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(8 * size, dtype=bool)
        bits[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})

    found = np.zeros(1 << BITS, dtype=bool)
    for r in parts.groupBy("part").applyInPandas(packed, "part int, bits binary").collect():  # 2**BITS / 8 bytes in all
        found[r["part"] * 8 * size : (r["part"] + 1) * 8 * size] = np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8)).astype(bool)
    return found


def _bucket(*columns: str):
    return F.crc32(F.concat_ws(" ", *columns).cast("binary")).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")


def _odd(column: str):
    core = F.regexp_replace(F.col(column), r"^[!?]+|[!?]+$", "")
    return core.rlike(r"(?U)\p{L}") & core.rlike(r"(?U)\p{Ll}\p{Lu}|[!|0-9]")


def _units(counts: DataFrame) -> DataFrame:
    """(lang, after): words that stand behind a number half of the time or more, and three times at least."""
    behind = counts.where("a = '#' and b <> '' and n >= 3").select("lang", F.col("b").alias("after"), F.col("n").alias("behind"))
    alone = counts.where("b = ''").select("lang", F.col("a").alias("after"), "n")
    return behind.join(alone, ["lang", "after"]).where("after <> '#' and 2 * behind >= n").select("lang", "after")


def _by_context(doubtful: DataFrame, counts: DataFrame) -> DataFrame:
    """Of words that may be right, those that their neighbours expect to be another: (id, line, t, v)."""
    pairs = counts.where("b <> ''").select("lang", "a", "b", "n")
    rows = doubtful.select("id", "line", "lang", "t", "v", "before", "after").withColumn("row", F.monotonically_increasing_id())
    rows = cut(rows, "doubtful")
    asked = F.array(
        F.struct(F.col("before").alias("a"), F.col("t").alias("b"), F.lit(0).alias("k")), F.struct(F.col("t").alias("a"), F.col("after").alias("b"), F.lit(0).alias("k")),
        F.struct(F.col("before").alias("a"), F.col("v").alias("b"), F.lit(1).alias("k")), F.struct(F.col("v").alias("a"), F.col("after").alias("b"), F.lit(1).alias("k")),
    )
    told = rows.select("row", "lang", F.explode(asked).alias("q")).select("row", "lang", "q.a", "q.b", "q.k").join(pairs, ["lang", "a", "b"])
    sums = told.groupBy("row").agg(F.sum(F.when(F.col("k") == 0, F.col("n")).otherwise(0)).alias("own"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("other"))
    return rows.join(sums, "row").where((F.col("other") >= 4) & (F.col("other") >= 12 * F.greatest(F.col("own") - 2, F.lit(0)) + 2)).select("id", "line", "t", "v")


# Signs read for digits, put back in numbers; g, q and ! after the last digit may be meant.
DIGITS = str.maketrans({read: right for right in "012589" for read in TABLE[right]})
LIST_MARK = re.compile(r"\s*(?:[–—•*·-]\s|[a-z0-9]{1,2}\)\s)")
HEADER = re.compile(r"\s*[a-z]\)\s")


def cased(word: str, like: str, begins: bool) -> str:
    """``word`` in the case of the read form; a misread first sign is a capital where a sentence begins."""
    letters = [c for c in like if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return word.upper()
    capital = like[:1].isupper() or begins and fold(like[:1]) != fold(word[:1])
    return word[:1].upper() + word[1:] if capital else word


def corrected(line: str, readings: list[tuple[str, str | None]], begins: bool) -> str:
    """A line with the readings (t, v) of its misread words put in; signs around a word stay."""
    known = {t: v for t, v in readings if v is not None}
    unknown = {t for t, v in readings if v is None}

    def piece(p: str, first: bool) -> str:
        v = known.get(_normal(p), known.get(p))
        return p if v is None else cased(v, p, first)

    def one(m: re.Match) -> str:
        whole = m.group()
        token = whole.strip(OUTER)
        if not token:
            return whole
        at = whole.index(token)
        before = line[: m.start()].rstrip(" «„“\"(")
        first = before[-1:] in (".", "!", "?") if before else begins
        stem = token[:-1]
        if token in unknown and (LIKELY_DIGITS.match(token) or DIGITLIKE.match(token)):
            new = token.translate(DIGITS)
            new = stem.translate(DIGITS) + token[-1] if token[-1] in "gq!" else new
        elif token[-1] == "!" and stem.isalpha() and known.get(stem) == stem.lower() + "i" and re.match(r"\s+[a-zà-ÿ]", line[m.end() :]):
            new = cased(known[stem], stem, first)
        elif _normal(token) in known:
            new = piece(token, first)
        else:
            new = "".join(p if p in "'’" else piece(p, first) for p in re.split(r"(['’])", token) if p)
        return whole[:at] + new + whole[at + len(token) :]

    return WORD.sub(one, line)


def _goes_on(page: Page, a: int, b: int, pages: list[int], width: int, in_list: bool) -> bool:
    """Whether text line b belongs to the paragraph of text line a, the one before it."""
    above, below = page.lines[a].replace("\f", "").rstrip(), page.lines[b].replace("\f", "").rstrip()
    ended = above.rstrip("»“”\")")[-1:] in (".", "!", "?", ":", ";", "…")
    if HEADER.match(below) or LIST_MARK.match(below) and (in_list or ended):
        return False
    if in_list and ended:
        return False
    if pages[a] == pages[b] and not page.running.intersection(range(a + 1, b)):
        return b == a + 1
    if HEADER.match(above) or below.startswith("  ") and (ended or not below.strip()[:1].islower()):
        return False
    # over a page's end: a sentence goes on, or the next word had no room on the line
    return not ended and below.strip()[:1].islower() or len(above) + 1 + len(below.split()[0]) > width


def paragraphs(text: str, running, hyphens: dict[int, str], readings: dict[int, list[tuple[str, str | None]]]) -> list[str]:
    """The paragraphs of a text without its furniture, with broken words joined and readings put in.

    ``hyphens``: the whole word, by the line it begins in; other words broken at a hyphen keep it.
    """
    page = Page(text, running)
    pages, width = _pages(page.lines), max((len(page.lines[i].rstrip()) for i in page.body), default=0)
    broken = {a: (b, left, right) for a, b, left, right in page.broken()}
    out: list[str] = []
    last, carried = -1, None  # carried: the first part of the word that goes on in this line
    in_list = False
    for i in page.body:
        line = page.lines[i].replace("\f", " ").strip()
        glue = carried is not None
        if last < 0 or not glue and not _goes_on(page, last, i, pages, width, in_list):
            out.append("")
            in_list = bool(LIST_MARK.match(page.lines[i].replace("\f", " ")))
        said = out[-1]
        head = ""
        if carried is not None:  # the word's second part
            whole, left, right = carried
            at = line.index(right)
            end = at + len(right)
            if whole is None:
                head = "-" + line[:end]
            elif _normal(left + right) == whole:
                head = right
            else:
                head, said = cased(whole, left + right, False), said[: len(said) - len(left)]
            line = line[end:]
        tail, carried = "", None
        if i in broken:
            _, left, right = broken[i]
            body = line.rstrip(HYPHENS)
            cut_at = body.rfind(left)
            if cut_at >= 0:
                line, tail = body[:cut_at], left
                carried = (hyphens.get(i), left, right)
        begins = not said or said.rstrip(" «„“\"(")[-1:] in (".", "!", "?")
        line = head + corrected(line, readings.get(i, []), begins and not head) + tail
        out[-1] = said + ("" if glue or not said else " ") + line
        last = i
    return [x for x in (" ".join(p.split()) for p in out) if x]


def repaired(parts: DataFrame, running: DataFrame, hyphen: DataFrame, glyph: DataFrame) -> DataFrame:
    """(cahier_id, field, para_no, text): paragraphs of ``parts`` (id, cahier_id, field, first, text), given marks() by id.

    ``first`` is the line of the marked document at which a part's text begins. A reading
    is put in for every such word of its line. Misread words without a known reading stay
    as they are, and so does the case of a misread first letter inside a sentence.
    """
    none = F.lit(None).cast("string")
    rows = (
        running.select("id", F.struct(F.lit("running").alias("kind"), "line", none.alias("t"), none.alias("v")).alias("m"))
        .unionByName(hyphen.select("id", F.struct(F.lit("hyphen").alias("kind"), "line", none.alias("t"), F.col("whole").alias("v")).alias("m")))
        .unionByName(glyph.distinct().select("id", F.struct(F.lit("glyph").alias("kind"), "line", "t", "v").alias("m")))
    )
    joined = parts.join(rows.groupBy("id").agg(F.sort_array(F.collect_list("m")).alias("marks")), "id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for cahier, field, first, text, marks in zip(pdf["cahier_id"], pdf["field"], pdf["first"], pdf["text"], pdf["marks"]):
                gone, hyphens, readings = set(), {}, {}
                for m in marks if marks is not None else ():
                    line = m["line"] - first
                    if m["kind"] == "running":
                        gone.add(line)
                    elif m["kind"] == "hyphen":
                        hyphens[line] = m["v"]
                    else:
                        readings.setdefault(line, []).append((m["t"], m["v"]))
                out += [(cahier, field, n, p) for n, p in enumerate(paragraphs(text, gone, hyphens, readings))]
            yield pd.DataFrame(out, columns=["cahier_id", "field", "para_no", "text"])

    return spread(joined.select("cahier_id", "field", "first", "text", "marks")).mapInPandas(run, "cahier_id bigint, field string, para_no int, text string")


# The languages of the specifications.
LANGS = ["de", "es", "fr", "it"]


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """(id, cahier_id, source_lang, field, first, text): both fields; a section that stands in raw_text shares its id, any other is a document of its own."""
    rows = once_per_key(spark.read.parquet(f"{folder}/cahier_extract.parquet").select("cahier_id", "source_lang", "raw_text", "lien_au_terroir"), "cahier_id")
    at = F.expr("coalesce(locate(lien_au_terroir, raw_text), 0)")
    before = F.expr("length(substring(raw_text, 1, at - 1)) - length(replace(substring(raw_text, 1, at - 1), '\n', ''))")
    raw = rows.where("raw_text is not null").select((2 * F.col("cahier_id")).alias("id"), "cahier_id", "source_lang", F.lit("raw_text").alias("field"), F.lit(0).alias("first"), F.col("raw_text").alias("text"))
    section = rows.where("lien_au_terroir <> ''").withColumn("at", at).select(
        (2 * F.col("cahier_id") + (F.col("at") == 0).cast("int")).alias("id"), "cahier_id", "source_lang", F.lit("lien_au_terroir").alias("field"),
        F.when(F.col("at") > 0, before).otherwise(0).cast("int").alias("first"), F.col("lien_au_terroir").alias("text"),
    )
    return cut(spread(raw.unionByName(section)), "parts")


def _marked(parts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = parts.where("field = 'raw_text' or id % 2 <> 0").select("id", "source_lang", "text")
    return marks(with_language(docs, "text", "source_lang", LANGS))


def found(spark: SparkSession, folder: str) -> DataFrame:
    """The marks of the lines of both fields; a section that stands in raw_text has those of its lines there, any other its own."""
    parts = _parts(spark, folder)
    running, hyphen, glyph = _marked(parts)
    kinds = [x.select("id", "line", F.lit(kind).alias("kind")) for x, kind in ((running, "running"), (hyphen, "hyphen"), (glyph, "glyph"))]
    marked = kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).distinct()
    more = F.expr("length(text) - length(replace(text, '\n', ''))")
    where = parts.select("id", "cahier_id", "field", "first", more.alias("more"))
    inside = marked.join(where, "id").where((F.col("line") >= F.col("first")) & (F.col("line") <= F.col("first") + F.col("more")))
    return inside.select("cahier_id", "field", (F.col("line") - F.col("first")).cast("int").alias("line_no"), "kind")


def repaired_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The paragraphs of both fields."""
    parts = _parts(spark, folder)
    return repaired(parts.drop("source_lang"), *_marked(parts))

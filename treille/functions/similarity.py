"""String similarities without a built-in, as Arrow-batched UDFs."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def longest_common(a: str, b: str) -> int:
    """Length of the longest common substring, by a suffix automaton of the shorter: linear time."""
    if len(a) > len(b):
        a, b = b, a
    links, lengths, nexts, last = [-1], [0], [{}], 0
    for c in a:
        cur = len(nexts)
        nexts.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = cur
            p = links[p]
        if p != -1:
            q = nexts[p][c]
            if lengths[p] + 1 == lengths[q]:
                links[cur] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = links[p]
                links[q] = links[cur] = clone
        last = cur
    best = at = length = 0
    for c in b:
        while at and c not in nexts[at]:
            at = links[at]
            length = lengths[at]
        if c in nexts[at]:
            at = nexts[at][c]
            length += 1
        best = max(best, length)
    return best


def indel_ratio(a: str, b: str) -> float:
    """1 - indel distance over total length, between 0 and 1."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    total = len(a) + len(b)
    return 2 * row[-1] / total if total else 1.0


@F.pandas_udf(T.DoubleType())
def coverage(quote: pd.Series, source: pd.Series) -> pd.Series:
    """Part of the quote that its longest match in the source covers, blanks and case aside; null for null."""
    def one(q, s):
        if q is None or s is None:
            return None
        q, s = " ".join(q.lower().split()), " ".join(s.lower().split())
        return longest_common(q, s) / len(q) if q else 0.0

    return pd.Series([one(q, s) for q, s in zip(quote, source)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Indel ratio of the sorted words."""
    return pd.Series([None if x is None or y is None else indel_ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split()))) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() for x, y in zip(a, b)], dtype="float64")


def deletions(word: str, k: int) -> set[str]:
    """``word`` without up to k of its letters: two words within k edits share one of these."""
    out = {word}
    edge = {word}
    for _ in range(k):
        edge = {w[:i] + w[i + 1 :] for w in edge for i in range(len(w))}
        out |= edge
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def shortened(words: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series([list(deletions(w, int(n))) for w, n in zip(words, k)], dtype=object)

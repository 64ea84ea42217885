"""All similar pairs of set-valued records.

A pair with Jaccard similarity p/q or more shares at least T = ceil(p(n+m)/(p+q)) values.
The inverted lists are partitioned by the rarest values: sets that share T >= 2 values
share their two rarest common ones, and those lie in the first n-T+2 values of either set
ordered by frequency. Each partition therefore holds the lists of the records with one
pair of rare values; a hot partition is cut into blocks of bounded size and joined block by
block. Inside a partition a record's lists are merged with a heap that skips what can't
reach T, and the longest lists are only searched by bisection. Records with equal sets are
one class; links between classes and the members of each class hold all pairs. Two tables
are joined in the same way, each block of one with each block of the other.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.operators.dedup import once_per_key
from treille.plans.lineage import cut


def value_sets(df: DataFrame, key: str, columns: list[str], min_size: int = 1) -> DataFrame:
    """(rec, vals): the distinct non-null values of the array columns, for records with ``min_size`` or more of them.

    Null and empty arrays give no values; rows with a null key are left out; a key
    delivered again counts once.
    """
    empty = F.array().cast("array<string>")
    values = F.concat(*[F.coalesce(F.col(c).cast("array<string>"), empty) for c in columns])
    values = F.array_sort(F.array_distinct(F.array_compact(values)))
    rows = once_per_key(df.select(F.col(key).alias("rec"), *columns), "rec")
    return rows.select("rec", values.alias("vals")).where(F.size("vals") >= min_size)


def required(n: int, m: int, p: int, q: int) -> int:
    return -(-p * (n + m) // (p + q))


def t_occurrence(lists: list[list[int]], need: int, start: int, longest: int) -> Iterator[tuple[int, int]]:
    """(record, occurrences) for the records from ``start`` on that stand in ``need`` or more of the sorted ``lists``.

    The ``longest`` lists (at most need-1) are left out of the heap and searched by
    bisection for the candidates the others give.
    """
    lists = sorted(lists, key=len)
    longest = max(0, min(longest, need - 1, len(lists) - 1))
    short, long = lists[: len(lists) - longest], lists[len(lists) - longest :]
    least = need - len(long)
    heap = []
    for i, entries in enumerate(short):
        at = bisect_left(entries, start) if start else 0
        if at < len(entries):
            heap.append((entries[at], i, at))
    heapq.heapify(heap)
    spots = [0] * len(long)
    while len(heap) >= least:
        record = heap[0][0]
        popped = []
        while heap and heap[0][0] == record:
            popped.append(heapq.heappop(heap))
        count = len(popped)
        if count >= least:
            for j, entries in enumerate(long):
                if count + len(long) - j < need:
                    break
                spots[j] = at = bisect_left(entries, record, spots[j])
                count += at < len(entries) and entries[at] == record
            if count >= need:
                yield record, count
            for _, i, at in popped:
                if at + 1 < len(short[i]):
                    heapq.heappush(heap, (short[i][at + 1], i, at + 1))
        else:
            # no record before the (least)th smallest front can occur often enough: skip to it
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            goal = heap[0][0]
            for _, i, at in popped:
                at = bisect_left(short[i], goal, at + (short[i][at] < goal))
                if at < len(short[i]):
                    heapq.heappush(heap, (short[i][at], i, at))


def _join_group(k1: int, k2: int, rows: list[tuple[int, list[int], int]], across: bool, p: int, q: int) -> Iterator[tuple[int, int, int]]:
    """Links of one partition of the inverted lists; k2 < 0 where the key is one value.

    Rows are (record, values, block). ``across``: only links between the two blocks, the
    record of the lesser block first.
    """
    rows.sort(key=lambda r: (len(r[1]), r[0], r[2]))
    index: dict[int, dict[int, list[int]]] = {}
    for at, (_, values, block) in enumerate(rows):
        lists = index.setdefault(block, {})
        for v in values:
            lists.setdefault(v, []).append(at)
    blocks = sorted(index)
    if across and len(blocks) < 2:
        return
    single = k2 < 0
    for at, (rec, values, block) in enumerate(rows):
        n = len(values)
        need = required(n, n, p, q)
        own_lists = index[blocks[1] if block == blocks[0] else blocks[0]] if across else index[block]
        lists = [own_lists[v] for v in values if v in own_lists]
        if len(lists) < need:
            continue
        size = max(map(len, lists))
        longest = int(need / (0.1 * math.log2(size + 1) + 1)) if size > 1 else 1
        own = set(values)
        for other, count in t_occurrence(lists, need, at + 1, longest):
            rec2, values2, _ = rows[other]
            m = len(values2)
            if m * p > n * q:
                break  # records are ordered by size
            if count < required(n, m, p, q):
                continue
            shared = [v for v in values2 if v in own]  # values2 is ordered
            alone = min(-(-p * n // q), -(-p * m // q)) < 2
            if alone == single and shared[0] == k1 and (single or shared[1] == k2):
                yield (rec2, rec, count) if across and block == blocks[1] else (rec, rec2, count)


def _entries(classes: DataFrame, ids: DataFrame, p: int, q: int) -> DataFrame:
    """(k1, k2, cid, s): every set under the keys of the partitions it belongs to, its values as numbers that rise with the frequency."""
    sets = classes.select("cid", F.explode("vals").alias("v")).join(ids, "v").groupBy("cid").agg(F.array_sort(F.collect_list("id")).alias("s"))
    n = F.size("s")
    least = F.ceil(n * p / F.lit(q)).cast("int")
    lowest = F.ceil(least * p / F.lit(q)).cast("int")
    head = F.slice("s", 1, n - least + 2)
    pairs = F.flatten(F.transform(head, lambda x, i: F.transform(F.slice(head, i + 2, n), lambda y: F.struct(x.alias("k1"), y.alias("k2")))))
    ones = F.transform(F.slice("s", 1, n - least + 1), lambda x: F.struct(x.alias("k1"), F.lit(-1).cast("long").alias("k2")))
    none = F.array().cast("array<struct<k1:bigint,k2:bigint>>")
    keys = F.concat(F.when(least >= 2, pairs).otherwise(none), F.when(lowest < 2, ones).otherwise(none))
    return sets.select("cid", "s", F.explode(keys).alias("k")).select("k.k1", "k.k2", "cid", "s")


def _ids(sets: DataFrame) -> DataFrame:
    """(v, id): a number for each value that rises with its frequency: the sort is by range, so numbers rise over its partitions."""
    counts = sets.select(F.explode("vals").alias("v")).groupBy("v").agg(F.count("*").alias("freq"))
    return cut(counts.orderBy("freq", "v").select("v", F.monotonically_increasing_id().alias("id")), "values")


def _joined(blocked: DataFrame, p: int, q: int) -> DataFrame:
    """(a, b, overlap) of rows (k1, k2, part, block, across, cid, s), each (k1, k2, part) in one task."""

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows, out = None, [], []
        for pdf in batches:
            for k1, k2, part, block, across, cid, s in zip(*[pdf[c] for c in ("k1", "k2", "part", "block", "across", "cid", "s")]):
                if (k1, k2, part, across) != key:
                    if len(rows) > 1:
                        out.extend(_join_group(key[0], key[1], rows, key[3], p, q))
                    key, rows = (k1, k2, part, across), []
                    if len(out) > 20_000:
                        yield pd.DataFrame(out, columns=["a", "b", "overlap"])
                        out = []
                rows.append((cid, s.tolist(), block))
        if len(rows) > 1:
            out.extend(_join_group(key[0], key[1], rows, key[3], p, q))
        yield pd.DataFrame(out, columns=["a", "b", "overlap"])

    grouped = blocked.repartition("k1", "k2", "part").sortWithinPartitions("k1", "k2", "part")
    return grouped.mapInPandas(join, "a bigint, b bigint, overlap int")


def class_links(classes: DataFrame, p: int = 3, q: int = 4, part_rows: int = 2000) -> DataFrame:
    """(cid_a, cid_b, overlap) for pairs of different sets with Jaccard similarity p/q or more.

    ``classes`` has (cid long, vals array of distinct strings), a row per distinct set.
    Empty sets have no links. A partition of the inverted lists of more than ``part_rows``
    rows is cut into blocks of about that size, and each pair of blocks is a task's work.
    """
    classes = classes.where(F.size("vals") > 0)
    entries = _entries(classes, _ids(classes), p, q)
    shared = entries.groupBy("k1", "k2").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("blocks", F.ceil(F.col("rows") / part_rows).cast("int"))
    blocked = entries.join(shared, ["k1", "k2"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    blocked = blocked.select("k1", "k2", "cid", "s", "blocks", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    part = F.least("block", "with").cast("long") * F.col("blocks") + F.greatest("block", "with")
    links = _joined(blocked.select("k1", "k2", part.alias("part"), "block", (F.col("block") != F.col("with")).alias("across"), "cid", "s"), p, q)
    return links.select(F.least("a", "b").alias("cid_a"), F.greatest("a", "b").alias("cid_b"), "overlap")


def links_between(left: DataFrame, right: DataFrame, p: int = 3, q: int = 4, part_rows: int = 2000) -> DataFrame:
    """(cid_a, cid_b, overlap) for pairs of a set of ``left`` and one of ``right`` with Jaccard similarity p/q or more, equal ones too.

    Both have (cid long, vals array of distinct strings), a row per distinct set; their ids
    are apart from each other.
    """
    left, right = left.where(F.size("vals") > 0).select("cid", "vals"), right.where(F.size("vals") > 0).select("cid", "vals")
    ids = _ids(left.unionByName(right))
    l, r = _entries(left, ids, p, q), _entries(right, ids, p, q)  # noqa: E741
    count = lambda e, n: e.groupBy("k1", "k2").agg(F.ceil(F.count("*") / part_rows).cast("int").alias(n))
    shared = count(l, "bl").join(count(r, "br"), ["k1", "k2"])
    block = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    l = l.join(shared, ["k1", "k2"]).withColumn("b", block("bl")).select("*", F.explode(F.sequence(F.lit(0), F.col("br") - 1)).alias("with"))  # noqa: E741
    r = r.join(shared, ["k1", "k2"]).withColumn("b", block("br")).select("*", F.explode(F.sequence(F.lit(0), F.col("bl") - 1)).alias("with"))
    l = l.select("k1", "k2", (F.col("b").cast("long") * F.col("br") + F.col("with")).alias("part"), F.lit(0).alias("block"), F.lit(True).alias("across"), "cid", "s")  # noqa: E741
    r = r.select("k1", "k2", (F.col("with").cast("long") * F.col("br") + F.col("b")).alias("part"), F.lit(1).alias("block"), F.lit(True).alias("across"), "cid", "s")
    return _joined(l.unionByName(r), p, q).select(F.col("a").alias("cid_a"), F.col("b").alias("cid_b"), "overlap")


def _classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    records = records.select("rec", "vals")
    classes = cut(records.groupBy("vals").agg(F.min("rec").alias("cid")), "classes")
    return classes, cut(records.join(classes, "vals").select("rec", "cid"), "members")


def similar_sets(records: DataFrame, p: int = 3, q: int = 4) -> tuple[DataFrame, DataFrame]:
    """(members(rec, cid), links(cid_a, cid_b, overlap)) of ``records`` (rec long, vals array<string>).

    Records with equal sets share the cid, the least of their keys. Ties, repeated rows and
    extra columns don't matter; an empty table gives two empty tables.
    """
    classes, members = _classes(records)
    return members, class_links(classes.select("cid", "vals"), p, q)


def similar_between(left: DataFrame, right: DataFrame, p: int = 3, q: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members of left, members of right, links(cid_a of left, cid_b of right, overlap)) of two tables (rec long, vals array<string>).

    The same key in both tables is two records. An empty table gives no links.
    """
    (a, of_a), (b, of_b) = _classes(left), _classes(right)
    return of_a, of_b, links_between(a, b, p, q)


def expand_between(of_a: DataFrame, of_b: DataFrame, links: DataFrame) -> DataFrame:
    """(rec_a of left, rec_b of right): the pairs behind the classes and links of two tables."""
    a = of_a.select(F.col("rec").alias("rec_a"), F.col("cid").alias("cid_a"))
    b = of_b.select(F.col("rec").alias("rec_b"), F.col("cid").alias("cid_b"))
    return links.join(a, "cid_a").join(b, "cid_b").select("rec_a", "rec_b")


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """(rec_a < rec_b): the pairs behind classes and links."""
    a = members.select(F.col("rec").alias("ra"), F.col("cid").alias("cid_a"))
    b = members.select(F.col("rec").alias("rb"), F.col("cid").alias("cid_b"))
    across = links.join(a, "cid_a").join(b, "cid_b").select("ra", "rb")
    within = a.join(b, (F.col("cid_a") == F.col("cid_b")) & (F.col("ra") < F.col("rb"))).select("ra", "rb")
    both = across.unionByName(within)
    return both.select(F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b"))


def found(spark: SparkSession, folder: str) -> DataFrame:
    wines = spark.read.parquet(f"{folder}/wine_index.parquet")
    records = value_sets(wines, "rec_id", ["styles", "grapes_principal", "grapes_accessory"], 6)
    return expand(*similar_sets(records, 3, 4))


def between(spark: SparkSession, folder: str) -> DataFrame:
    """Denominations against sub-denominations: (rec_a, rec_b) with sets of 6 values or more alike by 3/4."""
    wines = spark.read.parquet(f"{folder}/wine_index.parquet")
    columns = ["styles", "grapes_principal", "grapes_accessory"]
    whole, part = wines.where("is_sub_denomination = false"), wines.where("is_sub_denomination")
    return expand_between(*similar_between(value_sets(whole, "rec_id", columns, 6), value_sets(part, "rec_id", columns, 6), 3, 4))


FOUND_SQL = """
WITH v AS (
  SELECT DISTINCT rec_id, x FROM (
    SELECT rec_id, unnest(styles) x FROM wine_index UNION ALL
    SELECT rec_id, unnest(grapes_principal) FROM wine_index UNION ALL
    SELECT rec_id, unnest(grapes_accessory) FROM wine_index) WHERE x IS NOT NULL),
n AS (SELECT rec_id, count(*) c FROM v GROUP BY 1 HAVING count(*) >= 6),
o AS (SELECT a.rec_id ra, b.rec_id rb, count(*) c FROM v a JOIN v b ON a.x = b.x AND a.rec_id < b.rec_id GROUP BY 1, 2)
SELECT ra AS rec_a, rb AS rec_b FROM o JOIN n na ON na.rec_id = ra JOIN n nb ON nb.rec_id = rb
WHERE 4 * o.c >= 3 * (na.c + nb.c - o.c)
"""

BETWEEN_SQL = """
WITH w AS (SELECT DISTINCT rec_id, is_sub_denomination sub, styles, grapes_principal, grapes_accessory FROM wine_index),
v AS (
  SELECT DISTINCT rec_id, sub, x FROM (
    SELECT rec_id, sub, unnest(styles) x FROM w UNION ALL
    SELECT rec_id, sub, unnest(grapes_principal) FROM w UNION ALL
    SELECT rec_id, sub, unnest(grapes_accessory) FROM w) WHERE x IS NOT NULL),
n AS (SELECT rec_id, count(*) c FROM v GROUP BY 1 HAVING count(*) >= 6),
o AS (SELECT a.rec_id ra, b.rec_id rb, count(*) c FROM v a JOIN v b ON a.x = b.x AND NOT a.sub AND b.sub GROUP BY 1, 2)
SELECT ra AS rec_a, rb AS rec_b FROM o JOIN n na ON na.rec_id = ra JOIN n nb ON nb.rec_id = rb
WHERE 4 * o.c >= 3 * (na.c + nb.c - o.c)
"""

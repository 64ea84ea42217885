"""Mixing sources to target weights by hierarchical budgets.

Sources are the leaves of a tree of domains and languages, given or read off the documents
(the commonest kind of a source's tokens, and the language most of them have). The total budget flows down by
weight; a leaf takes at most its size times its allowed repeats, and what it can't take
goes to its siblings by their weights, then to the siblings of its language, then of its
domain. A leaf's budget is whole epochs of its documents and a token-prefix of one more
epoch in a seeded order. The prefix is found without sorting a source: tokens are summed
by ranges of the hash the order goes by, and only the range in which the budget ends is
looked at document by document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from treille.llm.language_mix import language_code
from treille.llm.tokens import token_sizes
from treille.plans.lineage import cut

RANGES = 1 << 16  # ranges of the hash; one holds 1/65536 of a source
SEED = 20_240_101

NOWHERE = ("", "")  # place of a source the tree doesn't name


def tree_of(sized: DataFrame, source: str, domain: str, language: str, least: float = 0.5) -> DataFrame:
    """(source, domain, language): the label most of a source's tokens have; null labels count as none.

    A source without a language of at least the part ``least`` is ``mul``, one without any label too.

    Ties go to the label first by code point. Sources without tokens are left out.
    """
    rows = sized.select(F.col(source).alias("source"), F.col(domain).alias("domain"), F.col(language).alias("language"), "tokens").where("source is not null and tokens > 0")
    rows = rows.groupBy("source", "domain", "language").agg(F.sum("tokens").alias("n"))

    def most(label: str, least: float) -> DataFrame:
        by = rows.groupBy("source", label).agg(F.sum("n").alias("n"))
        best = by.where(F.col(label).isNotNull()).groupBy("source").agg(F.max("n").alias("top"), F.min_by(label, F.struct(-F.col("n"), label)).alias(label))
        told = best.join(by.groupBy("source").agg(F.sum("n").alias("all")), "source", "right")
        return told.select("source", F.when(F.col("top") >= least * F.col("all"), F.col(label)).otherwise("mul").alias(label))

    return most("domain", 0.0).join(most("language", least), "source")


def share_out(amount: float, nodes: list[tuple[float, float]]) -> list[float]:
    """``amount`` over (weight, most) by weight, none above its most; what one can't take goes to the others."""
    got = [0.0] * len(nodes)
    open_ = [i for i, (w, m) in enumerate(nodes) if w > 0 and m > 0]
    while open_ and amount > 1e-9:
        weight = sum(nodes[i][0] for i in open_)
        full = [i for i in open_ if got[i] + amount * nodes[i][0] / weight >= nodes[i][1] - 1e-9]
        if not full:
            for i in open_:
                got[i] += amount * nodes[i][0] / weight
            return got
        # fill those that reach their most first, then share again
        for i in full:
            take = nodes[i][1] - got[i]
            got[i] += take
            amount -= take
            open_.remove(i)
    return got


def budgets(leaves: list[tuple[str, float, float]], total: float, where=lambda source: NOWHERE) -> dict[str, float]:
    """Budget by source from (source, weight, most): shortages go to siblings before ancestors' siblings.

    ``where`` gives (domain, language) of a source, or None for NOWHERE.
    """
    tree: dict[str, dict[str, list[tuple[str, float, float]]]] = {}
    for leaf in leaves:
        domain, lang = where(leaf[0]) or NOWHERE
        tree.setdefault(domain, {}).setdefault(lang, []).append(leaf)
    got = {leaf[0]: 0.0 for leaf in leaves}
    weight = sum(w for _, w, _ in leaves) or 1.0

    def free(group: list[tuple[str, float, float]]) -> list[tuple[float, float]]:
        return [(w, m - got[s]) for s, w, m in group]

    def give(amount: float, group: list[tuple[str, float, float]]) -> float:
        parts = share_out(amount, free(group))
        for (s, _, _), x in zip(group, parts):
            got[s] += x
        return amount - sum(parts)

    over_domains = 0.0
    for domain in sorted(tree):
        short = 0.0
        for lang in sorted(tree[domain]):
            group = tree[domain][lang]
            short += give(total * sum(w for _, w, _ in group) / weight, group)  # first among the leaves of a language
        over_domains += give(short, [x for lang in sorted(tree[domain]) for x in tree[domain][lang]])  # then within the domain
    give(over_domains, leaves)  # last anywhere
    return got


def mixture(sized: DataFrame, key: str, source: str, targets: list[tuple[str, float, int]], tree: DataFrame | None = None, total: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(chosen(key, source, tokens, repeats), shares) of documents (key, source, tokens).

    ``tree`` is a table (source, domain, language), see tree_of; a source it doesn't name,
    or every one without a tree, is a sibling of all such. ``total`` is the size of the mixture in tokens, by default as much as the listed
    sources hold. Documents without tokens, without source or of a source that isn't listed
    are not chosen. Shares has a row per target, also for sources without documents.
    """
    spark = sized.sparkSession
    wanted = {s: (w, r) for s, w, r in targets}
    docs = sized.select(F.col(key).alias("id"), F.col(source).alias("source"), "tokens").where((F.col("tokens") > 0) & F.col("source").isin(list(wanted)))
    order = F.xxhash64(F.lit(seed), F.col("id"))
    docs = docs.withColumns({"h": order, "range": F.shiftrightunsigned(order, 48).cast("int")})
    ranges = cut(docs.groupBy("source", "range").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "ranges")
    sizes = {r[0]: (r[1], r[2]) for r in ranges.groupBy("source").agg(F.sum("tokens"), F.sum("docs")).collect()}  # a row per target at most
    if total is None:
        total = sum(n for n, _ in sizes.values())
    placed: dict[str, tuple[str, str]] = {}
    if tree is not None:  # a row per target at most
        placed = {r[0]: (r[1], r[2]) for r in tree.where(F.col("source").isin(list(wanted))).groupBy("source").agg(F.min(F.struct("domain", "language")).alias("at")).select("source", "at.domain", "at.language").collect()}
    budget = budgets([(s, w, sizes.get(s, (0, 0))[0] * max(0, r)) for s, (w, r) in sorted(wanted.items())], total, placed.get)

    plan = []
    for s, (n, _) in sorted(sizes.items()):
        epochs = int(budget[s] // n) if n else 0
        rest = budget[s] - epochs * n
        if wanted[s][1] <= epochs:
            epochs, rest = wanted[s][1], 0.0
        plan.append((s, epochs, float(rest)))
    plan_df = spark.createDataFrame(plan, "source string, epochs int, rest double")
    # where the prefix ends: at most 65,536 rows a source
    w = Window.partitionBy("source").orderBy("range")
    upto = ranges.withColumn("before", F.sum("tokens").over(w) - F.col("tokens")).join(F.broadcast(plan_df), "source")
    last = upto.where("before < rest and before + tokens >= rest").select("source", F.col("range").alias("last"), "before")
    plan_df = plan_df.join(last, "source", "left").select("source", "epochs", "rest", "last", "before")

    docs = docs.join(F.broadcast(plan_df), "source")  # a row per target
    inner = docs.where(F.col("range") == F.col("last"))
    inside = inner.withColumn("sofar", F.col("before") + F.sum("tokens").over(Window.partitionBy("source").orderBy("h", "id")) - F.col("tokens"))
    # the document at the edge is taken if that comes nearer to the budget
    edge = inside.select("id", "source", "tokens", (F.col("epochs") + F.when(F.col("rest") - F.col("sofar") > F.col("tokens") / 2, 1).otherwise(0)).alias("repeats"))
    others = docs.where(F.col("last").isNull() | (F.col("range") != F.col("last")))
    others = others.select("id", "source", "tokens", (F.col("epochs") + F.when((F.col("rest") > 0) & (F.col("last").isNull() | (F.col("range") < F.col("last"))), 1).otherwise(0)).alias("repeats"))
    chosen = cut(others.unionByName(edge).where("repeats > 0"), "chosen")

    reached = {r[0]: (r[1], r[2]) for r in chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")), F.max("repeats")).collect()}
    all_ = sum(n for n, _ in reached.values()) or 1
    rows = [(*placed.get(s, NOWHERE), s, float(w), budget[s] / total if total else 0.0, reached.get(s, (0, 0))[0] / all_, sizes.get(s, (0, 0))[0], reached.get(s, (0, 0))[0], int(r), reached.get(s, (0, 0))[1]) for s, (w, r) in sorted(wanted.items())]
    shares = spark.createDataFrame(rows, "domain string, language string, source string, target_share double, budget_share double, reached_share double, available_tokens bigint, mixed_tokens bigint, max_repeats int, most_repeats int")
    return chosen.select(F.col("id").alias(key), "source", "tokens", "repeats"), shares


def targets_of(spark: SparkSession, folder: str, most: int = 10_000) -> list[tuple[str, float, int]]:
    rows = spark.read.parquet(f"{folder}/mix_target.parquet").select("source", "target_share", "max_repeats").dropna().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} targets")
    return [(r[0], r[1], r[2]) for r in rows]


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sized = cut(token_sizes(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text", "source", "kind", "lang"), "sizes")
    tree = tree_of(sized.withColumn("lang", language_code(F.col("lang"))), "source", "kind", "lang")
    return mixture(sized, "doc_id", "source", targets_of(spark, folder), tree)


def chosen(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder)[0]


def shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder)[1]

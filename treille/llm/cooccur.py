"""Items that appear together: a pair table kept up to date by signed deltas.

The state is a folder of tables: baskets by key, with the order value of the row each came
from, item counts, and pair counts under either item, each split into hash buckets. A
batch of changed baskets is compared with the stored ones of the buckets it touches; an
older row never replaces a newer one, whatever batch brings it. The baskets that really
changed emit +1 and -1 for their pairs and items, summed map-side before the shuffle. Only
the buckets a delta falls into are rewritten, as a new version that the manifest, a table
of its own, names: a state can be opened again from its folder, and a batch that fails
leaves the old one. As a pair stands under either item, the pairs whose score changes with
an item's count lie in that item's bucket: there ``confidence``, n(a,b)/n(a), is recomputed.
How much more often than chance, N n(a,b)/(n(a) n(b)), follows from it on reading.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.operators.dedup import latest_per_key
from treille.plans.lineage import cut, new_path

SCHEMAS = {
    "baskets": "key bigint, items array<string>, at array<string>, bucket int",
    "items": "item string, n bigint, bucket int",
    "pairs": "item string, other string, n bigint, confidence double, bucket int",
}
MANIFEST = "kind string, bucket int, version string, buckets int, n bigint"
BUCKET_ROWS = 4_000_000  # baskets of a bucket when a state is begun


def _orderable(c: Column, kind: str) -> Column:
    """A column as text that sorts alike; null first."""
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if kind in ("tinyint", "smallint", "int", "bigint"):
        number = c.cast("decimal(20,0)") + F.lit("9223372036854775808").cast("decimal(20,0)")
        return F.lpad(number.cast("decimal(20,0)").cast("string"), 20, "0")
    if kind == "string":
        return c
    raise ValueError(f"no order for columns of type {kind}")


def baskets_of(df: DataFrame, key: str, columns: list[str], order: list[str] | None = None) -> DataFrame:
    """(key, items, at): distinct non-null values of the array columns of the latest row of each key.

    ``at`` holds the order columns (times, whole numbers or text), by which rows of later
    batches are compared too; without any, the batch applied last wins. A null or empty
    basket stays, with no items: it deletes what was stored. Rows with a null key are left out.
    """
    empty = F.array().cast("array<string>")
    items = F.array_sort(F.array_distinct(F.array_compact(F.concat(*[F.coalesce(F.col(c).cast("array<string>"), empty) for c in columns]))))
    kinds = dict(df.dtypes)
    at = F.array(*[F.coalesce(_orderable(F.col(c), kinds[c]), F.lit("")) for c in order or []]).cast("array<string>")
    rows = df.select(F.col(key).alias("key"), items.alias("items"), at.alias("at")).where("key is not null")
    # ties of the order: the greater basket, so that a repeated run gives the same
    return latest_per_key(rows.withColumn("tie", F.col("items")), ["key"], ["at", "tie"]).select("key", "items", "at")


def pair_rows(df: DataFrame, *carried: str) -> DataFrame:
    """(item_a < item_b) for each two items of the ordered array ``items``, streamed row by row."""
    heads = df.select(*carried, "items", F.posexplode("items").alias("at", "item_a"))
    return heads.select(*carried, "item_a", F.explode(F.slice("items", F.col("at") + 2, F.greatest(F.size("items"), F.lit(1)))).alias("item_b"))


def both_ways(pairs: DataFrame, *carried: str) -> DataFrame:
    """Each pair under either of its items: (item, other, carried...)."""
    sides = F.array(F.struct(F.col("item_a").alias("item"), F.col("item_b").alias("other")), F.struct(F.col("item_b").alias("item"), F.col("item_a").alias("other")))
    return pairs.select(F.explode(sides).alias("p"), *carried).select("p.item", "p.other", *carried)


class PairTable:
    """Persistent counts of items and pairs in a shared folder; opening a folder that holds a state goes on with it."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "pair-table")
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.versions: dict[str, dict[int, str]] = {kind: {} for kind in SCHEMAS}
        self.n, self.state, self.buckets = 0, 0, buckets
        self._open()

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._hadoop(path))

    def _open(self) -> None:
        folder = f"{self.path}/manifest"
        if not self._exists(folder):
            return
        states = [int(s.getPath().getName()) for s in self._fs.listStatus(self._hadoop(folder)) if s.getPath().getName().isdigit()]
        whole = [k for k in states if self._exists(f"{folder}/{k}/_SUCCESS")]
        if not whole:
            return
        self.state = max(whole)
        for r in self.spark.read.schema(MANIFEST).parquet(f"{folder}/{self.state}").collect():  # a row per bucket
            self.n, self.buckets = r["n"], r["buckets"]
            if r["kind"]:
                self.versions[r["kind"]][r["bucket"]] = r["version"]

    def _commit(self, versions: dict[str, dict[int, str]], n: int) -> None:
        rows = [(kind, b, v, self.buckets, n) for kind, by in versions.items() for b, v in by.items()] or [("", 0, "", self.buckets, n)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{self.state + 1}")
        replaced = {(k, v) for k, by in self.versions.items() for v in by.values()} - {(k, v) for k, by in versions.items() for v in by.values()}
        gone, self._replaced = getattr(self, "_replaced", set()), replaced
        self.versions, self.n, self.state = versions, n, self.state + 1
        for kind, version in gone:  # replaced by the state before: its readers may still read what this one replaced
            self._fs.delete(self._hadoop(f"{self.path}/{kind}/{version}"), True)
        self._fs.delete(self._hadoop(f"{self.path}/manifest/{self.state - 2}"), True)

    def _read(self, kind: str, only: list[int] | None = None) -> DataFrame:
        files = [f"{self.path}/{kind}/{v}/bucket={b}" for b, v in self.versions[kind].items() if only is None or b in only]
        plain = SCHEMAS[kind].rpartition(",")[0]
        if not files:
            return self.spark.createDataFrame([], plain)
        return self.spark.read.schema(plain).parquet(*files)

    def _write(self, kind: str, df: DataFrame, touched: list[int], versions: dict[str, dict[int, str]]) -> None:
        """The touched buckets anew, each by one task."""
        version = uuid.uuid4().hex
        target = f"{self.path}/{kind}/{version}"
        df.repartition(max(1, len(touched)), "bucket").write.partitionBy("bucket").parquet(target)
        for b in touched:
            versions[kind].pop(b, None)
            if self._exists(f"{target}/bucket={b}"):
                versions[kind][b] = version

    def _bucket(self, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    @staticmethod
    def _touched(df: DataFrame) -> list[int]:
        return sorted(r[0] for r in df.select("bucket").distinct().collect())  # at most one per bucket

    def apply(self, changes: DataFrame) -> None:
        """Merge changed baskets (key, items, at); an empty or null basket removes the key. One row per key.

        A row whose ``at`` is less than that of the stored basket changes nothing.
        """
        none = F.array().cast("array<string>")
        at = F.coalesce("at", none) if "at" in changes.columns else none
        changes = changes.select("key", F.coalesce("items", none).alias("items"), at.alias("at"))
        if self.buckets is None:
            changes = cut(changes, "changes")
            self.buckets = max(32, -(-changes.count() // BUCKET_ROWS))
        changes = changes.withColumn("bucket", self._bucket("key"))
        if self.versions["baskets"]:
            changes = cut(changes, "changes")
            stored = self._read("baskets", self._touched(changes)).select("key", F.col("items").alias("old"), F.col("at").alias("old_at"))
            merged = changes.join(stored, "key", "left").where("old_at is null or at >= old_at")
        else:
            merged = changes.withColumns({"old": F.lit(None).cast("array<string>"), "old_at": F.lit(None).cast("array<string>")})
        merged = merged.where("old_at is null or old <> items or at <> old_at").withColumn("old", F.coalesce("old", none))
        changed = cut(merged, "changed")
        versions = {kind: dict(by) for kind, by in self.versions.items()}
        n = self.n + (changed.agg(F.sum(F.when(F.size("items") > 0, 1).otherwise(0) - F.when(F.size("old") > 0, 1).otherwise(0))).first()[0] or 0)

        touched = self._touched(changed)
        if not touched:
            return
        # an emptied basket stays with its order: an older row that comes later must not revive it
        kept = self._read("baskets", touched).join(changed.select("key"), "key", "left_anti").withColumn("bucket", self._bucket("key"))
        self._write("baskets", kept.unionByName(changed.select("key", "items", "at", "bucket")), touched, versions)

        differ = changed.where("old <> items")
        signed = differ.select(F.explode(F.array(F.struct("items", F.lit(1).alias("sign")), F.struct(F.col("old").alias("items"), F.lit(-1).alias("sign")))).alias("s")).select("s.items", "s.sign").where(F.size("items") > 0)
        d_items = signed.select("sign", F.explode("items").alias("item")).groupBy("item").agg(F.sum("sign").alias("d")).where("d <> 0")
        d_items = cut(d_items.withColumn("bucket", self._bucket("item")), "item-deltas")
        d_pairs = both_ways(pair_rows(signed, "sign").groupBy("item_a", "item_b").agg(F.sum("sign").alias("d")).where("d <> 0"), "d")
        d_pairs = cut(d_pairs.withColumn("bucket", self._bucket("item")), "pair-deltas")

        before = self._read("items").select("item", F.col("n").alias("d")).withColumn("bucket", self._bucket("item"))
        total = cut(before.unionByName(d_items.select("item", "d", "bucket")).groupBy("bucket", "item").agg(F.sum("d").alias("n")).where("n <> 0"), "items")
        touched = self._touched(d_items)
        if touched:
            self._write("items", total.where(F.col("bucket").isin(touched)), touched, versions)

        # the pairs of an item lie in its bucket: those with a delta and those whose item's count changed
        touched = sorted({*touched, *self._touched(d_pairs)})
        if touched:
            stored = self._read("pairs", touched).select("item", "other", "n").withColumn("bucket", self._bucket("item"))
            counts = stored.unionByName(d_pairs.select("item", "other", F.col("d").alias("n"), "bucket"))
            counts = counts.groupBy("bucket", "item", "other").agg(F.sum("n").alias("n")).where("n <> 0")
            scored = counts.join(total.select("item", F.col("n").alias("of")), "item")
            self._write("pairs", scored.select("item", "other", "n", (F.col("n") / F.col("of")).alias("confidence"), "bucket"), touched, versions)
        self._commit(versions, n)

    def items(self) -> DataFrame:
        return self._read("items")

    def _canonical(self) -> DataFrame:
        return self._read("pairs").where("item < other").select(F.col("item").alias("item_a"), F.col("other").alias("item_b"), "n", "confidence")

    def pairs(self) -> DataFrame:
        """(item_a, item_b, n, lift): lift is how many times more often than chance."""
        nb = self.items().select(F.col("item").alias("item_b"), F.col("n").alias("nb"))
        return self._canonical().join(nb, "item_b").select("item_a", "item_b", "n", (F.col("confidence") * F.lit(self.n) / F.col("nb")).alias("lift"))

    def associated(self, least: int, per_thousand: int, times: int) -> DataFrame:
        """Pairs with n >= least, 1000 n >= per_thousand N and n(a,b) N >= times n(a) n(b), compared in whole numbers."""
        frequent = self._canonical().where((F.col("n") >= least) & (F.col("n") * 1000 >= per_thousand * self.n))
        items = self.items()
        a, b = items.select(F.col("item").alias("item_a"), F.col("n").alias("na")), items.select(F.col("item").alias("item_b"), F.col("n").alias("nb"))
        joined = frequent.join(a, "item_a").join(b, "item_b")
        return joined.where(F.col("n").cast("decimal(19,0)") * F.lit(self.n).cast("decimal(18,0)") >= F.col("na").cast("decimal(17,0)") * F.col("nb").cast("decimal(17,0)") * F.lit(times)).select("item_a", "item_b", "n")


def found(spark: SparkSession, folder: str) -> DataFrame:
    wines = spark.read.parquet(f"{folder}/wine_index.parquet").select("rec_id", "grapes_principal", "grapes_accessory", "extracted_at", "loaded_at")
    on_time = F.coalesce(F.col("loaded_at") < F.col("extracted_at") + F.expr("interval 1 day"), F.lit(False))
    table = PairTable(spark)
    for batch in (wines.where(on_time), wines.where(~on_time)):  # what came with the load, then late and redelivered rows
        table.apply(baskets_of(batch, "rec_id", ["grapes_principal", "grapes_accessory"], ["loaded_at"]))
    return table.associated(5, 1, 3).select("item_a", "item_b")


FOUND_SQL = """
WITH v AS (
  SELECT DISTINCT rec_id, x FROM (
    SELECT rec_id, unnest(grapes_principal) x FROM wine_index UNION ALL
    SELECT rec_id, unnest(grapes_accessory) FROM wine_index) WHERE x IS NOT NULL),
t AS (SELECT count(DISTINCT rec_id) n FROM v),
m AS (SELECT x, count(*) c FROM v GROUP BY 1),
p AS (SELECT a.x xa, b.x xb, count(*) c FROM v a JOIN v b ON a.rec_id = b.rec_id AND a.x < b.x GROUP BY 1, 2)
SELECT xa AS item_a, xb AS item_b FROM p, t, m ma, m mb
WHERE ma.x = xa AND mb.x = xb AND p.c >= 5 AND 1000 * p.c >= t.n AND p.c * t.n >= 3 * ma.c * mb.c
"""

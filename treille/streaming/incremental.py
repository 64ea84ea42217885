"""Incremental jobs as streams: upserts by batch and windowed counts with late data."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treille.operators.dedup import latest_per_key

LEDGER = "bucket int, version string"


class Buckets:
    """A table by hash buckets of its keys under a folder, with a ledger that names the version of each bucket."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(target).getFileSystem(spark._jsc.hadoopConfiguration())

    def last(self, before: int | None = None) -> tuple[int, dict[int, str]]:
        """(batch, version by bucket) of the last whole ledger, of those before batch ``before``; -1 for none."""
        folder = self._path(f"{self.target}/ledger")
        if not self._fs.exists(folder):
            return -1, {}
        batches = [int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit()]
        whole = [n for n in batches if (before is None or n < before) and self._fs.exists(self._path(f"{self.target}/ledger/{n}/_SUCCESS"))]
        if not whole:
            return -1, {}
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.target}/ledger/{max(whole)}").collect()  # a row per bucket
        return max(whole), {r["bucket"]: r["version"] for r in rows}

    def read(self, versions: dict[int, str], schema, only: list[int] | None = None) -> DataFrame:
        files = [f"{self.target}/data/{v}/_bucket={b}" for b, v in versions.items() if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    def commit(self, batch: int, old: dict[int, str], new: dict[int, str]) -> None:
        self.spark.createDataFrame(sorted(new.items()), LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{self.target}/ledger/{batch}")
        for ledger in [s.getPath() for s in self._fs.listStatus(self._path(f"{self.target}/ledger"))]:
            if ledger.getName().isdigit() and int(ledger.getName()) < batch - 1:  # a reader may still use the one before
                self._fs.delete(ledger, True)
        kept = set(new.values()) | set(old.values())
        folder = self._path(f"{self.target}/data")
        for version in [s.getPath() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []:
            if version.getName() not in kept:
                self._fs.delete(version, True)


def upsert_stream(spark: SparkSession, folder: str, schema, target: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 64) -> None:
    """Files of ``folder`` merged into the table at ``target``, latest row per key.

    A batch reads and writes only the hash buckets its keys fall into, and then writes a
    ledger of its own number; a batch repeated after a failure starts from the ledger before
    it, so it changes nothing twice. Versions that no ledger in use names are removed. Reads
    what is there and stops; call again for more. ``buckets`` must stay the same for a target.
    """
    table = Buckets(spark, target)

    def merge(batch: DataFrame, number: int) -> None:
        names = batch.columns
        rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())  # at most one per bucket
        _, old = table.last(before=number)
        new = dict(old)
        if touched:
            stored = table.read(old, batch.schema, touched).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
            version = uuid.uuid4().hex
            latest = latest_per_key(rows.unionByName(stored), ["_bucket", *keys], order).select(*names, "_bucket")
            latest.repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(f"{target}/data/{version}")
            new |= {b: version for b in touched}
        table.commit(number, old, new)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest_version(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table as the last whole batch left it."""
    table = Buckets(spark, target)
    return table.read(table.last()[1], schema)


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by tumbling window and ``by``; rows later than ``late`` behind the newest are dropped by the watermark of a stream."""
    rows = stream.withWatermark(time, late) if stream.isStreaming else stream
    return rows.groupBy(F.window(time, width), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")

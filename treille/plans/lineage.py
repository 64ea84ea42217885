"""Cutting lineage with tables in the folder all executors share, and sizing partitions."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SPLIT = 64 << 20  # bytes of a split that gives a core work enough


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only on one machine, where the session names none, a folder of our own.

    On a cluster a folder of one machine would hold only a part of each table, so a missing
    setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a folder all executors share (master {master})")
        folder = "file://" + tempfile.mkdtemp(prefix="treille-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(shutil.rmtree, folder.removeprefix("file://"), True)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written once as a table and read back: it survives lost executors and is computed a single time."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bytes_of(df: DataFrame) -> int:
    """The planner's estimate of the size of ``df``: exact for scans of files, too high rather than too low behind joins."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, size: int | None = None) -> DataFrame:
    """``df`` over enough partitions for every core, for steps whose work is in Python and not in bytes.

    Only a table too small to occupy the cores by its own splits is shuffled. A larger one
    stays as its scan cuts it or as adaptive execution sizes it: a shuffle of all its bytes
    would bring nothing. ``size`` stands for the planner's estimate where the caller knows better.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if (bytes_of(df) if size is None else size) > 2 * cores * SPLIT:
        return df
    return df.repartition(max(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))

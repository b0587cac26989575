"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local master may go without, and then gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tessitura-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as Parquet in a folder, read again: lineage ends there, and what it computed is computed once."""
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> DataFrame:
    return written(df, shared_folder(df.sparkSession), name)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, object]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, n in wanted.items():
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def rows_a_batch(spark: SparkSession, rows: int, stored: int, most_bytes: int | None = None):
    """For rows of megabytes: inside, Python functions get at most ``rows`` rows at a time, or ``most_bytes`` and the
    row that passes it, a scan of Parquet reads ``stored``, and an aggregate that gathers lists holds ``rows`` groups
    before it sorts, instead of 128."""
    batch = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} if most_bytes is None else {"spark.sql.execution.arrow.maxRecordsPerBatch": 10_000, "spark.sql.execution.arrow.maxBytesPerBatch": most_bytes}
    return settings(spark, batch | {"spark.sql.parquet.columnarReaderBatchSize": min(stored, 4096), "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": min(rows, 128)})


def no_guessed_broadcast(spark: SparkSession):
    """Inside, Spark broadcasts only what is said to be small. Files of a job's tables may be tiny, as their columns repeat, where
    their rows are millions, and a table's share of its file is what Spark goes by."""
    return settings(spark, {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": -1})


def tasks(spark: SparkSession) -> int:
    """How many tasks a step with costly rows is dealt to: as many as shuffle partitions, three for each core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to ``tasks`` by ``keys``. Without the number, Spark joins partitions of few bytes, and what thousands of short
    rows cost in Python, or silent sound in memory, would be one task."""
    return df.repartition(tasks(df.sparkSession), *keys)


def no_lone_task(spark: SparkSession):
    """Inside, partitions of joins and aggregates are joined by Spark only as far as ``tasks`` of them stay, or 16 KB in each."""
    name = "spark.sql.adaptive.coalescePartitions"
    return settings(spark, {f"{name}.minPartitionNum": tasks(spark), f"{name}.minPartitionSize": "16k"})

"""One long row spreads over tasks; what is made of it is whole."""

import numpy as np
from pyspark.sql import functions as F

from tessitura import storage
from tessitura.operators import clustering, frames, intervals, samples
from tessitura.plans import run


def spread(df):
    return df.select(F.spark_partition_id()).distinct().count()


def test_window_grid(spark):
    n = 160_000 + 120_000 * 299_999
    made = frames.window_grid(spark.createDataFrame([(1, n), (2, 7), (3, 0)], "recording_id long, n_samples long").coalesce(1), shift=120_000)
    assert spread(made) > 3  # runs of 65,536 windows
    got = {r["recording_id"]: r[1:] for r in made.groupBy("recording_id").agg(F.count("window_idx"), F.countDistinct("window_idx"), F.max("window_idx"), F.sum("pad")).collect()}
    assert got == {1: (300_000, 300_000, 299_999, 0), 2: (1, 1, 0, 159_993)}


def test_fixed_chunks(spark):
    made = intervals.fixed_chunks(spark.createDataFrame([(1, 10 * 300_000 - 3), (2, 4), (3, 0)], "recording_id long, n_samples long").coalesce(1), chunk_samples=10)
    assert spread(made) > 3
    got = {r["recording_id"]: r[1:] for r in made.groupBy("recording_id").agg(F.count("chunk_idx"), F.countDistinct("chunk_idx"), F.max("first_sample"), F.sum("n_samples")).collect()}
    assert got == {1: (300_000, 300_000, 2_999_990, 2_999_997), 2: (1, 1, 0, 4)}


def test_short_rows_of_a_job_spread(spark):
    """Few bytes and much work in each: Spark's own joining of small partitions made one task of them."""
    roles = run.Roles(detect=None, fetch=lambda url: b"", decode=lambda content: np.zeros(5, np.float32), block_samples=4)
    loaded = run.load(spark.range(200).select(F.col("id").cast("string").alias("key"), F.array(F.lit("u")).alias("audio_urls")), roles)
    assert spread(loaded) > 3 and loaded.count() == 600
    pieces = spark.range(400).select((F.col("id") % 200).alias("key"), F.col("id").alias("at"), F.array(F.col("id").cast("float")).alias("samples"))
    made = samples.joined(pieces, ["key"])
    assert spread(made) > 3 and {r["key"]: list(r["samples"]) for r in made.collect()} == {k: [k, k + 200] for k in range(200)}
    vectors = spark.range(600).select((F.col("id") % 200).alias("recording_id"), F.col("id").alias("seq"), F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    found = clustering.cluster(vectors)
    assert spread(found) > 3 and found.where("cluster = 0").count() == 600


def test_joins_of_a_job_spread(spark):
    ids = spark.range(3000).select(F.col("id").alias("key"), F.lit("x").alias("y"))
    with storage.no_lone_task(spark):
        joined = ids.join(ids.select("key").hint("merge"), "key")
        assert spread(joined) > 1 and joined.count() == 3000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.minPartitionNum", None) is None


def test_recordings_share_batches(spark):
    """Recordings that end within batches, go on over several, have other lengths of vectors, other options, or no id."""
    rng = np.random.default_rng(5)
    rows = [(k, i, x.tolist(), k and 0.1 * (ord(k) % 7), 2 if k == "b" else None) for k, n, d in (("a", 30, 3), ("b", 5, 4), (None, 12, 2), ("c", 1, 3), ("d", 25, 3), ("e", 7, 5)) for i, x in enumerate(rng.normal(size=(n, d)))]
    rows = [(k, i, (np.array(x) / np.linalg.norm(x)).tolist(), 0.4 if least is None else least, number) for k, i, x, least, number in rows]
    want = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        labels = clustering.agglomerate(np.array([r[2] for r in mine]), mine[0][3], mine[0][4] or -1)
        want |= {(key, r[1]): int(c) for r, c in zip(mine, labels, strict=True)}
    df = spark.createDataFrame(rows[::-1], "recording_id string, seq long, embedding array<double>, least double, number int")
    with storage.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 8}):
        got = clustering.cluster(df, min_similarity="least", num_clusters="number").collect()
    assert {(r["recording_id"], r["seq"]): r["cluster"] for r in got} == want


def test_windows_are_stored_small(spark, tmp_path):
    """Tasks go through the same few window numbers again and again: under a byte a window on disk, in any number of recordings."""
    rows = spark.range(1, 401).select(F.col("id").alias("recording_id"), (F.col("id") * 3_000_000).alias("n_samples"))
    frames.window_grid(rows, shift=120_000).write.parquet(str(tmp_path / "grid"))
    made = spark.read.parquet(str(tmp_path / "grid"))
    assert made.count() == sum(1 + max(0, -(-(3_000_000 * k - 160_000) // 120_000)) for k in range(1, 401)) and made.distinct().count() == made.count()
    assert sum(f.stat().st_size for f in (tmp_path / "grid").glob("*.parquet")) < made.count()

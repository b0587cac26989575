"""Shared pieces: tables in the shared folder, Arrow mapping, hashing of words, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a local master may go without one; then a temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tessitura-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """``mapInArrow``: the one place where Python functions meet the plan."""
    return df.mapInArrow(function, schema)


# --- words as bytes -----------------------------------------------------------

#: Odd multipliers of the rolling hashes, invertible modulo 2**64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer of 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the 0th, 1st, ... (n-1)th, modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Polynomial hashes of slices of a sequence of 64-bit values, all by prefix sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        n = len(values) + 1
        if len(self.up) < n:
            self.up, self.down = powers(self.base, 2 * n), powers(self.inverse, 2 * n)
        out = np.zeros(n, np.uint64)
        np.cumsum(values * self.up[: n - 1], dtype=np.uint64, out=out[1:])
        return out

    def slices(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def texts_of(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """A column's texts, of which a few are Python objects at a time."""
    for a in range(0, len(column), rows):
        yield from column.slice(a, rows).to_pylist()


def chunks(texts: Iterable[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts as UTF-8 (null: empty), about ``limit`` bytes at a time: (first index, texts)."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        part.append(raw)
        size += len(raw)
        if size >= limit:
            yield first, part
            first, part, size = i + 1, [], 0
    if part:
        yield first, part


def find_words(part: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes: (all bytes, starts, ends, number of words of each text)."""
    data = np.frombuffer(b"\n".join([*part, b""]), np.uint8)
    inside = np.concatenate(([False], is_word[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    stops = np.cumsum([len(x) + 1 for x in part])
    per_text = np.diff(np.searchsorted(starts, stops), prepend=0)
    return data, starts, ends, per_text


# --- connected components -----------------------------------------------------


class Forest:
    """Union-find over integers; keeps the links that joined two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        path, parent = [], self.parent
        while (up := parent.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            parent[p] = x
        return x

    def join(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((max(a, b), min(a, b)))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)`` by alternating large and small stars.

    Returns (node, root) for every node that has an edge, root included; root is the
    smallest node of the component. Self-links and nulls are ignored. Each round is an
    aggregate that combines before its shuffle and a join of edges to a table of one row a
    node, so that Spark can split the edges of a large star; each round's edges are a
    table in the shared folder, so a lost executor costs one round at most.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialize(pairs, "edges")
    seen = None
    for _ in range(most_rounds):
        digest = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if digest == seen or not digest["n"]:
            break
        seen = digest
        both = now.select(F.col("v").alias("node"), "v").union(now.select(F.col("u").alias("node"), "v"))
        least = materialize(both.groupBy("node").agg(F.min("v").alias("m")), "least")
        large = now.join(least, now["v"] == least["node"]).select("u", F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "node")
        small = (
            large.join(lowest, large["u"] == lowest["node"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select(F.col("node").alias("u"), F.col("m").alias("v")))
        )
        now = materialize(small.distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

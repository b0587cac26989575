"""SimHash near-duplicates: BK-trees over shards of fingerprints that must hold every pair.

A fingerprint's bit is 1 if over half of the document's shingle hashes have it. Two
fingerprints within ``radius`` bits agree wholly on all but ``radius`` of ``blocks``
blocks of bits; so each distinct fingerprint goes to a shard for every choice of
``blocks - radius`` blocks, and every pair within the radius meets in some shard. A shard
is one BK-tree (children keyed by their Hamming distance to the parent; a search follows
only edges within the radius). Shards over ``most`` members are split further by the same
rule over the bits that their key leaves open, so that no tree outgrows a task.

Defined cases: null and empty texts have no words and fingerprint zero, linked like any
other; texts under ``words`` words are one shingle; repeated rows and exact copies share a
fingerprint; a null id takes part, yet never names a component (a component of null ids
only is named null); an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Forest, components, map_rows, materialize, texts_of


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> list[int]:
    """XXH64 of each shingle of the lower-cased (A-Z) text, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    whole = b" ".join(found)
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(whole, seed)]
    stop = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    start = np.concatenate(([0], stop[: len(found) - words])).tolist()
    return [digest(whole[a:b], seed) for a, b in zip(start, (stop[words - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the lower-cased (A-Z) text's shingles, repeats included."""
    hashes = shingle_hashes(text, words, seed)
    if not hashes:
        return 0
    values, ones = np.array(hashes, "<u8"), np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 15):
        bits = np.unpackbits(values[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(ones * 2 > len(values)).tolist())


def fingerprints(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every document as a signed 64-bit number."""
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, words) for t in texts_of(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    return map_rows(documents.select(id_col, text_col), run, schema)


class BKTree:
    """Fingerprints by Hamming distance to their parent."""

    def __init__(self, root: int):
        self.root, self.children = root, {}

    def near_and_add(self, x: int, radius: int) -> list[int]:
        """Members within ``radius`` of ``x``, which then joins the tree."""
        found, stack, children = [], [self.root], self.children
        while stack:
            node = stack.pop()
            d = (node ^ x).bit_count()
            if d <= radius:
                found.append(node)
            if below := children.get(node):
                stack.extend(c for e, c in below.items() if d - radius <= e <= d + radius)
        node = self.root
        while (d := (node ^ x).bit_count()) and (step := children.setdefault(node, {}).get(d)) is not None:
            node = step
        if d:
            children[node][d] = x
        return found


def shard_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Links enough to join what is within the radius, at most one fewer than the members."""
    forest = Forest()
    tree = BKTree(fps[0])
    for x in fps[1:]:
        for near in tree.near_and_add(x, radius):
            forest.join(x, near)
    return forest.links


def masks(bits: list[int], blocks: int, radius: int) -> list[int]:
    """Of each choice of ``blocks - radius`` blocks of the given bits: the mask of its bits."""
    cuts = [bits[len(bits) * i // blocks : len(bits) * (i + 1) // blocks] for i in range(blocks)]
    return [sum(1 << b for cut in chosen for b in cut) for chosen in combinations(cuts, blocks - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pairs_within(distinct: DataFrame, *, radius: int = 2, blocks: int = 4, most: int = 20_000, splits: int = 3) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that join all within the radius."""
    level = distinct.select("fp", F.explode(F.array(*(F.struct(F.lit(signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for m in masks(list(range(64)), blocks, radius)))).alias("k")).select("fp", "k.mask", "k.key")
    schema, links = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())]), None

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(members: list[int]) -> list[tuple[int, int]]:
            return shard_links(members, radius) if len(members) > 1 else []

        now, members, out = None, [], []
        for batch in batches:
            fp, mask, key = (batch.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            cuts = [0, *(np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1).tolist(), len(fp)]
            values = fp.view(np.uint64).tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                if (mask[a], key[a]) != now:
                    out += ended(members)
                    now, members = (mask[a], key[a]), []
                members += values[a:b]
            if out:
                flat = np.array(out, np.uint64).view(np.int64)
                out = []
                yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["u", "v"])
        if out := ended(members):
            flat = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["u", "v"])

    for step in range(splits + 1):
        size = level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = level.join(size, ["mask", "key"])
        heavy = sized.where(F.col("n") > most)
        light = sized if step == splits else sized.where(F.col("n") <= most)
        part = map_rows(light.select("fp", "mask", "key").repartition("mask", "key").sortWithinPartitions("mask", "key", "fp"), trees, schema)
        links = part if links is None else links.union(part)
        if step == splits:
            break
        groups = heavy.select("mask").distinct().collect()  # at most as many as there are choices of blocks
        if not groups:
            break
        options = []
        for (m,) in groups:
            free = [b for b in range(64) if not (m >> b) & 1]
            if len(free) > radius:
                options += [(m, signed((m % (1 << 64)) | more)) for more in masks(free, radius + 1, radius)]
        table = distinct.sparkSession.createDataFrame(options, "mask long, deeper long")
        level = heavy.join(F.broadcast(table), "mask").select("fp", F.col("deeper").alias("mask"), F.col("fp").bitwiseAND(F.col("deeper")).alias("key"))
    return links


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2, blocks: int = 4, most: int = 20_000) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every document.

    Documents first collapse to distinct fingerprints, named by their smallest id, by an
    aggregate that combines before the shuffle: exact copies never form pairs. The rows
    and the links found are tables in the shared folder.
    """
    rows = materialize(fingerprints(documents, id_col=id_col, text_col=text_col, words=words), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct")
    tree = components(pairs_within(distinct, radius=radius, blocks=blocks, most=most))
    root = tree.groupBy("node").agg(F.min("root").alias("root"))
    named = distinct.join(root, distinct["fp"] == root["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    # tables as plain sides, so that Spark can split the joins at a large group
    least = materialize(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    by_fp = materialize(named.join(least, "root").select(F.col("fp").alias("of"), "component_id"), "named")
    return rows.join(by_fp, rows["fp"] == by_fp["of"]).select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, whose id names their component: one of each group.

    An id is a document's identity: rows that repeat an id stay or go together. Null ids stay.
    """
    found = near_duplicates(documents, id_col=id_col, text_col=text_col, **options)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    return documents.join(gone, documents[id_col] == gone["__gone"], "left_anti")

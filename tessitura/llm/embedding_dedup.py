"""Embedding near-duplicates: int8 tile products with error bounds, exact where it matters.

Equal vectors first collapse to one with a count. The rest are dealt into blocks of at most
about ``rows`` vectors and quantised once: a unit vector u is u = s*q + r with q of int8,
scale s and residual length e = |r|; the residual is quantised likewise, u = s*q + s2*q2 + r2,
e2 = |r2|. Blocks are a table in the shared folder, 2 bytes a component, and only those bytes
travel: a vector to each of N / ``rows`` tiles. A tile is a pair of blocks, one group of a task, which holds no more
than two blocks and a strip of products.

For two vectors |u.v - s*t*(q.p)| <= e + f + e*f, so a product of integers decides most
pairs: those whose upper bound is below the threshold do not link, those whose lower bound
is not link. The others are decided by both parts and the bound of the second residuals; what even that
leaves open, about one pair in ten thousand of those, is computed in double precision from the
vectors themselves. A tile returns numbers of links and links enough to join its components,
never all pairs.

Every vector meets every other, so the work grows with the square of the number of
different vectors, as an exact comparison of all rows must.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null id, link with nothing; vectors of different lengths do not link; rows
that share an id and a vector count as copies of each other, rows that share an id but not
the vector are one node of the components; an empty table gives no rows. Other columns are
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, map_rows, materialize

#: Products of int8 values are exact in float32 up to this many dimensions.
EXACT_DIMENSIONS = (1 << 24) // (127 * 127)
#: What rounding in double precision may add to a bound.
SLACK = 1e-9


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, int8 values of what they leave, scale, residual, second scale and residual) of unit vectors."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    unit = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    parts, numbers, rest = [], [], unit
    for _ in range(2):
        scale = np.maximum(np.abs(rest).max(axis=1), 1e-300) / 127
        whole = np.rint(rest / scale[:, None])
        rest = rest - whole * scale[:, None]
        parts.append(whole.astype(np.int8))
        numbers += [scale, np.sqrt((rest * rest).sum(axis=1)) + SLACK]
    return parts[0], parts[1], np.stack(numbers, axis=1)


class Block:
    """Quantised unit vectors."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, first: np.ndarray, second: np.ndarray, numbers: np.ndarray):
        self.ids, self.copies, self.whole, self.second = ids, copies, first, second
        self.scale, self.error, self.scale2, self.error2 = numbers.T
        self.kind = np.float32 if first.shape[1] <= EXACT_DIMENSIONS else np.float64

    def fine(self, at: np.ndarray) -> np.ndarray:
        """Some vectors from both their parts."""
        return self.whole[at] * self.scale[at, None] + self.second[at] * self.scale2[at, None]


def settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Labels after links i-j, each component by its smallest, in place."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (up := label[label]).tobytes() != label.tobytes():
            label[:] = up


def tile(a: Block, b: Block, threshold: float, entries: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links of a's vectors, links of b's, labels of both, and pairs i, j in doubt) of a tile; ``a is b`` on the diagonal."""
    same = a is b
    na, nb = len(a.ids), len(b.ids)
    links_a, links_b = np.zeros(na), np.zeros(nb)
    label = np.arange(na if same else na + nb)
    right = b.whole.astype(b.kind).T
    strip = max(1, entries // nb)
    doubt: list[np.ndarray] = []
    most = a.error.max()
    # product * scale of a >= least: what the upper bound lets link, with the strip's largest error and room for rounding
    least = ((threshold - most - b.error * (1 + most) - 1e-6) / b.scale).astype(b.kind)
    for x in range(0, na, strip):
        rows = slice(x, min(na, x + strip))
        product = a.whole[rows].astype(a.kind) @ right
        i, j = np.nonzero(product * a.scale[rows, None].astype(a.kind) >= least)
        if same:
            i, j = i[(keep := j > i + x)], j[keep]
        for y in range(0, len(i), 1 << 16):
            k, m = i[y : y + (1 << 16)], j[y : y + (1 << 16)]
            g = k + x
            value, bound = product[k, m].astype(np.float64) * a.scale[g] * b.scale[m], a.error[g] + b.error[m] + a.error[g] * b.error[m]
            sure, open_ = value - bound >= threshold, np.flatnonzero((value - bound < threshold) & (value + bound >= threshold))
            gg, mm = g[open_], m[open_]
            value, bound = np.einsum("nd,nd->n", a.fine(gg), b.fine(mm)), a.error2[gg] + b.error2[mm] + a.error2[gg] * b.error2[mm]
            sure[open_] = value - bound >= threshold
            left = (value - bound < threshold) & (value + bound >= threshold)
            doubt.append(np.stack([gg[left], mm[left]]))
            g, m = g[sure], m[sure]
            links_a += np.bincount(g, weights=b.copies[m], minlength=na)
            links_b += np.bincount(m, weights=a.copies[g], minlength=nb)
            settle(label, g, m if same else m + na)
    pairs = np.concatenate([np.zeros((2, 0), np.int64), *doubt], axis=1)
    return links_a, links_b, label, pairs[0], pairs[1]


def near_duplicates(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, rows: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) of every vector.

    ``rows`` is a block's size: by default a sixteenth of the vectors, 512 at least and 65,536 at
    most. It decides how work is dealt and not the result.
    """
    x = F.col("x")
    fine = F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    source = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    distinct = materialize(source.where(fine).groupBy("x").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")), "vectors")
    number = distinct.count()
    blocks = max(1, -(-number // (rows or min(65_536, max(512, number // 16)))))
    # distinct vectors may share an id, so a vector has a key of its own
    node = source.schema["id"].dataType
    keyed = distinct.select(F.xxhash64("x").alias("key"), "node", "copies", "x", F.size("x").alias("d"), F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int").alias("block"))
    packed_schema = T.StructType([*T._parse_datatype_string("d int, block int").fields, T.StructField("nodes", T.ArrayType(node)), *T._parse_datatype_string("keys array<bigint>, copies array<bigint>, first binary, second binary, numbers binary").fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each run of vectors of one block in a batch."""
        for batch in batches:
            d, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((d[1:] != d[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), len(d)] if len(d) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                some = batch.slice(a, b - a)
                first, second, numbers = quantised(some.column(5).flatten().to_numpy().reshape(b - a, d[a]))
                one = lambda k: pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), some.column(k))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays([pa.array(d[a : a + 1]), pa.array(block[a : a + 1]), one(2), one(3), one(4), *(pa.array([v.tobytes()], pa.binary()) for v in (first, second, numbers))], names=packed_schema.names)

    ordered = keyed.select("d", "block", "node", "key", "copies", "x").repartition(min(blocks, 20_000), "d", "block").sortWithinPartitions("d", "block")
    packed = materialize(map_rows(ordered, pack, packed_schema), "blocks")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    dealt = packed.select("*", other).select("d", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "nodes", "keys", "copies", "first", "second", "numbers")
    schema = T.StructType([T.StructField("u", node), T.StructField("v", node), *T._parse_datatype_string("links long, key_u long, key_v long").fields])

    def out_rows(nodes: pa.Array, keys: np.ndarray, a: Block, b: Block) -> pa.RecordBatch:
        """Numbers of links (by key), links that join components (by node), pairs in doubt (by key)."""
        links_a, links_b, label, i, j = tile(a, b, threshold)
        links = links_a + links_b if a is b else np.concatenate([links_a, links_b])
        j = j if a is b else j + len(a.ids)
        linked, joined = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
        left, right = np.concatenate([linked, joined, i]), np.concatenate([linked, label[joined], j])
        kind = np.concatenate([links[linked], np.zeros(len(joined)), np.full(len(i), -1)]).astype(np.int64)
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(left)), nodes.take(pa.array(right)), pa.array(kind), pa.array(keys[left]), pa.array(keys[right])], names=["u", "v", "links", "key_u", "key_v"])

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(parts: list[tuple]) -> pa.RecordBatch | None:
            d, a, b, *_ = parts[0]
            found = []
            for at in (a, b) if a != b else (a,):
                own = [p for p in parts if p[3] == at]
                if own:
                    joined = lambda k, kind, width: np.frombuffer(b"".join(p[k] for p in own), kind).reshape(-1, width)  # noqa: E731,B023
                    found.append((pa.concat_arrays([p[4] for p in own]), np.concatenate([p[5] for p in own]), Block(np.arange(sum(len(p[5]) for p in own)), np.concatenate([p[6] for p in own]), joined(7, np.int8, d), joined(8, np.int8, d), joined(9, np.float64, 4))))
            if a == b:
                return out_rows(found[0][0], found[0][1], found[0][2], found[0][2])
            return out_rows(pa.concat_arrays([f[0] for f in found]), np.concatenate([f[1] for f in found]), found[0][2], found[1][2]) if len(found) == 2 else None

        now, parts = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                d, a, b, block = (batch.column(k)[n].as_py() for k in range(4))
                if (d, a, b) != now:
                    if parts and (made := ended(parts)) and made.num_rows:
                        yield made
                    now, parts = (d, a, b), []
                parts.append((d, a, b, block, batch.column(4)[n].values, batch.column(5)[n].values.to_numpy(), batch.column(6)[n].values.to_numpy(), *(batch.column(k)[n].as_py() for k in (7, 8, 9))))
        if parts and (made := ended(parts)) and made.num_rows:
            yield made

    tasks = blocks * (blocks + 1) // 2
    grouped = dealt.repartition(min(tasks, 20_000), "d", "a", "b").sortWithinPartitions("d", "a", "b")
    found = materialize(map_rows(grouped, tiles, schema), "links")
    # what two int8 parts leave open, in double precision
    side = lambda n: keyed.select(F.col("key").alias(f"key_{n}"), F.col("x").alias(f"x_{n}"), F.col("copies").alias(f"copies_{n}"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda t, v: t + v)
    unit = lambda c: F.transform(c, lambda v: v / F.array_max(F.transform(c, F.abs)))
    open_pairs = found.where("links < 0").join(side("u"), "key_u").join(side("v"), "key_v").withColumn("x_u", unit(F.col("x_u"))).withColumn("x_v", unit(F.col("x_v")))
    settled = materialize(open_pairs.where(dot(F.col("x_u"), F.col("x_v")) / F.sqrt(dot(F.col("x_u"), F.col("x_u"))) / F.sqrt(dot(F.col("x_v"), F.col("x_v"))) >= threshold).select("u", "v", "key_u", "key_v", "copies_u", "copies_v"), "settled")
    counted = found.where("links > 0").select(F.col("key_u").alias("key"), "links").union(settled.select("key_u", "copies_v")).union(settled.select("key_v", "copies_u"))
    links = counted.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.where("links = 0").select("u", "v").union(settled.select("u", "v")))
    roots = roots.groupBy("node").agg(F.min("root").alias("root"))
    named = keyed.join(links, "key", "left").join(roots, "node", "left").select(F.col("x").alias("of"), F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    named = materialize(named, "named")  # a plain side, so that Spark can split the other at a frequent vector
    # invalid vectors get a null key, so that they match nothing
    rows_of = source.select("id", F.when(fine, x).alias("x"))
    joined = rows_of.join(named, rows_of["x"] == named["of"], "left")
    component = F.coalesce("root", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))

"""Suffix-array deduplication of word sequences with a sparse suffix array.

What is found: every word that lies in a *repeated passage*, ``min_words`` consecutive
words (separated by ASCII white space, compared exactly) that stand at two places or more.

How. Suffixes are retained at content-selected positions only: the minimisers, i.e. the
smallest hashes of ``gram`` words at every ``reach`` consecutive places, about one place in
``reach / 2``. So every passage retains a suffix among its first ``reach`` words, at the
same place in each copy, and copies share the ``min_words - reach + 1`` words from there
on, the suffix's *head*. Suffixes without an equal head drop out by a count. The rest are
given the words around them, as far as one passage reaches, and are sorted by their heads;
runs of neighbours with the same head are then extended to the left and to the right: at
each of the ways in which a passage can lie over the position, equal ones are matches. As
positions follow each other closely, longer passages are covered piece by piece. Where a
text repeats a word or a few words, equal suffixes follow each other at equal distances;
they travel as one row with a distance and a number.

Runs of over ``most`` rows (a passage in a large part of all documents) do not stay in
one task: their windows are counted by an aggregate that combines before the shuffle. By
default that is twice a task's fair share, 2,000 at least and 50,000 (16 MB) at most; it
decides where the work is done and not the result.

Words are compared by hashes (64 bits for heads, 32 bits a word in extending).

Defined cases: null, empty and shorter texts have no passage; repeats inside one document
count; the first copy is the one with the smallest (id, word number); rows equal in id and
text are one document, so repeating a row makes no repeat; null ids sort first; very long
texts are read whole, in one task each; an empty table gives no rows. Only documents with
a repeat are returned. Other columns are left out of ``repeats``, kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BASE, BYTE_BASE, Rolling, chunks, find_words, map_rows, materialize, texts_of

#: Bounds of the rows that a run may have in one task.
LEAST_ROWS, MOST_ROWS = 2_000, 50_000
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def sliding(values: np.ndarray, width: int, smallest: bool) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values."""
    f = np.minimum if smallest else np.maximum
    span, out = 1, values
    while span * 2 <= width:
        out = f(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return f(out[:-rest], out[rest:]) if rest else out


def progressions(at: np.ndarray, heads: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places with equal heads at equal distances of at most ``most``: (first place, head, number, distance)."""
    order = np.lexsort((at, heads))
    at, heads = at[order], heads[order]
    gap = np.diff(at)
    near = (heads[1:] == heads[:-1]) & (gap <= most)
    broken = ~near
    broken[1:] |= near[1:] & near[:-1] & (gap[1:] != gap[:-1])
    new = np.flatnonzero(np.concatenate(([True], broken))) if len(at) else np.zeros(0, np.int64)
    number = np.diff(np.concatenate((new, [len(at)])))
    step = np.where(number > 1, np.concatenate((gap, [1]))[new] if len(at) else 1, 1)
    return at[new], heads[new], number, step


class Words:
    """Word hashes of texts and the minimisers among them."""

    def __init__(self, min_words: int, gram: int, reach: int):
        self.min_words, self.gram, self.reach = min_words, gram, reach
        self.by_byte, self.by_word = Rolling(BYTE_BASE), Rolling(WORD_BASE)

    def texts(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """(index, word hashes) of each text."""
        for first, part in chunks(texts):
            data, starts, ends, per_text = find_words(part, IS_WORD)
            hashes = self.by_byte.slices(self.by_byte.prefix(data.astype(np.uint64) + np.uint64(1)), starts, ends)
            stops = np.cumsum(per_text)
            for i, (a, b) in enumerate(zip(stops - per_text, stops, strict=True)):
                yield first + i, hashes[a:b]

    def retained(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(positions, hashes of the heads, numbers, distances) of the retained suffixes, as ``progressions``."""
        n, head = len(hashes), self.min_words - self.reach + 1
        if n < self.min_words:
            return progressions(np.zeros(0, np.int64), np.zeros(0, np.uint64), self.reach)
        prefix = self.by_word.prefix(hashes)
        at = np.arange(n - self.gram + 1)
        grams = self.by_word.slices(prefix, at, at + self.gram)
        low = sliding(grams, self.reach, True)
        edge = np.zeros(self.reach - 1, np.uint64)
        chosen = np.flatnonzero(sliding(np.concatenate([edge, low, edge]), self.reach, False) == grams)
        chosen = chosen[chosen + head <= n]
        return progressions(chosen, self.by_word.slices(prefix, chosen, chosen + head), self.reach)


def _identity(id_col: str, text_col: str) -> F.Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def retained_suffixes(documents: DataFrame, *, id_col: str, text_col: str, min_words: int, gram: int, reach: int) -> DataFrame:
    """(key, doc, pos, m, step) of every retained suffix; doc stands for id and text, m and step for equal ones that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(min_words, gram, reach)
        for batch in batches:
            docs, pos, keys, of, many, steps = batch.column(0).to_numpy(zero_copy_only=False), [], [], [], [], []
            for i, hashes in words.texts(texts_of(batch.column(1))):
                at, head, m, step = words.retained(hashes)
                of.append(np.full(len(at), docs[i]))
                pos.append(at)
                keys.append(head)
                many.append(m)
                steps.append(step)
            if of:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(of).astype(np.int64)), pa.array(np.concatenate(pos).astype(np.int32)), pa.array(np.concatenate(many).astype(np.int32)), pa.array(np.concatenate(steps).astype(np.int32))], names=["key", "doc", "pos", "m", "step"])

    return map_rows(documents.select(_identity(id_col, text_col).alias("doc"), F.col(text_col)), run, T._parse_datatype_string("key long, doc long, pos int, m int, step int"))


def repeats(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, gram: int = 8, reach: int = 30, most: int | None = None) -> DataFrame:
    """(id, doc, n_words, spans, later): word spans in repeated passages, and of copies after the first.

    Spans are arrays of (start, end) in words, end exclusive, merged and in order.
    """
    if not 1 < reach <= min_words - gram + 1:
        raise ValueError("reach must be over 1 and at most min_words - gram + 1")
    id_type = documents.schema[id_col].dataType
    suffixes = retained_suffixes(documents, id_col=id_col, text_col=text_col, min_words=min_words, gram=gram, reach=reach)
    # n: rows with the words around them; equal places that follow each other differ only near their ends
    equal = materialize(suffixes.groupBy("key").agg(F.sum(F.least(F.col("m"), F.floor(2 * (reach - 1) / F.col("step")) + 2)).alias("n"), F.sum("m").alias("places")).where("places > 1"), "heads")
    if most is None:
        share = (equal.agg(F.sum("n")).first()[0] or 0) * 2 // int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = min(MOST_ROWS, max(LEAST_ROWS, share))
    texts = documents.select(_identity(id_col, text_col).alias("of"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    left, width = reach - 1, min_words + reach - 1

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words around each retained suffix with an equal head."""
        words = Words(min_words, gram, reach)
        for batch in batches:
            pos, key, many, steps = (batch.column(k) for k in range(2, 6))
            for i, hashes in words.texts(texts_of(batch.column(6))):
                m, step = many[i].values.to_numpy(), steps[i].values.to_numpy()
                row = np.repeat(np.arange(len(m)), m)
                # the places of each row, one after the other
                at = pos[i].values.to_numpy()[row].astype(np.int64) + step[row] * (np.arange(len(row)) - (np.cumsum(m) - m)[row])
                heads = key[i].values.to_numpy()[row]
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                padded = np.concatenate([np.zeros(left, np.uint32), short, np.zeros(min_words, np.uint32)])
                for a in range(0, len(at), 4096):
                    some = at[a : a + 4096]
                    around = padded[some[:, None] + np.arange(width)]
                    part = row[a : a + 4096]
                    new = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (around[1:] != around[:-1]).any(axis=1))))
                    size = np.diff(np.concatenate((new, [len(some)])))
                    some, around, n = some[new], np.ascontiguousarray(around[new]), len(new)
                    blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width * 4), n, [None, pa.py_buffer(around)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(heads[a + new]), pa.repeat(batch.column(1)[i], n), pa.repeat(batch.column(0)[i], n), pa.array(some.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(step[part[new]].astype(np.int32)), pa.repeat(pa.scalar(len(hashes), pa.int32()), n), blob], names=["key", "id", "doc", "pos", "m", "step", "n_words", "around"])

    around_schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", id_type), T.StructField("doc", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("m", T.IntegerType()), T.StructField("step", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("around", T.BinaryType())])

    def around(heads: DataFrame) -> DataFrame:
        """The words around the suffixes with these heads. The texts meet one row of places a document."""
        places = suffixes.join(heads.select("key"), "key").groupBy("doc").agg(F.collect_set(F.struct("pos", "key", "m", "step")).alias("places"))
        joined = texts.join(places, texts["of"] == places["doc"]).select("doc", "id", "places.pos", "places.key", "places.m", "places.step", "text")
        return map_rows(joined, extended, around_schema)

    def windows(batch: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Of each row and offset: the hash of the window that starts ``offset`` words before, and whether it is inside the text."""
        n = batch.num_rows
        data = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint32).reshape(n, width).astype(np.uint64)
        rolling = Rolling(WORD_BASE)
        rolling.prefix(np.zeros(width, np.uint64))
        prefix = np.zeros((n, width + 1), np.uint64)
        np.cumsum((data + np.uint64(1)) * rolling.up[:width], axis=1, dtype=np.uint64, out=prefix[:, 1:])
        start = left - np.arange(left + 1)
        hashes = (prefix[:, start + min_words] - prefix[:, start]) * rolling.down[start]
        pos, size, m, step = (batch.column(c).to_numpy() for c in ("pos", "n_words", "m", "step"))
        begin = pos[:, None] - np.arange(left + 1)
        return hashes, (begin >= 0) & (begin + ((m - 1) * step)[:, None] + min_words <= size[:, None])

    found_schema = T.StructType([T.StructField("id", id_type), T.StructField("doc", T.LongType()), T.StructField("n_words", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("later", T.BooleanType())])

    def matches(table: pa.Table) -> pa.RecordBatch | None:
        """Windows that equal another's of the same run and offset, as spans."""
        doc, place = table.column("doc").to_numpy(), table.column("pos").to_numpy()
        table = table.filter(pa.array(np.concatenate(([True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])))))  # repeated rows
        hashes, valid = windows(table)
        key = table.column("key").to_numpy().view(np.uint64)
        offset = np.arange(left + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            full = (hashes ^ (key[:, None] * np.uint64(0x9FB21C651E98DF25))) * np.uint64(0xD6E8FEB86659FD93) + offset
        rows, offsets = np.nonzero(valid)
        pos, many, step = (table.column(c).to_numpy() for c in ("pos", "m", "step"))
        _, first, inverse = np.unique(full[rows, offsets], return_index=True, return_inverse=True)
        hit = np.bincount(inverse, weights=many[rows])[inverse] > 1
        later = first[inverse] != np.arange(len(rows))
        rows, offsets, later = rows[hit], offsets[hit], later[hit]
        if not len(rows):
            return None
        # neighbouring offsets of one row with the same flag are one span
        new = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]) | (offsets[1:] != offsets[:-1] + 1) | (later[1:] != later[:-1]))))
        last = np.concatenate((new[1:], [len(rows)])) - 1
        at, later = rows[new], later[new]
        start, end = pos[at] - offsets[last], pos[at] + (many[at] - 1) * step[at] - offsets[new] + min_words
        more = np.flatnonzero(~later & (many[at] > 1))  # of equal neighbours all but the first are later copies
        start, at, end, later = np.concatenate([start, start[more] + step[at[more]]]), np.concatenate([at, at[more]]), np.concatenate([end, end[more]]), np.concatenate([later, np.ones(len(more), bool)])
        take = lambda c: table.column(c).combine_chunks().take(pa.array(at))
        return pa.RecordBatch.from_arrays([take("id"), take("doc"), take("n_words"), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(later)], names=["id", "doc", "n_words", "start", "end", "later"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole runs of equal first words, a few thousand rows at a time."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= 4096:
                table = pa.Table.from_batches(held)
                keys = table.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut and (out := matches(table.slice(0, cut))):
                    yield out
                held, size = table.slice(cut).to_batches(), len(keys) - cut
        if held and (out := matches(pa.Table.from_batches(held))):
            yield out

    # ids and places in order, so that the first of equal windows is the first copy
    light = around(equal.where(F.col("n") <= most)).repartition("key").sortWithinPartitions("key", "id", "doc", "pos")
    found = map_rows(light, runs, found_schema)

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2048):
                batch = whole.slice(a, 2048)
                hashes, valid = windows(batch)
                rows, offsets = np.nonzero(valid)
                at = pa.array(rows)
                pos = batch.column("pos").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column("key").take(at), pa.array(offsets.astype(np.int32)), pa.array(hashes[rows, offsets].view(np.int64)), batch.column("id").take(at), batch.column("doc").take(at), batch.column("n_words").take(at), pa.array((pos[rows] - offsets).astype(np.int32)), batch.column("m").take(at), batch.column("step").take(at)], names=["key", "offset", "window", "id", "doc", "n_words", "start", "m", "step"])

    spans, often = found, equal.where(F.col("n") > most)
    if often.limit(1).count():
        wide = T.StructType([T.StructField("key", T.LongType()), T.StructField("offset", T.IntegerType()), T.StructField("window", T.LongType()), *found_schema.fields[:4], T.StructField("m", T.IntegerType()), T.StructField("step", T.IntegerType())])
        heavy = map_rows(around(often), exploded, wide).distinct()
        place = F.struct("id", "doc", "start")
        again = heavy.groupBy("key", "offset", "window").agg(F.min(place).alias("first"), F.sum("m").alias("places")).where("places > 1").drop("places")
        again = materialize(again, "windows")
        both = heavy.join(again, ["key", "offset", "window"]).withColumn("later", ~place.eqNullSafe(F.col("first"))).withColumn("end", F.col("start") + (F.col("m") - 1) * F.col("step") + min_words)
        # of equal neighbours all but the first are later copies
        kinds = F.when(F.col("later"), F.array(F.struct("start", "later"))).when(F.col("m") > 1, F.array(F.struct("start", "later"), F.struct((F.col("start") + F.col("step")).alias("start"), F.lit(True).alias("later")))).otherwise(F.array(F.struct("start", "later")))
        # a table of its own, so that the join is a stage that Spark can split at a frequent window
        spans = found.union(materialize(both.withColumn("kind", F.explode(kinds)).select("id", "doc", "n_words", "kind.start", "end", "kind.later"), "frequent"))

    pair = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("doc", T.LongType()), T.StructField("n_words", T.IntegerType()), T.StructField("spans", pair), T.StructField("later", pair)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def merged(start: np.ndarray, end: np.ndarray) -> list[dict]:
        """Spans in order of their starts, merged where they overlap or touch."""
        if not len(start):
            return []
        far = np.maximum.accumulate(end)
        new = np.flatnonzero(np.concatenate(([True], start[1:] > far[:-1])))
        return [{"start": a, "end": b} for a, b in zip(start[new].tolist(), far[np.concatenate((new[1:], [len(start)])) - 1].tolist(), strict=True)]

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row of merged spans for each document; a document's rows follow each other."""

        def made(table: pa.Table) -> pa.RecordBatch:
            doc, start, end, later = (table.column(c).to_numpy() for c in ("doc", "start", "end", "later"))
            cuts = np.concatenate(([0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(doc)]))
            every, copies = [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                every.append(merged(start[a:b], end[a:b]))
                of = later[a:b]
                copies.append(merged(start[a:b][of], end[a:b][of]))
            at = pa.array(cuts[:-1])
            take = lambda c: table.column(c).combine_chunks().take(at)
            return pa.RecordBatch.from_arrays([take("id"), take("doc"), take("n_words"), pa.array(every, kind), pa.array(copies, kind)], names=[id_col, "doc", "n_words", "spans", "later"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            doc = table.column("doc").to_numpy()
            cut = int(np.flatnonzero(doc != doc[-1])[-1]) + 1 if doc[0] != doc[-1] else 0
            if cut:
                yield made(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield made(pa.Table.from_batches(held))

    return map_rows(spans.repartition("doc").sortWithinPartitions("doc", "start"), by_document, schema)


def dedup(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, with the words of every copy after the first taken out.

    The white space before a removed word goes with it; other text stays as it is.
    """
    found = repeats(documents, id_col=id_col, text_col=text_col, **options).where(F.size("later") > 0).select(F.col("doc").alias("__doc"), F.col("later").alias("__later"))
    joined = documents.withColumn("__of", _identity(id_col, text_col)).join(found, F.col("__of") == F.col("__doc"), "left").drop("__of", "__doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = batch.schema.get_field_index(text_col), []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.schema.get_field_index("__later")).to_pylist(), strict=True):
                if spans:
                    raw = text.encode("utf-8", "surrogatepass")
                    _, starts, ends, _ = find_words([raw], IS_WORD)
                    done, parts = 0, []
                    for s in spans:
                        parts.append(raw[done : ends[s["start"] - 1] if s["start"] else 0])
                        done = int(ends[s["end"] - 1])
                    text = b"".join([*parts, raw[done:]]).decode("utf-8", "surrogatepass")
                out.append(text)
            names = [n for n in batch.schema.names if n != "__later"]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
            yield batch.select(names)

    return map_rows(joined, run, documents.schema)

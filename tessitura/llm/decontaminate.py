"""Benchmark decontamination: one Aho-Corasick scan of normalised text, offsets kept.

Normalising lower-cases A-Z and turns every other ASCII character that is neither a
letter nor a digit into a space; it keeps the length in bytes, so a word's place in the
normalised text is its place in the original. The automaton's patterns are windows of
consecutive item words between single spaces; it reads each text once.

One automaton holds windows and item ids of about ``most_bytes`` bytes, whatever items they come
from: pairs of window and id are dealt by a hash, so neither a huge item nor a window that
every item holds outgrows it. A larger benchmark takes as many passes. A worker builds an
automaton once and keeps it for its next tasks.

Defined cases: null and empty texts have no words and no hits; an item without words
has no window; items with a null id hit words but are named by the empty string; ties
and repeated rows are judged one by one; null document ids are carried through; an empty
benchmark or an empty table gives no hits. Other columns of the documents are left out
of ``scan`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, materialize, texts_of

#: Of each byte: itself if it is in a word, in lower case, else a space.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(PLAIN).split()


def windows(item: list[bytes], size: int) -> list[bytes]:
    """Windows of ``size`` consecutive words; a shorter item is one window."""
    return [b" ".join(item[i : i + size]) for i in range(max(1, len(item) - size + 1))] if item else []


def window_table(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(window, item) of every window, each pair once; a null id is the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [w.decode("utf-8", "surrogatepass") for w in windows(words(text), size)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([item] * len(found), pa.string())], names=["window", "item"])

    named = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    return materialize(map_rows(named, run, T._parse_datatype_string("window string, item string")).distinct(), "windows")


def shards(table: DataFrame, most_bytes: int) -> Iterator[dict[str, list[str]]]:
    """Window -> ids, about ``most_bytes`` bytes of them at a time: what the driver and one automaton hold."""
    total = table.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    number = max(1, -(-total // most_bytes))
    for k in range(number):
        part: dict[str, list[str]] = {}
        found = table.where(F.pmod(F.xxhash64("window", "item"), F.lit(number)) == k).toArrow()
        for w, item in zip(found.column("window").to_pylist(), found.column("item").to_pylist(), strict=True):
            part.setdefault(w, []).append(item)
        yield part


def automaton(part: dict[str, list[str]]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for w, ids in part.items():
        text = f" {w} "
        built.add_word(text, (len(text), ids))
    built.make_automaton()
    return built


def hits(built: ahocorasick.Automaton, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
    """Of a document's words: which are inside an occurrence, and the ids of its items."""
    inside, ids = np.zeros(len(found), bool), set()
    text = f" {b' '.join(found).decode('utf-8', 'surrogatepass')} "
    at = []
    for end, (length, of) in built.iter(text):
        at.append((end - length + 1, end))
        ids.update(of)
    if at:
        lengths = np.fromiter((len(w.decode("utf-8", "surrogatepass")) + 1 for w in found), np.int64, len(found))
        starts = np.concatenate(([0], np.cumsum(lengths)))  # of the space before each word
        for a, b in at:
            inside[np.searchsorted(starts, a) : np.searchsorted(starts, b)] = True
    return inside, ids


def spans_of(text: str, inside: np.ndarray) -> list[dict]:
    """Runs of hit words as code points of the original text, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass")
    plain = np.frombuffer(raw.translate(PLAIN), np.uint8)
    lit = np.concatenate(([False], plain != 32, [False]))
    edges = np.flatnonzero(lit[1:] != lit[:-1])
    point = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    runs = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return [{"start": int(point[edges[2 * a]]), "end": int(point[edges[2 * b - 1]])} for a, b in zip(runs[::2], runs[1::2], strict=True)]


def scan(documents: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, most_bytes: int = 8 << 20) -> DataFrame:
    """Documents against a benchmark: id, text, n_words, n_hit, items (sorted), spans (of hit words).

    One pass and no shuffle of documents. A benchmark of more than ``most_bytes`` is
    scanned in as many passes, each adding to what the passes before it have found, with a
    table in the shared folder between them.
    """
    schema = T.StructType([
        T.StructField(id_col, documents.schema[id_col].dataType), T.StructField(text_col, T.StringType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", SPANS), T.StructField("hit_words", T.BinaryType()),
    ])
    out, passes = documents.select(id_col, text_col), 0
    for part in shards(window_table(benchmark, item_col, item_text_col, window), most_bytes):
        if passes:
            out = materialize(out, "decontaminate")
        shared = documents.sparkSession.sparkContext.broadcast({"windows": part})  # about most_bytes

        def one_pass(batches: Iterator[pa.RecordBatch], shared=shared, again=passes > 0) -> Iterator[pa.RecordBatch]:
            held = shared.value
            if "built" not in held and held["windows"]:
                held["built"] = automaton(held["windows"])
            built = held.get("built")
            for batch in batches:
                rows = []
                for n, text in enumerate(texts_of(batch.column(1))):
                    found = words(text)
                    inside, ids = hits(built, found) if built and found else (np.zeros(len(found), bool), set())
                    if again:
                        inside |= np.unpackbits(np.frombuffer(batch.column(6)[n].as_py(), np.uint8), count=len(found)).astype(bool)
                        ids |= set(batch.column(4)[n].as_py())
                    hit = int(inside.sum())
                    rows.append((len(found), hit, sorted(ids), spans_of(text, inside) if hit else [], np.packbits(inside).tobytes() if hit else bytes(-(-len(found) // 8))))
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=[id_col, text_col, "n_words", "n_hit", "items", "spans", "hit_words"])

        out = map_rows(out, one_pass, schema)
        passes += 1
    return out.drop("hit_words")


def decontaminate(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, all columns, without those that hold a window of a benchmark item."""
    text_col = options.get("text_col", "text")
    packed = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("__row"), F.col(text_col).alias(text_col))
    found = scan(packed.select("__row", text_col), benchmark, **(options | {"id_col": "__row", "text_col": text_col}))
    return found.where("n_hit = 0").select(*(F.col("__row").getField(c).alias(c) for c in documents.columns))

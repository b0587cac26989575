"""Quality by importance resampling: hashed n-gram models of target and raw text.

Both models are multinomials over hashed n-grams, every occurrence counted: words
(lower-cased, between ASCII white space), pairs of neighbouring words, the first four bytes
and the last two bytes of each word. Each of the four kinds has 2**BITS buckets of its own.
*Target* is learned from the good ones of a bounded sample of labelled documents; *raw* from all documents. A bucket's log ratio is

    log((t + prior) / (r * T / R + prior))

with its counts t and r and its kind's totals T and R: ``prior`` occurrences are added to
what is seen in target text and to what raw text makes one expect, so that a rare n-gram
says little. Ratios are neither cut nor clipped.

A text is resampled whole, so it is worth no more than its worst passage: its log weight is
the smallest sum of log ratios over as many consecutive words as the longest of ``passages`` (all of
them in a shorter text), or over shorter ones, these times the root of how often the shorter goes into the
longest, as sums of words that say nothing grow by that root. Without passages, long clean text outvotes
any few bad words in it, and a mean over the text dilutes them; ten words alone dilute a single bad one
where the target sample is small.

Selection is by Gumbel top-k: log weight plus ``temperature`` times a Gumbel variable
seeded by a hash of the id, the k largest. At temperature 1 that samples k documents
without replacement in proportion to their weights. k is ``size`` if given, else the number of documents whose
weight reaches the cut that separates the labelled sample best among those that keep ``keep_good`` of its
good documents; there each document is weighed by a target model of the other four fifths,
which has not seen it. The
k-th largest value is found by counting, without collecting or sorting all of them.

Defined cases: null and empty texts have no word and weight 0; no labels, or labels of one
kind only, keep everything; a document is labelled by its lowest
quality and highest toxicity, null labels are ignored; documents that tie with the k-th
all stay; rows that repeat an id draw the same variable; a null id draws as the empty
string; an empty table gives no rows. ``select`` keeps all columns but one named as
``weight_col``, which it replaces; ``weights`` returns ids and weights alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BYTE_BASE, Rolling, chunks, find_words, map_rows, materialize, mix, texts_of

BITS, KINDS = 18, 4
IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False
HEAD_BYTES, TAIL_BYTES = 4, 2
#: Words of the passages that are looked at.
PASSAGES = (2, 10)
#: Parts of the labelled sample, each weighed by models of the others.
FOLDS = 5


class Features:
    """Hashed n-grams of documents, by the word at which they stand."""

    def __init__(self, bits: int = BITS):
        self.shift, self.bits, self.by_byte = np.uint64(64 - bits), bits, Rolling(BYTE_BASE)

    def of(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first document, words of each, a row of buckets for each kind, words that have a next one), some documents at a time."""
        for first, part in chunks((t or "").lower() for t in texts):
            data, starts, ends, per_text = find_words(part, IS_WORD)
            prefix = self.by_byte.prefix(data.astype(np.uint64) + np.uint64(1))
            word = self.by_byte.slices(prefix, starts, ends)
            head = self.by_byte.slices(prefix, starts, np.minimum(ends, starts + HEAD_BYTES))
            tail = self.by_byte.slices(prefix, np.maximum(starts, ends - TAIL_BYTES), ends)
            has_next = np.ones(len(word), bool)
            has_next[np.cumsum(per_text)[per_text > 0] - 1] = False
            pair = mix(word * np.uint64(3) + np.roll(word, -1))
            hashes = np.stack([word, pair, mix(head + np.uint64(1)), mix(tail + np.uint64(2))]) >> self.shift
            yield first, per_text, hashes.astype(np.int64) + (np.arange(KINDS, dtype=np.int64)[:, None] << self.bits), has_next


def worst_passages(ratio: np.ndarray, per_text: np.ndarray, buckets: np.ndarray, has_next: np.ndarray, passages: tuple[int, ...]) -> np.ndarray:
    """Of each document: the smallest sum of log ratios over a passage, shorter ones scaled to the longest."""
    by_word = ratio[buckets[0]].astype(np.float64) + np.where(has_next, ratio[buckets[1]], 0) + ratio[buckets[2]] + ratio[buckets[3]]
    total = np.concatenate(([0.0], np.cumsum(by_word)))
    stop = np.cumsum(per_text)
    doc = np.repeat(np.arange(len(per_text)), per_text)
    at = np.arange(len(by_word))
    out = np.where(per_text > 0, np.inf, 0.0)
    for passage in passages:
        whole = np.flatnonzero((at + passage <= stop[doc]) | (at == (stop - per_text)[doc]))
        worst = total[np.minimum(whole + passage, stop[doc[whole]])] - total[whole]
        np.minimum.at(out, doc[whole], worst * math.sqrt(max(passages) / passage))
    return out


@dataclass
class Model:
    """Log ratio of each bucket, and the log weight from which documents count as good."""

    ratio: np.ndarray
    cut: float


def frequencies(texts: DataFrame, text_col: str, bits: int = BITS) -> np.ndarray:
    """Occurrences of each bucket; the kinds follow each other.

    A task sends its non-zero buckets only; the sum has at most KINDS * 2**bits rows, and
    the driver gets two numbers for each.
    """
    size = KINDS << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(bits), np.zeros(size, np.int64)
        for batch in batches:
            for _, _, buckets, has_next in features.of(texts_of(batch.column(0))):
                total += np.bincount(np.concatenate([buckets[0], buckets[1][has_next], buckets[2], buckets[3]]), minlength=size)
        at = np.flatnonzero(total)
        for a in range(0, len(at), 1 << 16):
            some = at[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    table = map_rows(texts.select(text_col), run, T._parse_datatype_string("bucket int, n long")).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.float64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray, prior: float) -> np.ndarray:
    """Smoothed log ratio of each bucket; each kind is a distribution of its own."""
    t, r = target.reshape(KINDS, -1), raw.reshape(KINDS, -1)
    scale = t.sum(axis=1, keepdims=True) / np.maximum(1, r.sum(axis=1, keepdims=True))
    return np.log((t + prior) / (r * scale + prior)).reshape(-1).astype(np.float32)


def weigh(documents: DataFrame, ratio: np.ndarray, text_col: str, weight_col: str, passages: tuple[int, ...] | int = PASSAGES) -> DataFrame:
    """The documents, all columns, and their log weight. The ratios are broadcast: KINDS * 2**BITS floats."""
    shared = documents.sparkSession.sparkContext.broadcast(ratio)
    passages = (passages,) if isinstance(passages, int) else passages
    schema = T.StructType([*documents.schema.fields, T.StructField(weight_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        features = Features(int(math.log2(len(table) // KINDS)))
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for first, per_text, buckets, has_next in features.of(texts_of(batch.column(batch.schema.get_field_index(text_col)))):
                weight[first : first + len(per_text)] = worst_passages(table, per_text, buckets, has_next, passages)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight)], names=[*batch.schema.names, weight_col])

    return map_rows(documents, run, schema)


def best_cut(good: np.ndarray, bad: np.ndarray, keep_good: float) -> float:
    """The cut between observed weights that loses most bad and fewest good ones, of those that keep ``keep_good`` of the good."""
    if not len(good) or not len(bad):
        return -math.inf
    values = np.unique(np.concatenate([good, bad]))
    cuts = np.concatenate([[-math.inf], (values[1:] + values[:-1]) / 2])
    kept_good = 1 - np.searchsorted(np.sort(good), cuts) / len(good)
    lost_bad = np.searchsorted(np.sort(bad), cuts) / len(bad)
    return float(cuts[np.argmax(np.where(kept_good >= keep_good, kept_good + lost_bad, -1))])


def fit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic", most_labels: int = 20_000, prior: float = 1.0, passages: tuple[int, ...] = PASSAGES, keep_good: float = 0.985) -> Model:
    """A model from about ``most_labels`` labelled documents, chosen by a hash of their id, and all documents."""
    known = labels.select(F.col(label_id_col).alias("__of"), F.col(quality_col).alias("q"), F.col(toxic_col).alias("t")).where("__of IS NOT NULL AND (q IS NOT NULL OR t IS NOT NULL)")
    known = known.groupBy("__of").agg(((F.coalesce(F.min("q"), F.lit(1)) > 0) & (F.coalesce(F.max("t"), F.lit(0)) < 1)).alias("good"))
    number = known.count()
    share = min(1_000_000, math.ceil(1e6 * most_labels / max(1, number)))
    known = known.where(F.pmod(F.xxhash64("__of"), F.lit(1_000_000)) < share).withColumn("fold", F.pmod(F.xxhash64(F.lit("cut"), "__of"), F.lit(FOLDS)))
    sample = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("id") == F.col("__of")).drop("__of")  # about most_labels rows of three numbers
    sample = materialize(sample, "labelled")
    folds = [frequencies(sample.where("good").where(F.col("fold") == k), "text") for k in range(FOLDS)]
    target = sum(folds)
    if not target.any():
        return Model(np.zeros(len(target), np.float32), -math.inf)
    raw = frequencies(documents, text_col)
    scored = unseen_weights(sample, folds, raw, prior, passages).select("good", "w").toArrow()  # about most_labels rows
    good, weight = scored.column("good").to_numpy(), scored.column("w").to_numpy()
    return Model(log_ratios(target, raw, prior), best_cut(weight[good], weight[~good], keep_good))


def unseen_weights(sample: DataFrame, folds: list[np.ndarray], raw: np.ndarray, prior: float, passages: tuple[int, ...]) -> DataFrame:
    """The sample, and its log weights (w) by the target models of the other folds."""
    parts = [weigh(sample.where(F.col("fold") == k), log_ratios(sum(folds) - own, raw, prior), "text", "w", passages) for k, own in enumerate(folds)]
    return reduce(DataFrame.unionByName, parts)


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest of a column of finite doubles, by counting in ever narrower bins; each round has at most 65536."""
    raw = F.col(column)
    low, high = values.agg(F.min(raw), F.max(raw)).first()
    for _ in range(6):
        if low == high:
            return low
        step = (high - low) / 65536
        if step == 0 or low + step == low:
            break
        bin_of = F.least(F.floor((raw - low) / step), F.lit(65535)).alias("bin")
        counts = values.where((raw >= low) & (raw <= high)).groupBy(bin_of).agg(F.count(F.lit(1)).alias("n"), F.min(raw).alias("a"), F.max(raw).alias("b")).orderBy(F.desc("bin")).collect()  # at most 65536 rows
        for r in counts:
            if k <= r["n"]:
                low, high = r["a"], r["b"]
                break
            k -= r["n"]
    return low


def gumbel(id_col: str, seed: int) -> F.Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def _sampled(weighed: DataFrame, cut: float, id_col: str, weight_col: str, temperature: float, seed: int, size: int | None = None) -> DataFrame:
    """Of a written table of weighed rows: the k largest by weight and noise."""
    k = weighed.where(F.col(weight_col) >= cut).count() if size is None else min(size, weighed.count())
    value = F.col(weight_col) + temperature * gumbel(id_col, seed)
    return weighed.where(value >= kth_largest(weighed.select(value.alias("value")), "value", k)) if k else weighed.limit(0)


def select(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", temperature: float = 1.0, seed: int = 7, size: int | None = None, weight_col: str = "log_weight", passages: tuple[int, ...] = PASSAGES, **options) -> DataFrame:
    """The documents that importance resampling keeps, all columns, and their log weight."""
    model = fit(documents, labels, id_col=id_col, text_col=text_col, passages=passages, **options)
    weighed = materialize(weigh(documents.drop(weight_col), model.ratio, text_col, weight_col, passages), "weighed")
    return _sampled(weighed, model.cut, id_col, weight_col, temperature, seed, size)


def weights(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", temperature: float = 1.0, seed: int = 7, size: int | None = None, weight_col: str = "log_weight", passages: tuple[int, ...] = PASSAGES, **options) -> DataFrame:
    """(id, log weight) of the documents that importance resampling keeps; texts are not written."""
    model = fit(documents, labels, id_col=id_col, text_col=text_col, passages=passages, **options)
    weighed = materialize(weigh(documents.select(id_col, text_col), model.ratio, text_col, weight_col, passages).select(id_col, weight_col), "weights")
    return _sampled(weighed, model.cut, id_col, weight_col, temperature, seed, size)

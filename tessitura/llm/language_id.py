"""Language identification, word first, with backoff to ever shorter character n-grams.

A word that the model knows scores by its log frequency in each language; an unknown word
by the mean log frequency of those of its longest character n-grams (4, 3, 2, then 1, with
``<`` and ``>`` for its ends) of which any is known. A document's score is the posterior of
the best language, every word of the whole text counted, languages equally likely before.
A word is a run of letters (Unicode category L), lower-cased.

The model is fitted on a bounded sample: about ``per_language`` labelled documents of each
language, at most ``most_rows`` in all, chosen by a hash of the id; every word and n-gram of
the sample stays in it. Labels, sources and ids are no input of a prediction.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as all are
if nothing can be learned; a text of letters that are all new gets the first language by
name at its prior; null labels teach nothing; a null id counts as the empty string when
folds are dealt; repeated rows are judged one by one; words of any length are read whole;
an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows, texts_of

#: Runs of word characters that are no decimal digits; ``words_of`` leaves letters alone.
RUN = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
#: Words whose backoff is remembered at once, in one Python worker.
REMEMBERED = 100_000


def words_of(text: str | None) -> Counter:
    """How often each word occurs."""
    counts = Counter(RUN.findall((text or "").lower()))
    for run in [r for r in counts if not r.isalpha()]:  # fractions, superscripts, circled digits
        k = counts.pop(run)
        for word in "".join(c if c.isalpha() else " " for c in run).split():
            counts[word] += k
    return counts


def grams(word: str, n: int) -> Iterator[str]:
    """Every n-gram of the whole word, one at a time, so that a long word makes no long list."""
    marked = f"<{word}>" if n > 1 else word
    return (marked[i : i + n] for i in range(len(marked) - n + 1))


class Model:
    """Log frequencies: a row for each known word (order 0) or n-gram, a column for each language.

    It is made of plain lists and arrays (``plain``), which is what travels to the workers.
    """

    def __init__(self, languages: list[str], order: np.ndarray, names: list[str], counts: np.ndarray):
        self.plain = languages, order, names, counts
        self.languages = languages
        self.index: dict[int, dict[str, int]] = {n: {} for n in (0, *ORDERS)}
        for i, (n, name) in enumerate(zip(order.tolist(), names, strict=True)):
            self.index[n][name] = i
        totals = np.zeros((max(ORDERS) + 1, len(languages)))
        np.add.at(totals, order, counts)
        # what a language has not seen counts half an occurrence
        self.rows = np.log(np.where(counts > 0, counts, 0.5) / (totals[order] + 1)).astype(np.float32)

    def backoff(self, word: str) -> np.ndarray:
        for n in ORDERS:
            index = self.index[n]
            known = Counter(index[g] for g in grams(word, n) if g in index)  # at most as many as the model has
            if known:
                k = np.fromiter(known.values(), np.float64, len(known))
                return k @ self.rows[list(known)] / k.sum()
        return np.zeros(len(self.languages), np.float32)


class Scorer:
    """A model in one worker, with the last unknown words' scores remembered."""

    def __init__(self, model: Model):
        self.model, self.size = model, len(model.rows)
        self.rows = np.concatenate([model.rows, np.zeros((REMEMBERED, len(model.languages)), np.float32)])
        self.clear()

    def clear(self) -> None:
        self.new, self.used = {}, self.size

    def find(self, words: list[str]) -> list[int]:
        """Rows of at most REMEMBERED different words."""
        at = list(map(self.model.index[0].get, words))
        unknown = [i for i, x in enumerate(at) if x is None]
        if self.used + len(unknown) > len(self.rows):
            self.clear()
        for i in unknown:
            row = self.new.get(words[i])
            if row is None:
                row = self.new[words[i]] = self.used
                self.rows[row] = self.model.backoff(words[i])
                self.used += 1
            at[i] = row
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = words_of(text)
        if not counts or not self.model.languages:
            return "und", 0.0
        words, k = list(counts), np.fromiter(counts.values(), np.float64, len(counts))
        total = np.zeros(len(self.model.languages))
        for a in range(0, len(words), REMEMBERED):
            total += k[a : a + REMEMBERED] @ self.rows[self.find(words[a : a + REMEMBERED])]
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def fit(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 2000, most_rows: int = 20_000) -> Model:
    """A model of the labelled documents' languages, of bounded size (see the module)."""
    rows = documents.select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang")).where("t IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0, np.int64), [], np.zeros((0, 0), np.int64))
    each = max(1, min(per_language, most_rows // len(languages)))
    share = F.lit(None).cast("long")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1_000_000, math.ceil(1e6 * each / n)))).otherwise(share)
    sample = rows.where(F.pmod("h", F.lit(1_000_000)) < share).select("t", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            out = []
            for lang, found in seen.items():
                by_gram: Counter = Counter()
                for word, k in found.items():
                    out.append((lang, 0, word, k))
                    for n in ORDERS:
                        for g in grams(word, n):
                            by_gram[n, g] += k
                out += [(lang, n, g, k) for (n, g), k in by_gram.items()]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["lang", "n", "gram", "k"])

    counted = map_rows(sample, count, T._parse_datatype_string("lang string, n int, gram string, k long"))
    by_lang = [F.sum(F.when(F.col("lang") == x, F.col("k")).otherwise(0)).alias(f"k{i}") for i, x in enumerate(languages)]
    table = counted.groupBy("n", "gram").agg(*by_lang).toArrow()  # the words and n-grams of at most most_rows documents
    counts = np.stack([table.column(f"k{i}").to_numpy() for i in range(len(languages))], axis=1) if table.num_rows else np.zeros((0, len(languages)), np.int64)
    return Model(languages, table.column("n").to_numpy().astype(np.int64), table.column("gram").to_pylist(), counts)


def predict(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score): one pass without a shuffle. The model is broadcast as plain data; ``fit`` bounds its size."""
    schema = T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = documents.sparkSession.sparkContext.broadcast({"plain": model.plain})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "scorer" not in held:  # once in each worker
            held["scorer"] = Scorer(Model(*held["plain"]))
        scorer = held["scorer"]
        for batch in batches:
            found = [scorer.predict(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    return map_rows(documents.select(id_col, text_col), run, schema)


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> F.Column:
    """Is the row in the fold that is kept from training?"""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold

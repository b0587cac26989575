"""Mixing sources to target weights by Poisson replication, natively.

Each document gets a number of copies drawn from a Poisson distribution whose mean is its
source's repetition rate: target share of the output over share of the input. The draw
inverts the distribution at a number in [0, 1) that a hash of seed and id gives, so a
retried task draws the same. Copies are exploded and shuffled globally by another hash.

A rate over ``piece`` is the sum of equal independent parts, each of at most ``piece``, so
the distribution function never underflows.

Defined cases: a null source is a source of its own; without weights all sources get equal
shares; a source with no weight or weight 0 gets no copy, one named that has no document
is left out of the shares; null and empty texts are copied like others; a null id draws as
the empty string; rows that repeat an id get the same number of copies; an empty table
gives no rows. All columns are kept; ``copy`` and ``shuffle_key`` replace any such column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The distribution function at a mean of PIECE is 1 in double precision long before TERMS.
PIECE, TERMS = 16.0, 100
#: Source tables up to this many rows are broadcast; larger ones are joined by shuffle.
MOST_BROADCAST = 20_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts, on a grid of 2**-52."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0 ... TERMS - 1 of a Poisson variable, added up in that order."""
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), F.array(first).alias("c"))
    step = lambda a, k: F.struct((a["p"] * rate / k).alias("p"), F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * rate / k)).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda a: a["c"])


def rates(documents: DataFrame, *, source_col: str, weights: Mapping[str | None, float] | None, total: int | None) -> DataFrame:
    """(source, rate): mean number of copies of each source's documents, in a fixed order of sums."""
    sizes = documents.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for source, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("w", weight)
    whole = sizes.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    out = float(total if total is not None else whole["n"] or 0)
    rate = F.col("w") / F.lit(whole["w"]) * F.lit(out) / F.col("n") if whole["w"] else F.lit(0.0)
    return sizes.select("source", rate.alias("rate"))


def mix_sources(documents: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", weights: Mapping[str | None, float] | None = None, total: int | None = None, seed: int = 0) -> DataFrame:
    """The documents, each as often as its draw says, in random order, with copy and shuffle_key."""
    table = rates(documents, source_col=source_col, weights=weights, total=total)
    table = table.withColumn("pieces", F.ceil(F.col("rate") / PIECE).cast("int")).withColumn("cdf", F.when(F.col("rate") > 0, distribution(F.col("rate") / F.col("pieces"))))
    table = table.select(F.col("source").alias("__source"), F.col("pieces").alias("__pieces"), F.col("cdf").alias("__cdf"))
    if table.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        table = F.broadcast(table)
    name = F.coalesce(documents[id_col].cast("string"), F.lit(""))

    def drawn(j: Column) -> Column:
        u = uniform(F.lit(str(seed)), name, j.cast("string"))
        return F.size(F.filter("__cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("__pieces")), F.lit(0), lambda a, j: a + drawn(j))
    rest = [documents[c] for c in documents.columns if c not in ("copy", "shuffle_key")]
    rows = (
        documents.join(table, documents[source_col].eqNullSafe(F.col("__source"))).where("__pieces > 0")
        .withColumn("__n", copies).where("__n > 0")
        .select(*rest, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    )
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("copy").cast("string"), F.lit("order"))), 1, 15), 16, 10).cast("bigint")
    return rows.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")

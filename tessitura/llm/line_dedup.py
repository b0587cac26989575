"""Line deduplication: suffixes of line-ID sequences ranked by distributed prefix doubling, natively.

Each document is a sequence of lines; every line begins a suffix. Contents of lines that
stand at two places or more are sorted globally, and their place in that order is the rank
of a suffix by its first line; other lines end what can repeat and drop out. Doubling then
joins the ranks of suffixes that are 2**t lines apart, sorts the pairs that occur twice or
more, and so ranks suffixes by their first 2**(t+1) lines; each level's ranks are a table in
the shared folder. A rank is the number of a row in a range-partitioned sort, so no task
sees them all.

Suffixes that share their first n lines, 2**t <= n < 2**(t+1), are an interval of the
suffix array whose longest common prefix is n or more. It is named by n and the ranks of
level t at the run's first line and 2**t lines before its end, which together order its
members by their first n lines. One aggregate over these names finds each interval's first
member, by (id, text hash, line number), and the others are later copies.

A *run* is a sequence of consecutive lines with at least ``min_chars`` characters, a line
break counted for each line. What lies in a maximal repeated run is what the shortest
qualifying runs from each line on, and back from each line, cover where they repeat: a line
of it either reaches ``min_chars`` before the run's end or the run's end reaches back over
it. So intervals are asked for at those two depths of each line only, of at most
``min_chars`` lines, and longer runs need no further levels. Later copies are merged into
maximal runs of lines, which are deleted.

Defined cases: a null text has no lines and stays null; an empty text is one empty line; a
document of which every line is deleted has an empty text; rows equal in id and text are one
document and fare alike; null ids sort first and
match each other; long documents cost in proportion to their lines; an empty table gives
no rows. Other columns are kept by ``dedup_lines``, but for one named as ``deleted_col``,
which it replaces. Equal 96-bit hashes stand for equal lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def _levels(min_chars: int) -> int:
    return max(0, min_chars.bit_length() - 1)


def lines(documents: DataFrame, *, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, id, th, i, h, h2, ahead, back): each line's hashes, and how many lines from it on, and back from it, reach ``min_chars``."""
    t = F.col(text_col)
    df = documents.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("th"), F.split(t, "\n", -1).alias("lines")).where("lines IS NOT NULL")
    df = df.select(F.xxhash64("id", "th").alias("doc"), "id", "th", "lines", F.transform("lines", lambda x: F.length(x) + 1).alias("len"))

    def shortest(part: Column) -> Column:
        """How many of the part's lines reach min_chars; null if all do not."""
        empty = F.struct(F.lit(0).alias("s"), F.lit(0).alias("k"))
        step = lambda a, x: F.when(a["s"] >= min_chars, a).otherwise(F.struct((a["s"] + F.least(x, F.lit(min_chars))).alias("s"), (a["k"] + 1).alias("k")))
        return F.aggregate(part, empty, step, lambda a: F.when(a["s"] >= min_chars, a["k"]))

    def row(x: Column, i: Column) -> Column:
        alone = F.length(x) + 1 >= min_chars
        k = F.least(i + 1, F.lit(min_chars))
        ahead = F.when(alone, 1).otherwise(shortest(F.slice("len", i + 1, F.lit(min_chars))))
        back = F.when(alone, 1).otherwise(shortest(F.reverse(F.slice("len", i - k + 2, k))))
        return F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.hash(x).alias("h2"), ahead.alias("ahead"), back.alias("back"))

    return df.select("doc", "id", "th", F.explode(F.transform("lines", row)).alias("r")).select("doc", "id", "th", "r.*")


def ranked(rows: DataFrame, keys: list[str], level: int) -> DataFrame:
    """(keys, rank) of the keys that occur twice or more, ranked in their global order."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return materialize(repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), f"ranks-{level}")


def suffix_ranks(every_line: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """(repeated lines, (doc, t, i, rank): ranks of suffixes by their first 2**t lines, where these repeat)."""
    first = every_line.join(ranked(every_line, ["h", "h2"], 0), ["h", "h2"]).drop("h", "h2").distinct()
    first = materialize(first, "level-0")
    level = first.select("doc", "i", "rank")
    out = level.withColumn("t", F.lit(0))
    for t in range(levels):
        other = level.select(F.col("doc").alias("of"), (F.col("i") - (1 << t)).alias("at"), F.col("rank").alias("next"))
        pairs = level.join(other, (F.col("doc") == F.col("of")) & (F.col("i") == F.col("at"))).select("doc", "i", F.col("rank").alias("r"), F.col("next").alias("s"))
        pairs = materialize(pairs, "pairs")
        level = materialize(pairs.join(ranked(pairs, ["r", "s"], t + 1), ["r", "s"]).select("doc", "i", "rank"), f"level-{t + 1}")
        if level.isEmpty():
            break
        out = out.union(level.withColumn("t", F.lit(t + 1)))
    return first, out


def later_copies(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 50) -> DataFrame:
    """(id, th, start, n, first_id, copies): runs of lines that are not the first member of their interval.

    The aggregate combines before its shuffle; the join is of runs to one row for each
    interval, whose large partitions Spark can split.
    """
    every_line = materialize(lines(documents, id_col=id_col, text_col=text_col, min_chars=min_chars), "lines")
    first, ranks = suffix_ranks(every_line, _levels(min_chars))
    depths = F.array_distinct(F.array(F.struct(F.col("i").alias("start"), F.col("ahead").alias("n")), F.struct((F.col("i") - F.col("back") + 1).alias("start"), F.col("back").alias("n"))))
    asked = first.select("doc", "id", "th", F.explode(F.filter(depths, lambda d: d["n"].isNotNull())).alias("d")).select("doc", "id", "th", "d.start", "d.n").distinct()
    level = F.floor(F.log2("n") + 1e-9).cast("int")
    asked = asked.withColumn("t", level).withColumn("tail", F.expr("start + n - shiftleft(1, t)"))
    head = asked.join(ranks.select("doc", "t", F.col("i").alias("start"), F.col("rank").alias("a")), ["doc", "t", "start"])
    runs = materialize(head.join(ranks.select("doc", "t", F.col("i").alias("tail"), F.col("rank").alias("b")), ["doc", "t", "tail"]).select("id", "th", "start", "n", "a", "b"), "runs")
    at = F.struct("id", "th", "start")
    intervals = runs.groupBy("n", "a", "b").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    intervals = materialize(intervals, "intervals")  # a plain side, so that Spark can split the other at a frequent line
    return runs.join(intervals, ["n", "a", "b"]).where(~at.eqNullSafe(F.col("first"))).select("id", "th", "start", "n", F.col("first.id").alias("first_id"), "copies")


def merged(later: DataFrame) -> DataFrame:
    """(id, th, gone): the numbers of each document's deleted lines, in order; overlapping runs are merged first."""
    order = Window.partitionBy("id", "th").orderBy("start")
    end = F.col("start") + F.col("n")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = later.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    run = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = marked.withColumn("run", run).groupBy("id", "th", "run").agg(F.min("start").alias("a"), F.max(end).alias("b"))
    return runs.groupBy("id", "th").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("a", "b"))), lambda r: F.sequence(r["a"], r["b"] - 1))).alias("gone"))


def dedup_lines(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 50, deleted_col: str = "deleted_lines") -> DataFrame:
    """The documents, all columns, without the lines of later copies; ``deleted_col`` lists their numbers (from 0)."""
    gone = merged(later_copies(documents, id_col=id_col, text_col=text_col, min_chars=min_chars)).select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("gone").alias("__gone"))
    joined = documents.join(gone, documents[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(documents[text_col]) == gone["__th"]), "left")
    split = F.split(documents[text_col], "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "__gone"), lambda i: F.element_at(split, i + 1))
    text = F.when(F.col("__gone").isNull(), documents[text_col]).otherwise(F.array_join(kept, "\n"))
    columns = [c for c in documents.columns if c != deleted_col]
    return joined.select(*(text.alias(c) if c == text_col else documents[c] for c in columns), F.coalesce("__gone", F.array().cast("array<int>")).alias(deleted_col))

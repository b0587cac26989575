"""Source divergence audit: how the terms of a language's sources differ, by SQL over shards.

Texts are counted in chunks by an embedded SQL engine, counts are dealt to shards by language
and term, and each shard is worked through in runs of whole terms: SQL keeps the terms in
enough documents, and later gives the run's part of each pair's sum and its first terms
of each source. Spark merges sums and ranks. A run holds about ``RUN_ROWS`` rows, a chunk about
``CHUNK_BYTES`` of text, whatever the size of a shard.

Each kept term has p = 1 + floor(10^9 (count + 5) / (N + 5 V)) in each group (lang, source) and
in the language, N being the group's count over kept terms and V their number. A pair's
value is the sum of |p - q| over all V terms; it is put together from terms that both hold
(joined within a shard), terms that one holds (by how many terms have a count) and all others.

Defined cases: null text, lang and source are ''; null and empty texts make their group
occur and give no terms; repeated rows are documents of their own; ties rank by UTF-8 bytes;
a language without kept terms has pairs of value 0; further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, materialize

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
CHUNK_BYTES = 8 << 20
RUN_ROWS = 200_000
SCALE, PRIOR = 1_000_000_000, 5

COUNT = f"""
WITH w AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM texts),
d AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY i, lang, source, term)
SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, count(*) AS docs FROM d GROUP BY lang, source, term
"""
MERGE = "SELECT lang, source, term, CAST(sum(n) AS BIGINT) AS n, CAST(sum(docs) AS BIGINT) AS docs FROM counts GROUP BY lang, source, term"
KEEP = """
SELECT lang, source, term, n, CAST(row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS INTEGER) AS head
FROM run QUALIFY sum(docs) OVER (PARTITION BY lang, term) >= {least}
"""
AUDIT = f"""
WITH r AS (
  SELECT lang, source, term, 1 + CAST({SCALE} AS HUGEINT) * (n + {PRIOR}) // (total + {PRIOR} * kept) AS p, 1 + CAST({SCALE * PRIOR} AS HUGEINT) // (total + {PRIOR} * kept) AS p0,
    1 + CAST({SCALE} AS HUGEINT) * (CAST(sum(n) OVER (PARTITION BY lang, term) AS HUGEINT) + {PRIOR}) // (lang_total + {PRIOR} * kept) AS q
  FROM run)
SELECT 'pair' AS part, a.lang AS lang, a.source AS source, b.source AS item, CAST(sum(abs(a.p - b.p) - abs(a.p - b.p0) - abs(a.p0 - b.p) + abs(a.p0 - b.p0)) AS BIGINT) AS value
FROM r a JOIN r b ON a.lang = b.lang AND a.term = b.term AND a.source < b.source GROUP BY a.lang, a.source, b.source
UNION ALL
SELECT 'term', lang, source, term, CAST(p - q AS BIGINT) FROM r WHERE p > q QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) <= {{most}}
"""
COUNTS = "lang string, source string, term string, n bigint, docs bigint"
PARTS = "part string, lang string, source string, item string, value bigint"


def engine() -> duckdb.DuckDBPyConnection:
    """An engine in memory, of one thread and without a folder to spill to."""
    return duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})


def answered(con: duckdb.DuckDBPyConnection, sql: str, **tables: pa.Table) -> pa.Table:
    for name, t in tables.items():
        con.register(name, t)
    try:
        return con.execute(sql).to_arrow_table()
    finally:
        for name in tables:
            con.unregister(name)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms of (text, lang, source): each group's term once for some chunks of texts."""
    con, held = engine(), []
    names = ["text", "lang", "source"]
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            size, n = 0, 0
            lengths = pc.binary_length(batch.column(0))
            while at + n < batch.num_rows and (not n or size + lengths[at + n].as_py() <= CHUNK_BYTES):
                size += lengths[at + n].as_py()
                n += 1
            part = pa.Table.from_batches([batch.slice(at, n)]).rename_columns(names).append_column("i", pa.array(range(n), pa.int64()))
            held.append(answered(con, COUNT, texts=part))
            at += n
            if sum(t.num_rows for t in held) > 5 * RUN_ROWS:
                merged = answered(con, MERGE, counts=pa.concat_tables(held))
                held = [merged]
                if merged.num_rows > 2.5 * RUN_ROWS:
                    yield from merged.to_batches(max_chunksize=50_000)
                    held = []
    if held:
        yield from answered(con, MERGE, counts=pa.concat_tables(held)).to_batches(max_chunksize=50_000)


def runs(sql: str, rows: int):
    """The SQL over runs of about ``rows`` rows, cut where (lang, term) changes; rows are sorted by these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, held = engine(), []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            yield from answered(con, sql, run=table).to_batches(max_chunksize=50_000)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < rows:
                continue
            # the last term may go on in the next batch: where it begins, this run ends
            table = pa.Table.from_batches(held)
            last = pc.and_(pc.equal(table["lang"], table["lang"][-1]), pc.equal(table["term"], table["term"][-1]))
            cut = table.num_rows - pc.sum(last).as_py()
            if cut:
                yield from done(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    return run


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (n + PRIOR) / (total + PRIOR kept)), null where nothing is kept."""
    exact = lambda c: c.cast("decimal(38,0)")
    under = exact(total) + exact(kept) * PRIOR
    return F.call_function("div", exact((exact(n) + PRIOR) * SCALE), exact(F.when(under > 0, under))) + 1


def audit(documents: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 30, most_terms: int = 50, shards: int | None = None, run_rows: int = RUN_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): each source against all others of its language, and its first terms."""
    shards = shards or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    by_shard = lambda t: t.repartition(shards, "lang", "term")

    counts = by_shard(plain.mapInArrow(counted, COUNTS)).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = materialize(counts.sortWithinPartitions("lang", "term").mapInArrow(runs(KEEP.format(least=int(least_docs)), run_rows), "lang string, source string, term string, n bigint, head int"), "terms")

    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("head").alias("heads"))
    langs = sums.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("heads").alias("kept"))
    groups = plain.select("lang", "source").distinct().join(sums.drop("heads"), ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = materialize(groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "lang_total", "kept"))).withColumn("p0", share(zero, F.col("total"), F.col("kept"))), "groups")

    told = by_shard(kept.drop("head").join(groups.drop("p0"), ["lang", "source"])).sortWithinPartitions("lang", "term")
    parts = materialize(map_rows(told, runs(AUDIT.format(most=int(most_terms)), run_rows), PARTS), "parts")

    # terms that a source holds, against the p of a source that doesn't: by count, as many terms share one
    side = lambda a: groups.select("lang", F.col("source").alias(a), F.col("p0").alias(f"p0_{a}"))
    by_count = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("m")).join(groups, ["lang", "source"])
    by_count = by_count.select("lang", F.col("source").alias("s"), "m", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"), F.col("p0").alias("p0_s"))
    alone = by_count.join(side("t"), "lang").where("s <> t").groupBy("lang", "s", "t").agg(F.sum(F.col("m") * (F.abs(F.col("p") - F.col("p0_t")) - F.abs(F.col("p0_s") - F.col("p0_t")))).alias("f"))
    both = parts.where("part = 'pair'").select("lang", F.col("source").alias("s"), F.col("item").alias("t"), F.col("value").alias("f"))
    turned = lambda t: t.union(t.select("lang", F.col("t").alias("s"), F.col("s").alias("t"), "f"))
    sums = turned(alone.unionByName(both)).groupBy("lang", "s", "t").agg(F.sum("f").alias("f"))
    pairs = groups.select("lang", "kept", F.col("source").alias("s"), F.col("p0").alias("p0_s")).join(side("t"), "lang").where("s <> t")
    none = F.coalesce(F.col("kept") * F.abs(F.col("p0_s") - F.col("p0_t")), zero)
    pairs = pairs.join(sums, ["lang", "s", "t"], "left").select("lang", F.col("s").alias("source"), F.lit("pair").alias("part"), F.col("t").alias("item"), (none + F.coalesce("f", zero)).cast("long").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = parts.where("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_terms)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms)

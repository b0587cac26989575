"""The thin queries of the operators for training text, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import band_join, decontaminate, divergence, embedding_dedup, html_extract, language_id, license_scan, line_dedup, mixing, quality, secrets, simhash, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"), min_words=50)
    size = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_words", size("spans").alias("n_repeated"), size("later").alias("n_later"), line("spans").alias("spans"), line("later").alias("later"))


OP1_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x09-\x0D\x20]+') AS w FROM documents),
g AS (SELECT doc_id, len(w) AS n, unnest(range(0, len(w) - 49)) AS i, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, n, i, md5(array_to_string(w[i + 1:i + 50], ' ')) AS win FROM g),
f AS (SELECT doc_id, n, i, count(*) OVER (PARTITION BY win) AS c, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM h),
x AS (SELECT doc_id, n, k, bool_or(r > 1) AS later FROM (SELECT doc_id, n, r, unnest(range(i, i + 50)) AS k FROM f WHERE c > 1) GROUP BY doc_id, n, k),
y AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS a, CASE WHEN later THEN k - row_number() OVER (PARTITION BY doc_id, later ORDER BY k) END AS b FROM x),
p AS (SELECT doc_id, string_agg(s || '-' || e, ',' ORDER BY s) AS spans FROM (SELECT doc_id, min(k) AS s, max(k) + 1 AS e FROM y GROUP BY doc_id, a) GROUP BY doc_id),
q AS (SELECT doc_id, string_agg(s || '-' || e, ',' ORDER BY s) AS later FROM (SELECT doc_id, min(k) AS s, max(k) + 1 AS e FROM y WHERE later GROUP BY doc_id, b) GROUP BY doc_id),
t AS (SELECT doc_id, n::INTEGER AS n_words, count(*) AS n_repeated, count(*) FILTER (later) AS n_later FROM x GROUP BY doc_id, n)
SELECT t.*, spans, coalesce(q.later, '') AS later FROM t JOIN p USING (doc_id) LEFT JOIN q USING (doc_id)
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n FROM s),
l AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, l WHERE len(w) >= n),
h AS (SELECT doc_id, i, g.n, item_id FROM g JOIN p ON g.n = p.n AND array_to_string(w[i:i + g.n - 1], ' ') = p.win),
k AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM h) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents.where(~language_id.held_out("doc_id")))
    found = language_id.predict(documents, model)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.counts(secrets.scan(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=50)
    n = F.size("deleted_lines")
    return found.select("doc_id", n.cast("long").alias("n_deleted"), F.array_join(F.col("deleted_lines").cast("array<string>"), ",").alias("deleted"), F.md5("text").alias("text_md5"))


OP5_SQL = r"""
WITH u AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, i, line, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS c, length(line) + 1 AS k FROM u),
p AS (SELECT a.doc_id, a.i, b.i AS j FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.i < a.i + 50 AND b.c - a.c + a.k >= 50),
w AS (SELECT doc_id, i, min(j) AS j FROM p GROUP BY doc_id, i UNION SELECT doc_id, max(i), j FROM p GROUP BY doc_id, j),
t AS (SELECT w.doc_id, w.i, w.j, string_agg(l.line, chr(10) ORDER BY l.i) AS block FROM w JOIN l ON l.doc_id = w.doc_id AND l.i BETWEEN w.i AND w.j GROUP BY w.doc_id, w.i, w.j),
f AS (SELECT *, row_number() OVER (PARTITION BY block, j - i ORDER BY doc_id, i) AS r FROM t),
g AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, unnest(range(i, j + 1)) AS x FROM f WHERE r > 1)),
n AS (SELECT doc_id, count(*) AS n_deleted, string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) AS deleted FROM g GROUP BY doc_id),
k AS (SELECT u.doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.x = u.i WHERE g.x IS NULL GROUP BY u.doc_id)
SELECT d.doc_id, coalesce(n_deleted, 0) AS n_deleted, coalesce(deleted, '') AS deleted, CASE WHEN d.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS text_md5
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), seed=17)


OP9_SQL = r"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, CAST(1 AS DOUBLE) / (SELECT CAST(count(*) AS DOUBLE) FROM s) * (SELECT CAST(sum(n) AS DOUBLE) FROM s) / n AS rate FROM s),
q AS (SELECT source, CAST(ceil(rate / 16) AS INTEGER) AS pieces, rate / ceil(rate / 16) AS m FROM r),
c AS (SELECT source, m, 0 AS k, exp(-m) AS p, exp(-m) AS cdf FROM q UNION ALL SELECT source, m, k + 1, p * m / (k + 1), cdf + p * m / (k + 1) FROM c WHERE k < 99),
u AS (SELECT doc_id, source, ('0x' || substr(md5('17|' || doc_id || '|' || j), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM (SELECT doc_id, d.source, unnest(range(1, pieces + 1)) AS j FROM documents d JOIN q ON d.source IS NOT DISTINCT FROM q.source)),
n AS (SELECT doc_id, sum(x) AS n FROM (SELECT doc_id, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND cdf <= u) AS x FROM u) GROUP BY doc_id),
e AS (SELECT doc_id, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INTEGER) AS copy FROM n)
SELECT d.*, e.copy, ('0x' || substr(md5('17|' || d.doc_id || '|' || e.copy || '|order'), 1, 15))::BIGINT AS shuffle_key FROM documents d JOIN e USING (doc_id)
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.weights(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings),
u AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(x, lambda e: e <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x)) / sqrt(list_dot_product(b.x, b.x)) >= 0.9),
r AS (SELECT vec_id AS s, vec_id AS t FROM v UNION SELECT r.s, e.b FROM r JOIN e ON r.t = e.a),
c AS (SELECT s AS vec_id, min(t) AS component_id FROM r GROUP BY s), n AS (SELECT a AS vec_id, count(*) AS n_links FROM e GROUP BY a)
SELECT c.vec_id, coalesce(n_links, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op12_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, items = table(spark, sf_dir, "sale_lines"), table(spark, sf_dir, "items")
    points = lines.select("sale_id", "line_no", "item_id", band_join.unit_cents(band_join.cents(F.col("amount")), F.col("quantity")).alias("u"))
    return band_join.band_join(points, items.select("item_id", band_join.cents(F.col("price")).alias("p")), k=5, least=10, per_mille=2)


# crc32 by its table of 256 remainders, a code point at a time
OP12_SQL = """
WITH a AS (SELECT sale_id, line_no, item_id, CAST(quantity AS BIGINT) AS q, CASE WHEN isfinite(amount) THEN CAST(floor(100 * amount + 0.5) AS BIGINT) END AS a FROM sale_lines),
b AS (SELECT sale_id, line_no, item_id, CASE WHEN q < 0 THEN -(2 * a + q) ELSE 2 * a + q END AS x, 2 * abs(q) AS y FROM a WHERE sale_id IS NOT NULL AND item_id IS NOT NULL AND q <> 0 AND a IS NOT NULL),
t AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
l AS (SELECT sale_id, line_no, item_id, (x - ((x % y) + y) % y) // y AS u, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(sale_id || ',' || coalesce(CAST(line_no AS VARCHAR), '') || ',' || item_id, ''), lambda h: CAST(ascii(h) AS BIGINT))), lambda c, d: xor(c >> 8, tab[xor(c & 255, d) + 1])), 4294967295) AS crc FROM b, t),
i AS (SELECT row_number() OVER () AS k, item_id, CASE WHEN isfinite(price) THEN CAST(floor(100 * price + 0.5) AS BIGINT) END AS p FROM items),
w AS (SELECT *, p - greatest(10, p * 2 // 1000) AS lo, p + greatest(10, p * 2 // 1000) AS hi FROM i),
j AS (SELECT k, abs(u - p) AS gap, u, sale_id, line_no, l.item_id AS line_item_id, crc FROM w JOIN l ON u >= lo AND u <= hi WHERE l.item_id <> w.item_id),
s AS (SELECT k, count(*) AS n_pairs, CAST(sum(gap) AS BIGINT) AS gap_sum, CAST(sum(crc) AS BIGINT) AS lines_crc FROM j GROUP BY k),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY k ORDER BY gap, u, sale_id, line_no NULLS FIRST, line_item_id) AS INTEGER) AS rank FROM j)
SELECT i.item_id, coalesce(rank, 0) AS rank, gap, u, sale_id, CAST(line_no AS BIGINT) AS line_no, line_item_id, coalesce(n_pairs, 0) AS n_pairs, coalesce(gap_sum, 0) AS gap_sum, coalesce(lines_crc, 0) AS lines_crc
FROM i LEFT JOIN s USING (k) LEFT JOIN (SELECT * FROM r WHERE rank <= 5) USING (k)
"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, most_terms=50)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, source, w.term),
t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (coalesce(t.total, 0) + 5 * v.v) AS p, 1 + CAST(1000000000 AS HUGEINT) * (k.n + 5) // (v.total + 5 * v.v) AS q
  FROM g JOIN k ON g.lang = k.lang JOIN v ON v.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_secrets": op4_secrets,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_html_extract": op10_html_extract,
    "op11_license_scan": op11_license_scan,
    "op12_band_join": op12_band_join,
    "op13_divergence": op13_divergence,
}
ORACLE: dict[str, str] = {"op1_suffix_dedup": OP1_SQL, "op7_embedding_dedup": OP7_SQL, "op2_decontaminate": OP2_SQL, "op5_line_dedup": OP5_SQL, "op9_mixing": OP9_SQL, "op12_band_join": OP12_SQL, "op13_divergence": OP13_SQL}

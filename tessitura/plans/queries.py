"""The query catalogue over the driver's tables, and the same in DuckDB SQL.

There is no audio in those tables. Segments are events
(recording = user, speaker = type, start = whole seconds since 2024-01-01 / 5000, end =
start + value / 10), lines are events again (9 s before, at or after their start, by their
id modulo 3; every tenth stands twice) or turns of conversations (7.5 s apart),
languages are the documents' own, vectors are embeddings with their label as recording.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..functions import formatting as fmt
from ..functions import language, metrics, signal, vectors
from ..operators import clustering, frames, intervals, lines, nearest
from ..sources import inputs, schemas
from ..sources import models as model_roles
from ..storage import shared_folder
from . import diarize, job, run
from .validate import DEFAULT_CANDIDATES, validated

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _start() -> F.Column:
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)").cast("double") / F.lit(5000.0)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.select(F.col("user_id").alias("recording_id"), F.col("event_id").alias("seg_idx"), F.col("event_type").alias("speaker"), _start().alias("start"), (_start() + F.col("value") / 10).alias("end"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = table(spark, sf_dir, "events").withColumn("copy", F.explode(times))
    return rows.select(F.col("user_id").alias("recording_id"), F.col("event_id").alias("line_idx"), (_start() + (F.col("event_id") % 3 - 1) * 9).alias("t"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("recording_id"), F.col("turn").alias("line_idx"), (F.col("turn") * 7.5).alias("t"), fmt.strip(F.col("text")).alias("text"))


START = "floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01')) / 5000.0"
SEG = f"s AS (SELECT user_id AS recording_id, event_id AS seg_idx, event_type AS speaker, {START} AS b, {START} + value / 10 AS e FROM events)"
LINES = f"l AS (SELECT user_id AS recording_id, event_id AS line_idx, {START} + (event_id % 3 - 1) * 9 AS t, event_id * 2 + copy AS rid FROM (SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM events))"
TURNS = r"l AS (SELECT conv_id AS recording_id, turn AS line_idx, turn * 7.5::DOUBLE AS t, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text, conv_id || '/' || turn AS rid FROM conversations)"
ALIGNED = """c AS (SELECT l.*, s.speaker, row_number() OVER (PARTITION BY l.recording_id, l.rid ORDER BY CASE WHEN t BETWEEN b AND e THEN 0 ELSE 1 END, CASE WHEN t BETWEEN b AND e THEN 0 ELSE least(abs(t - b), abs(t - e)) END, b, seg_idx) AS r
 FROM l LEFT JOIN s ON l.recording_id = s.recording_id AND ({fits})),
a AS (SELECT * EXCLUDE (r, speaker), coalesce(speaker, '[unknown]') AS speaker FROM c WHERE r = 1)"""
INSIDE, NEAR = "t BETWEEN b AND e", "least(abs(t - b), abs(t - e)) < 5"
HMS = "printf('[%02d:%02d:%02d]', CAST(trunc(t) AS BIGINT) // 3600, CAST(trunc(t) AS BIGINT) % 3600 // 60, CAST(trunc(t) AS BIGINT) % 60)"

# --- formats ---


@query(f"SELECT event_id, {HMS} AS hms FROM (SELECT event_id, value * 1000 AS t FROM events)")
def hms_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", fmt.seconds_to_hms(F.col("value") * 1000).alias("hms"))


@query("SELECT c_custkey, printf('speaker_%02d', c_custkey % 150) AS speaker FROM customer")
def speaker_label(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", fmt.speaker_label(F.col("c_custkey") % 150).alias("speaker"))


@query("SELECT p_partkey, replace(p_brand || '.' || p_name || '.en', '.', '_') AS model_key FROM part")
def model_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", fmt.model_key(F.concat("p_brand", F.lit("."), "p_name", F.lit(".en"))).alias("model_key"))


@query(r"""WITH p AS (SELECT page_id, string_split(rtrim(string_split(url || x, '?')[1], '/'), '/')[-1] AS last FROM (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/a.tar.gz?v=1.y' ELSE '/b.mp3/' END AS x FROM pages))
SELECT page_id, CASE WHEN contains(last, '.') THEN string_split(last, '.')[-1] ELSE 'opus' END AS ext FROM p""")
def url_ext(spark, sf_dir):
    more = F.when(F.col("page_id") % 3 == 0, "").when(F.col("page_id") % 3 == 1, "/a.tar.gz?v=1.y").otherwise("/b.mp3/")
    return table(spark, sf_dir, "pages").select("page_id", fmt.url_extension(F.concat("url", more), F.lit("opus")).alias("ext"))


@query("SELECT c_custkey, 'file ''' || replace(c_name || '''s.wav', '''', '''\\''''') || '''' AS entry FROM customer")
def concat_escape(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", fmt.concat_entry(F.concat("c_name", F.lit("'s.wav"))).alias("entry"))


@query("""SELECT n_nationkey, unnest(['NAME_transcript_base.en.txt', 'NAME_labeled_base.en.txt', 'NAME_segment_metadata_base.en.json', 'NAME_language_flags_base.en.json', 'NAME_transcript_small.en.txt', 'NAME_labeled_small.en.txt', 'NAME_segment_metadata_small.en.json', 'NAME_language_flags_small.en.json', 'NAME_diarization.json', 'NAME_run_summary.json'].list_transform(lambda x: replace(x, 'NAME', n_name))) AS filename FROM nation""")
def artifact_names(spark, sf_dir):
    names = fmt.artifact_names(F.col("n_name"), F.array(F.lit("base.en"), F.lit("small.en")))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(names).alias("filename"))


# --- documents ---


@query(f"WITH {TURNS} SELECT recording_id, count(*) AS transcript_lines, md5(string_agg({HMS} || '  ' || text, chr(10) ORDER BY line_idx)) AS transcript_md5 FROM l GROUP BY recording_id")
def transcript_doc(spark, sf_dir):
    rows = job.stamped(turns(spark, sf_dir))
    text = lines.ordered_join("line_idx", fmt.transcript_line(F.col("timestamp_str"), F.col("text")))
    return rows.groupBy("recording_id").agg(F.count(F.lit(1)).alias("transcript_lines"), F.md5(text).alias("transcript_md5"))


@query(f"WITH {SEG}, {TURNS}, {ALIGNED.format(fits=f'{INSIDE} OR {NEAR}')} SELECT recording_id, count(*)::INTEGER AS transcript_lines, md5(string_agg({HMS} || '  ' || text, chr(10) ORDER BY line_idx)) AS transcript_md5, md5(string_agg({HMS} || ' ' || speaker || ': ' || text, chr(10) ORDER BY line_idx)) AS labeled_md5 FROM a GROUP BY recording_id")
def labeled_doc(spark, sf_dir):
    docs = job.documents(job.labeled(turns(spark, sf_dir), segments(spark, sf_dir)), ("recording_id",))
    return docs.select("recording_id", "transcript_lines", F.md5("transcript").alias("transcript_md5"), F.md5("labeled_transcript").alias("labeled_md5"))


@query(f"WITH {SEG}, {TURNS}, {ALIGNED.format(fits=f'{INSIDE} OR {NEAR}')}, m AS (SELECT unnest(['base.en', 'small.en']) AS model) SELECT recording_id, model, count(*)::INTEGER AS transcript_lines, md5(string_agg({HMS} || ' ' || speaker || ': ' || text, chr(10) ORDER BY line_idx)) AS labeled_md5 FROM a, m GROUP BY recording_id, model")
def response(spark, sf_dir):
    rows = job.fan_out(turns(spark, sf_dir), ["base.en", "small.en"])
    docs = job.documents(job.labeled(rows, segments(spark, sf_dir)))
    jobs = docs.select("recording_id").distinct()
    return job.response(jobs, docs).select("recording_id", F.explode("models").alias("model", "v")).select("recording_id", "model", "v.transcript_lines", F.md5("v.labeled_transcript").alias("labeled_md5"))


@query(f"WITH {TURNS}, t AS (SELECT recording_id, string_agg({HMS} || '  ' || text, chr(10) ORDER BY line_idx) AS c FROM l GROUP BY recording_id) SELECT recording_id, recording_id || '_transcript_base.en.txt' AS filename, CASE WHEN c = '' THEN '(empty)' ELSE md5(c) END AS content_md5 FROM t UNION ALL SELECT DISTINCT recording_id, recording_id || '_run_summary.json', md5('(empty)') FROM l")
def artifacts(spark, sf_dir):
    rows = job.stamped(turns(spark, sf_dir)).withColumn("labeled", F.lit("")).withColumn("model", F.lit("base.en"))
    docs = job.documents(rows)
    blank = docs.select("recording_id", F.lit("").alias("content"))
    made = job.artifacts(docs, blank, blank)
    return made.where("filename LIKE '%transcript%' OR filename LIKE '%run_summary%'").select("recording_id", "filename", F.md5("content").alias("content_md5"))


# --- intervals ---


@query(f"WITH {SEG} SELECT recording_id, seg_idx, b AS start, e AS \"end\" FROM s WHERE e - b >= 4")
def segments_min_on(spark, sf_dir):
    return intervals.min_duration(segments(spark, sf_dir), "start", "end", 4.0).select("recording_id", "seg_idx", "start", "end")


@query(f"""WITH {SEG}, n AS (SELECT *, CASE WHEN speaker = lag(speaker) OVER w AND b - lag(e) OVER w < 0.5 THEN 0 ELSE 1 END AS brk FROM s WINDOW w AS (PARTITION BY recording_id ORDER BY b, seg_idx)),
i AS (SELECT *, sum(brk) OVER (PARTITION BY recording_id ORDER BY b, seg_idx ROWS UNBOUNDED PRECEDING) AS island FROM n)
SELECT recording_id, CAST(island AS BIGINT) AS island, min(b) AS start, arg_max(e, (b, seg_idx)) AS "end", min(speaker) AS speaker FROM i GROUP BY recording_id, island""")
def segments_gap_merge(spark, sf_dir):
    return intervals.merge_gaps(segments(spark, sf_dir))


@query(f"WITH {SEG} SELECT recording_id, count(DISTINCT speaker) AS num_speakers, count(*) AS num_segments FROM s GROUP BY recording_id")
def segment_counts(spark, sf_dir):
    return intervals.speaker_counts(segments(spark, sf_dir))


@query(f"WITH {SEG} SELECT recording_id, seg_idx, b AS start, least(e, 300) AS \"end\" FROM s WHERE least(e, 300) > b")
def clip_intervals(spark, sf_dir):
    return intervals.clip(segments(spark, sf_dir), F.lit(300.0), "start", "end").select("recording_id", "seg_idx", "start", "end")


@query("""WITH r AS (SELECT s_suppkey AS recording_id, s_suppkey * 7000001 AS n FROM supplier), c AS (SELECT recording_id, n, unnest(range(0, CAST(ceil(n / 40000000) AS BIGINT))) AS chunk_idx FROM r)
SELECT recording_id, chunk_idx, chunk_idx * 40000000 AS first_sample, least(40000000, n - chunk_idx * 40000000) AS n_samples, chunk_idx * 2500::DOUBLE AS offset_s FROM c""")
def fixed_chunk_offsets(spark, sf_dir):
    return intervals.fixed_chunks(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("recording_id"), (F.col("s_suppkey") * 7_000_001).alias("n_samples")))


@query("SELECT o_custkey AS recording_id, o_orderkey AS file_idx, floor(o_totalprice) AS duration_s, coalesce(sum(floor(o_totalprice)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS offset_s FROM orders")
def file_timeline(spark, sf_dir):
    return intervals.file_timeline(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("recording_id"), F.col("o_orderkey").alias("file_idx"), F.floor("o_totalprice").cast("double").alias("duration_s")))


CHUNKED = f"g AS (SELECT user_id AS recording_id, CAST(floor({START} / 100) AS BIGINT) AS chunk_idx, event_id % 4 AS speaker_id, floor({START} * 4) / 4 AS b, value AS v FROM events), n AS (SELECT recording_id, chunk_idx, count(DISTINCT speaker_id) AS speakers FROM g GROUP BY recording_id, chunk_idx), o AS (SELECT *, CAST(coalesce(sum(speakers) OVER (PARTITION BY recording_id ORDER BY chunk_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS id_offset FROM n)"


def _chunked(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("recording_id"), F.floor(_start() / 100).alias("chunk_idx"), (F.col("event_id") % 4).alias("speaker_id"), (F.floor(_start() * 4) / 4).alias("start"), F.col("value").alias("end"))
    return rows


@query(f"WITH {CHUNKED} SELECT * FROM o")
def chunk_id_offsets(spark, sf_dir):
    return intervals.chunk_id_offsets(_chunked(spark, sf_dir))


@query(f"WITH {CHUNKED} SELECT g.recording_id, g.chunk_idx, round(b + g.chunk_idx * 2500, 2) AS start, printf('speaker_%02d', speaker_id + id_offset) AS speaker FROM g JOIN o ON g.recording_id = o.recording_id AND g.chunk_idx = o.chunk_idx")
def fixed_chunk_speakers(spark, sf_dir):
    return diarize.fixed_chunks(_chunked(spark, sf_dir)).select("recording_id", "chunk_idx", F.round("start", 2).alias("start"), "speaker")


@query(f"WITH {SEG}, {LINES}, {ALIGNED.format(fits=INSIDE)} SELECT recording_id, line_idx, t, speaker FROM a")
def align_contains(spark, sf_dir):
    return intervals.align(event_lines(spark, sf_dir), segments(spark, sf_dir), mode="contains")


@query(f"WITH {SEG}, {LINES}, {ALIGNED.format(fits=f'NOT ({INSIDE}) AND {NEAR}')} SELECT recording_id, line_idx, t, speaker FROM a")
def align_nearest(spark, sf_dir):
    return intervals.align(event_lines(spark, sf_dir), segments(spark, sf_dir), mode="nearest")


@query(f"WITH {SEG}, {LINES}, {ALIGNED.format(fits=f'{INSIDE} OR {NEAR}')} SELECT recording_id, line_idx, t, speaker FROM a")
def align_labeled(spark, sf_dir):
    return intervals.align(event_lines(spark, sf_dir), segments(spark, sf_dir))


@query(f"WITH {LINES}, r AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY t, line_idx) AS k FROM l WHERE t < 30) SELECT recording_id, line_idx, t FROM r WHERE k = 1")
def detection_head(spark, sf_dir):
    return intervals.head(event_lines(spark, sf_dir))


@query(f"WITH {SEG} SELECT recording_id, seg_idx, floor(b) + 2500 AS start, floor(e) + 2500 AS \"end\", printf('speaker_%02d', seg_idx % 5 + 7) AS speaker FROM s")
def library_segments(spark, sf_dir):
    rows = segments(spark, sf_dir).select("recording_id", F.col("seg_idx").alias("seq"), F.floor("start").cast("double").alias("start_s"), F.floor("end").cast("double").alias("end_s"), (F.col("seg_idx") % 5).alias("speaker_id"))
    return model_roles.library_segments(rows, 2500.0, 7)


# --- frames and samples ---


@query("""WITH r AS (SELECT s_suppkey AS recording_id, s_suppkey * 123457 AS n FROM supplier WHERE s_suppkey > 0), c AS (SELECT recording_id, n, unnest(range(0, CASE WHEN n <= 160000 THEN 1 ELSE 1 + CAST(ceil((n - 160000) / 120000) AS BIGINT) END)) AS window_idx FROM r)
SELECT recording_id, window_idx, window_idx * 120000 AS first_sample, least(160000, n - window_idx * 120000) AS n_samples, 160000 - least(160000, n - window_idx * 120000) AS pad FROM c""")
def window_grid(spark, sf_dir):
    return frames.window_grid(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("recording_id"), (F.col("s_suppkey") * 123_457).alias("n_samples")), shift=120_000)


@query("""WITH m AS (SELECT * FROM (VALUES (0, ''), (1, '0'), (2, '1'), (3, '2'), (4, '0,1'), (5, '0,2'), (6, '1,2')) AS t(class, speakers))
SELECT event_id, class, speakers FROM (SELECT event_id, CAST(user_id % 8 AS INTEGER) AS class FROM events) JOIN m USING (class)""")
def powerset_map(spark, sf_dir):
    """The speakers of each event's class; class 7 is beyond the powerset."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 8).cast("int").alias("class"))
    return rows.join(F.broadcast(frames.powerset_table(spark)), "class").select("event_id", "class", F.array_join(F.col("speakers").cast("array<string>"), ",").alias("speakers"))  # seven rows


@query("""WITH f AS (SELECT event_id // 1000 AS recording_id, event_id % 1000 // 10 AS window_idx, CAST(event_id % 10 AS INTEGER) AS frame_idx, user_id % 8 AS class, 15987655 AS n FROM events),
p AS (SELECT * FROM (VALUES (1, 0), (2, 1), (3, 2), (4, 0), (4, 1), (5, 0), (5, 2), (6, 1), (6, 2)) AS t(class, local)),
a AS (SELECT recording_id, window_idx, frame_idx, local, n, frame_idx - row_number() OVER (PARTITION BY recording_id, window_idx, local ORDER BY frame_idx) AS run FROM f JOIN p USING (class)),
r AS (SELECT recording_id, window_idx, local, n, min(frame_idx) AS fs, max(frame_idx) + 1 AS fe FROM a GROUP BY recording_id, window_idx, local, n, run)
SELECT recording_id, window_idx, local, window_idx * 10 + fs * 1.0::DOUBLE AS start_s, least(window_idx * 10 + fe * 1.0::DOUBLE, n / 16000) AS end_s, window_idx * 3 + local AS local_speaker_id FROM r WHERE least(window_idx * 10 + fe * 1.0::DOUBLE, n / 16000) > window_idx * 10 + fs""")
def frame_runs(spark, sf_dir):
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.floor(e / 1000).alias("recording_id"), F.floor((e % 1000) / 10).alias("window_idx"), (e % 10).cast("int").alias("frame_idx"), (F.col("user_id") % 8).cast("int").alias("class"), F.lit(15_987_655).alias("n_samples"))
    return frames.activity(rows, frames_per_window=10)


@query("SELECT vec_id, len(x) AS n, 64 - len(x) AS padded, CASE WHEN len(x) > 0 THEN round(x[1]::DOUBLE, 6) END AS first, round(coalesce(list_sum(list_transform(x, lambda v: v::DOUBLE)), 0), 6) AS total FROM (SELECT vec_id, embedding[CAST(vec_id % 9 AS BIGINT) + 1 : least(64, CAST(vec_id % 9 AS BIGINT) + CAST(vec_id % 70 AS BIGINT))] AS x FROM embeddings)")
def slice_pad(spark, sf_dir):
    start = (F.col("vec_id") % 9) / 16.0
    rows = table(spark, sf_dir, "embeddings").select("vec_id", frames.slice_samples(F.col("embedding"), start, start + (F.col("vec_id") % 70) / 16.0, 16).alias("x"))
    total = F.aggregate(frames.pad(F.col("x"), 64), F.lit(0.0), lambda s, v: s + v.cast("double"))
    return rows.select("vec_id", F.size("x").cast("long").alias("n"), (F.size(frames.pad(F.col("x"), 64)) - F.size("x")).cast("long").alias("padded"), F.round(F.try_element_at("x", F.lit(1)).cast("double"), 6).alias("first"), F.round(total, 6).alias("total"))


@query("SELECT CAST(p_partkey AS BIGINT) AS p_partkey, round(2595 * log10(1 + p_retailprice / 700), 6) AS mel, round(700 * (pow(10, p_size / 2595) - 1), 6) AS hz FROM part")
def mel_scale(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(signal.hz_to_mel(F.col("p_retailprice")), 6).alias("mel"), F.round(signal.mel_to_hz(F.col("p_size").cast("double")), 6).alias("hz"))


@query("""WITH p AS (SELECT i, 700 * (pow(10, (m0 + (m1 - m0) * i / 81) / 2595) - 1) AS hz FROM (SELECT unnest(range(82)) AS i, 2595 * log10(1 + 20.0::DOUBLE / 700) AS m0, 2595 * log10(1 + 8000.0::DOUBLE / 700) AS m1)),
n AS (SELECT i, CAST(round(hz / 31.25) AS INTEGER) AS at FROM p), t AS (SELECT a.i AS mel, a.at AS a, b.at AS b, c.at AS c FROM n a JOIN n b ON b.i = a.i + 1 JOIN n c ON c.i = a.i + 2),
w AS (SELECT mel, k, greatest(CASE WHEN a < b AND k BETWEEN a AND b THEN (k - a) / (b - a) ELSE 0 END, CASE WHEN b < c AND k BETWEEN b AND c THEN (c - k) / (c - b) ELSE 0 END) AS weight FROM t, (SELECT unnest(range(257)) AS k))
SELECT p_partkey, CAST(mel AS INTEGER) AS mel, CAST(k AS INTEGER) AS bin, round(weight::DOUBLE, 5) AS weight FROM w JOIN part ON k = p_partkey % 257 WHERE weight > 0""")
def mel_bank(spark, sf_dir):
    """The filters that hold each part's bin."""
    bank = signal.filterbank()
    at = np.argwhere(bank > 0)
    sides = spark.createDataFrame([(int(m), int(k), round(float(bank[m, k]), 5)) for m, k in at], "mel int, bin int, weight double")
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 257).cast("int").alias("bin"))
    return rows.join(F.broadcast(sides), "bin").select("p_partkey", "mel", "bin", "weight")  # at most two filters a bin


# a discrete Fourier transform as a join of frames with a table of cosines; 1,600 samples a second: frames of 40, every 16, 64 bins, 8 filters
@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings),
f AS (SELECT vec_id, f, x[f * 16 + 1 : f * 16 + 40] AS y FROM (SELECT vec_id, x, unnest(range(0, CASE WHEN len(x) >= 40 THEN 1 + (len(x) - 40) // 16 ELSE 0 END)) AS f FROM v)),
d AS (SELECT vec_id, f, list_transform(y, lambda e: e - list_avg(y)) AS d FROM f),
s AS (SELECT vec_id, f, i, (d[i + 1] - 0.97::DOUBLE * d[greatest(i, 1)]) * (0.5::DOUBLE - 0.5::DOUBLE * cos(2 * pi() * i / 39)) AS e FROM (SELECT *, unnest(range(0, 40)) AS i FROM d)),
t AS (SELECT k, i, cos(2 * pi() * k * i / 64) AS c, sin(2 * pi() * k * i / 64) AS z FROM (SELECT unnest(range(0, 32)) AS k), (SELECT unnest(range(0, 40)) AS i)),
p AS (SELECT vec_id, f, k, pow(sum(e * c), 2) + pow(sum(e * z), 2) AS power FROM s JOIN t USING (i) GROUP BY vec_id, f, k),
b AS (SELECT m, lo + (hi - lo) * m / 9 AS l, lo + (hi - lo) * (m + 1) / 9 AS c, lo + (hi - lo) * (m + 2) / 9 AS r FROM (SELECT unnest(range(0, 8)) AS m, 1127 * ln(1 + 20 / 700::DOUBLE) AS lo, 1127 * ln(1 + 800 / 700::DOUBLE) AS hi)),
w AS (SELECT m, k, CASE WHEN q > l AND q < r THEN least((q - l) / (c - l), (r - q) / (r - c)) ELSE 0 END AS weight FROM b, (SELECT unnest(range(0, 32)) AS k, 1127 * ln(1 + unnest(range(0, 32)) * 25 / 700::DOUBLE) AS q))
SELECT vec_id, CAST(f AS INTEGER) AS frame, CAST(m AS INTEGER) AS mel, round(ln(greatest(sum(power * weight), 1.1920928955078125e-07::DOUBLE)), 4) AS energy FROM p JOIN w USING (k) GROUP BY vec_id, f, m""")
def mel_energies(spark, sf_dir):
    found = table(spark, sf_dir, "embeddings").select("vec_id", signal.mel_energies_of(F.col("embedding"), 8, 1600).alias("m"))
    rows = found.select("vec_id", F.posexplode("m").alias("mel", "of")).select("vec_id", "mel", F.posexplode("of").alias("frame", "e"))
    return rows.select("vec_id", "frame", "mel", F.round("e", 4).alias("energy"))


@query()
def fbank(spark, sf_dir):
    samples = F.flatten(F.array_repeat("embedding", 20))
    found = table(spark, sf_dir, "embeddings").select("vec_id", signal.log_mel_features(samples).alias("f"))
    return found.select("vec_id", F.size("f").alias("n_mels"), F.size(F.col("f")[0]).alias("frames"), F.transform(F.flatten("f"), lambda v: F.round(v.cast("double"), 3)).alias("values"))


def _digest(values: F.Column) -> list[F.Column]:
    """Two numbers that depend on every value and its place."""
    add = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda t, v: t + v), 5)
    return [add(F.transform(values, lambda v, i: v * (i + 1))).alias("weighted"), add(F.transform(values, lambda v, i: v * v * v * F.pmod(i, F.lit(7)))).alias("cubes")]


DIGEST = "round(list_sum(list_transform({z}, lambda v, i: v * i)), 5) AS weighted, round(list_sum(list_transform({z}, lambda v, i: v * v * v * ((i - 1) % 7))), 5) AS cubes"


@query(f"WITH d AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings), z AS (SELECT vec_id, list_transform(x, lambda v: (v - list_avg(x)) / (list_stddev_pop(x) + 1e-9)) AS z FROM d) SELECT vec_id, len(z)::INTEGER AS n, {DIGEST.format(z='z')} FROM z")
def standardize(spark, sf_dir):
    out = table(spark, sf_dir, "embeddings").select("vec_id", signal.standardize(F.col("embedding")).alias("z"))
    return out.select("vec_id", F.size("z").alias("n"), *_digest(F.col("z")))


# --- vectors ---

UNIT = "u AS (SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"


def _unit(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("recording_id"), F.col("vec_id").alias("seq"), vectors.normalize(F.col("embedding")).alias("embedding"))


@query(f"WITH {UNIT}, z AS (SELECT vec_id, sqrt(list_dot_product(x, x)) AS norm, list_transform(x, lambda v: v / sqrt(list_dot_product(x, x))) AS z FROM u) SELECT vec_id, round(norm, 6) AS norm, {DIGEST.format(z='z')} FROM z")
def l2_normalize(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.norm(F.col("embedding")), 6).alias("norm"), vectors.normalize(F.col("embedding")).cast("array<double>").alias("z"))
    return rows.select("vec_id", "norm", *_digest(F.col("z")))


@query(f"WITH {UNIT}, n AS (SELECT sqrt(list_dot_product(x, x)) AS v FROM u) SELECT round(min(v), 5) AS min_norm, round(max(v), 5) AS max_norm, round(avg(v), 5) AS mean_norm, bool_and(abs(v - 1) <= 1e-5) AS unit FROM n")
def norm_check(spark, sf_dir):
    v = vectors.norm(F.col("embedding"))
    return table(spark, sf_dir, "embeddings").agg(F.round(F.min(v), 5).alias("min_norm"), F.round(F.max(v), 5).alias("max_norm"), F.round(F.avg(v), 5).alias("mean_norm"), F.bool_and(F.abs(v - 1) <= 1e-5).alias("unit"))


PAIRS = f"{UNIT}, q AS (SELECT a.label AS recording_id, a.vec_id AS i, b.vec_id AS j, list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x)) / sqrt(list_dot_product(b.x, b.x)) AS similarity FROM u a JOIN u b ON a.label = b.label AND a.vec_id < b.vec_id)"


@query(f"WITH {PAIRS} SELECT recording_id, i, j, round(similarity, 6) AS similarity FROM q")
def cosine_pairs(spark, sf_dir):
    return clustering.pairs(_unit(spark, sf_dir), digits=6)


@query(f"WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY similarity DESC, i, j) AS k FROM q) SELECT recording_id, i, j, round(similarity, 6) AS similarity FROM r WHERE k = 1")
def best_merge(spark, sf_dir):
    return nearest.best_pair(_unit(spark, sf_dir)).withColumn("similarity", F.round("similarity", 6))


@query()
def cluster_fixed_k(spark, sf_dir):
    return clustering.cluster(_unit(spark, sf_dir), num_clusters=3)


@query()
def cluster_threshold(spark, sf_dir):
    return clustering.cluster(_unit(spark, sf_dir), min_similarity=0.3)


@query("SELECT label AS recording_id, count(*) AS members, least(3, count(*)) AS clusters, least(3, count(*)) - 1 AS last_label, min(vec_id) AS first_of_zero FROM embeddings GROUP BY label")
def cluster_invariants(spark, sf_dir):
    found = clustering.cluster(_unit(spark, sf_dir), num_clusters=3)
    return found.groupBy("recording_id").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("cluster").alias("clusters"), F.max("cluster").cast("long").alias("last_label"), F.min(F.when(F.col("cluster") == 0, F.col("seq"))).alias("first_of_zero"))


@query("""WITH v AS (SELECT user_id % 40 AS recording_id, event_id AS seq, event_type FROM events WHERE user_id % 40 > 2 OR event_id % 9 = 0), f AS (SELECT recording_id, event_type, min(seq) AS first FROM v GROUP BY recording_id, event_type)
SELECT v.recording_id, seq, CAST(dense_rank() OVER (PARTITION BY v.recording_id ORDER BY first) - 1 AS INTEGER) AS cluster FROM v JOIN f ON v.recording_id = f.recording_id AND v.event_type = f.event_type""")
def cluster_planted(spark, sf_dir):
    """Each event speaks with its type's voice, a direction of its own, turned a little by its number: threshold clustering finds the types."""
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("recording_id"), F.col("event_id").alias("seq"), "event_type").where("recording_id > 2 OR seq % 9 = 0")
    kind = F.pmod(F.xxhash64("event_type"), F.lit(64)).cast("int")
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    voice = F.concat(zeros(kind), F.array(F.lit(1.0)), zeros(63 - kind), F.array(F.sin("seq") / 3))
    # a column of its own, so that normalizing does not make it again and again
    rows = rows.select("recording_id", "seq", voice.alias("voice"))
    return clustering.cluster_all(rows.select("recording_id", "seq", vectors.normalize(F.col("voice")).alias("embedding")), min_similarity=0.5)


@query("SELECT vec_id, label, dense_rank() OVER (ORDER BY label) - 1 AS cluster FROM embeddings")
def label_remap(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    # the representatives are few; ranking them apart keeps the rows out of one global window
    ranks = rows.select("label").distinct().withColumn("cluster", F.dense_rank().over(_by_label()) - 1)
    return rows.join(ranks, "label").select("vec_id", "label", F.col("cluster").cast("long").alias("cluster"))


def _by_label():
    from pyspark.sql import Window

    return Window.orderBy("label")


# --- languages ---


@query("""SELECT doc_id, CASE WHEN doc_id % 4 IN (0, 1, 2) THEN 'detect' ELSE 'forced' END AS mode, CASE WHEN doc_id % 4 IN (0, 1) THEN 'en|pt' WHEN doc_id % 4 = 2 THEN 'en|fr' ELSE '' END AS candidates, CASE WHEN doc_id % 4 = 3 THEN lang END AS forced FROM documents""")
def lang_route(spark, sf_dir):
    k = F.col("doc_id") % 4
    given = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "auto").when(k == 2, "en, fr").otherwise(F.col("lang"))
    r = language.route(given, F.array(*map(F.lit, DEFAULT_CANDIDATES)))
    return table(spark, sf_dir, "documents").select("doc_id", r.alias("r")).select("doc_id", "r.mode", F.array_join("r.candidates", "|").alias("candidates"), "r.forced")


@query("""WITH d AS (SELECT doc_id, lang, (doc_id % 100) / 100.0::DOUBLE AS p, CASE doc_id % 3 WHEN 0 THEN ['en', 'pt'] WHEN 1 THEN ['de'] ELSE ['fr', 'pt'] END AS c, doc_id % 11 = 0 AS failed FROM documents)
SELECT doc_id, CASE WHEN failed THEN 'en' WHEN p < 0.5 THEN 'en' WHEN list_contains(c, lang) THEN lang WHEN list_contains(c, 'pt') AND lang IN ('es', 'it', 'fr', 'ro', 'ca', 'gl') THEN 'pt' ELSE c[1] END AS language,
round(CASE WHEN failed THEN 0 WHEN p < 0.5 THEN p WHEN list_contains(c, lang) THEN p WHEN list_contains(c, 'pt') AND lang IN ('es', 'it', 'fr', 'ro', 'ca', 'gl') THEN p * 0.7::DOUBLE ELSE p * 0.5::DOUBLE END, 6) AS confidence FROM d""")
def lang_choice(spark, sf_dir):
    k = F.col("doc_id") % 3
    candidates = F.when(k == 0, F.array(F.lit("en"), F.lit("pt"))).when(k == 1, F.array(F.lit("de"))).otherwise(F.array(F.lit("fr"), F.lit("pt")))
    detected = F.when(F.col("doc_id") % 11 != 0, F.col("lang"))
    r = language.choose(detected, (F.col("doc_id") % 100) / F.lit(100.0), candidates, F.lit("en"))
    return table(spark, sf_dir, "documents").select("doc_id", r.alias("r")).select("doc_id", "r.language", F.round("r.confidence", 6).alias("confidence"))


def _lang_lines(spark, sf_dir):
    text = F.when(F.col("doc_id") % 17 == 0, F.lit("  ")).otherwise(F.col("text"))  # some blank
    return table(spark, sf_dir, "documents").select(F.col("source").alias("recording_id"), F.col("doc_id").alias("line_idx"), text.alias("text"), F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang"))


VOTES = r"""d AS (SELECT source AS recording_id, doc_id, CASE WHEN doc_id % 5 <> 0 THEN lang END AS lang, CASE WHEN doc_id % 17 = 0 THEN '' ELSE regexp_replace(text, '^\s+|\s+$', '', 'g') END AS t FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY recording_id) AS n FROM d WHERE t <> ''),
kl AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY doc_id) - 1 AS kk FROM d WHERE t <> '' AND lang IS NOT NULL),
h AS (SELECT recording_id, lang, count(*) AS c FROM kl WHERE kk < 50 GROUP BY recording_id, lang),
o AS (SELECT recording_id, arg_min(lang, (-c, lang)) AS overall_detected_language, round(max(c) / sum(c), 3) AS overall_confidence FROM h GROUP BY recording_id)"""


@query(f"WITH {VOTES} SELECT * FROM o")
def lang_head(spark, sf_dir):
    return lines.head_vote(_lang_lines(spark, sf_dir).where("lang IS NOT NULL"))


@query(f"""WITH {VOTES}, w AS (SELECT recording_id, lang, n, k, unnest(range(greatest(0, k // 10 - 1), k // 10 + 1)) AS window_idx FROM k),
e AS (SELECT recording_id, window_idx, any_value(n) AS n FROM w GROUP BY recording_id, window_idx),
v AS (SELECT recording_id, window_idx, lang, count(*) AS c FROM w WHERE lang IS NOT NULL GROUP BY recording_id, window_idx, lang),
b AS (SELECT recording_id, window_idx, arg_min(lang, (-c, lang)) AS lang, round(max(c) / sum(c), 3) AS confidence FROM v GROUP BY recording_id, window_idx)
SELECT e.recording_id, e.window_idx, (e.window_idx * 10)::INTEGER AS start_line, (least(e.window_idx * 10 + 20, n) - 1)::INTEGER AS end_line, coalesce(b.lang, overall_detected_language) AS detected_language, coalesce(confidence, 0) AS confidence, CASE WHEN coalesce(b.lang, overall_detected_language) <> overall_detected_language THEN 'POSSIBLE_LANGUAGE_MISMATCH' END AS flag, overall_detected_language, overall_confidence
FROM e LEFT JOIN b ON e.recording_id = b.recording_id AND e.window_idx = b.window_idx LEFT JOIN o ON e.recording_id = o.recording_id""")
def lang_windows(spark, sf_dir):
    return lines.language_flags(_lang_lines(spark, sf_dir))


@query(f"""WITH {VOTES}, r AS (SELECT DISTINCT recording_id FROM d UNION ALL SELECT 'silent' UNION ALL SELECT 'aimed') SELECT r.recording_id, 'base.en' AS model, CASE WHEN r.recording_id = 'aimed' THEN 'pt' ELSE coalesce(overall_detected_language, 'unknown') END AS overall_detected_language, coalesce(overall_confidence, 0) AS overall_confidence,
(CASE WHEN x.n > 0 THEN (x.n + 9) // 10 ELSE 0 END)::INTEGER AS windows FROM r LEFT JOIN o ON r.recording_id = o.recording_id LEFT JOIN (SELECT recording_id, max(n) AS n FROM k GROUP BY recording_id) x ON x.recording_id = r.recording_id""")
def flags_document(spark, sf_dir):
    rows = _lang_lines(spark, sf_dir)
    every = rows.select("recording_id", F.lit(None).cast("string").alias("target")).distinct().union(spark.createDataFrame([("silent", None), ("aimed", "pt")], "recording_id string, target string"))
    made = lines.flags_document(every, lines.language_flags(rows), "base.en")
    return made.select("recording_id", "model", "overall_detected_language", "overall_confidence", F.size("window_flags").alias("windows"))


@query("""SELECT l_orderkey AS recording_id, 'base.en' AS model, count(*)::INTEGER AS n, max(round(l_extendedprice / 7, 3)) AS last_start, max(CASE WHEN l_linenumber % 2 = 0 THEN round(l_tax / 3, 4) ELSE -1 END) AS top_temperature FROM lineitem GROUP BY l_orderkey""")
def segment_metadata(spark, sf_dir):
    k = F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("recording_id"), F.lit("base.en").alias("model"), F.lit("en").alias("detected_language"), F.lit(0.5).alias("language_probability"), k.alias("seg_idx"), (F.col("l_extendedprice") / 7).alias("start"), (F.col("l_extendedprice") / 6).alias("end"), F.lit(0.1).alias("no_speech_prob"), F.col("l_discount").alias("avg_logprob"), F.lit(1.5).alias("compression_ratio"), F.when(k % 2 == 0, F.col("l_tax") / 3).alias("temperature"), F.col("l_returnflag").alias("text"))
    parsed = F.from_json("content", "struct<model:string,segments:array<struct<start:double,temperature:double>>>")
    made = job.metadata_document(rows).select("recording_id", parsed.alias("p"))
    return made.select("recording_id", "p.model", F.size("p.segments").alias("n"), F.array_max(F.transform("p.segments", lambda x: x["start"])).alias("last_start"), F.array_max(F.transform("p.segments", lambda x: F.coalesce(x["temperature"], F.lit(-1.0)))).alias("top_temperature"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'en' END AS target, CASE WHEN doc_id % 3 = 2 AND lang <> 'en' THEN 'POSSIBLE_LANGUAGE_MISMATCH' END AS flag FROM documents")
def lang_target(spark, sf_dir):
    k = F.col("doc_id") % 3
    given = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "auto").otherwise("en")
    target = language.flag_target(given, F.lit("en"))
    return table(spark, sf_dir, "documents").select("doc_id", target.alias("target"), language.mismatch(F.col("lang"), target).alias("flag"))


@query("SELECT source AS recording_id, count(*) AS lines FROM documents WHERE doc_id % 17 <> 0 AND length(text) > 0 GROUP BY source")
def blank_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("recording_id"), F.when(F.col("doc_id") % 17 == 0, F.lit(" \t\n")).otherwise(F.col("text")).alias("text"))
    return rows.where(F.length(fmt.strip(F.col("text"))) > 0).groupBy("recording_id").agg(F.count(F.lit(1)).alias("lines"))


# --- metrics and jobs ---


@query("SELECT o_orderkey, round(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey / 16.0::DOUBLE END / (o_custkey + 1000), 4) AS rtf FROM orders")
def rtf(spark, sf_dir):
    stage = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") / 16.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", metrics.real_time_factor(stage, F.col("o_custkey") + 1000).alias("rtf"))


GPUS = ", ".join(f"('{n}', {p}::DOUBLE)" for n, p in metrics.PRICES)


@query(f"WITH g AS (SELECT * FROM (VALUES {GPUS}) AS t(gpu_name, usd)), p AS (SELECT p_partkey, (['NVIDIA GeForce RTX 4090', 'NVIDIA L4', 'NVIDIA H100', 'none', NULL])[CAST(p_partkey % 5 AS BIGINT) + 1] AS gpu_name, p_retailprice AS s FROM part) SELECT p_partkey, p.gpu_name, round(s / 3600 * usd, 4) AS cost_estimate_usd FROM p LEFT JOIN g ON p.gpu_name = g.gpu_name")
def cost(spark, sf_dir):
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, "NVIDIA GeForce RTX 4090").when(k == 1, "NVIDIA L4").when(k == 2, "NVIDIA H100").when(k == 3, "none")
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("gpu_name"), F.col("p_retailprice").alias("pipeline_s"))
    return metrics.with_cost(rows, metrics.price_table(spark)).select("p_partkey", "gpu_name", "cost_estimate_usd")


@query("SELECT s_suppkey, coalesce(nullif(CASE WHEN s_suppkey % 3 = 0 THEN 0 WHEN s_suppkey % 3 = 1 THEN s_acctbal END, 0), nullif(CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE s_suppkey END::DOUBLE, 0), 1)::DOUBLE AS duration_s FROM supplier")
def duration_fallback(spark, sf_dir):
    k = F.col("s_suppkey")
    probed = F.when(k % 3 == 0, 0.0).when(k % 3 == 1, F.col("s_acctbal"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", metrics.duration(probed, F.when(k % 2 == 0, 0.0).otherwise(k.cast("double"))).alias("duration_s"))


@query("SELECT n_name AS recording_id, model FROM nation, (SELECT unnest(['base.en', 'small.en', 'tiny.en']) AS model)")
def model_fanout(spark, sf_dir):
    return job.fan_out(table(spark, sf_dir, "nation").select(F.col("n_name").alias("recording_id")), ["base.en", "small.en", "tiny.en"])


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 3) AS start, round(l_discount / 3, 4) AS avg_logprob, CASE WHEN l_linenumber % 2 = 0 THEN round(l_tax / 3, 4) END AS temperature FROM lineitem")
def confidence_projection(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 3).alias("start"), F.round(F.col("l_discount") / 3, 4).alias("avg_logprob"), F.when(F.col("l_linenumber") % 2 == 0, F.round(F.col("l_tax") / 3, 4)).alias("temperature"))


def _jobs(spark, sf_dir):
    k = F.col("o_orderkey") % 8
    none = F.lit(None)
    strings = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    body = F.struct(
        F.when(k.isin(2, 4, 5), "https://host/a.opus").when(k == 3, "").alias("audio_url"), F.when(k.isin(1, 6, 7), strings("https://host/a.opus", "https://host/b.wav")).when(k == 2, strings()).alias("audio_urls"),
        none.cast("string").alias("ext"), none.cast("string").alias("language"), none.cast("array<string>").alias("language_candidates"), F.when(k == 5, "tiny.en").alias("model_size"), F.when(k == 6, strings()).when(k == 7, strings("base.en")).alias("model_sizes"),
        none.cast("double").alias("cluster_threshold"), none.cast("int").alias("num_speakers"), F.when(k.isin(4, 6), "x").when(k == 7, "fixed_chunk").alias("diarization_mode"), F.when(k == 7, F.col("o_orderpriority")).alias("recording_id"),
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(k != 0, body).alias("input"))


@query("""SELECT o_orderkey AS id, CASE WHEN k = 7 THEN o_orderpriority ELSE 'recording' END AS recording_id,
CASE WHEN k IN (1, 6, 7) THEN 2 WHEN k IN (2, 4, 5) THEN 1 ELSE 0 END AS n_urls, CASE k WHEN 5 THEN 'tiny.en' WHEN 6 THEN '' WHEN 7 THEN 'base.en' ELSE 'base.en,small.en' END AS models,
CASE WHEN k IN (4, 6) THEN 'x' WHEN k = 7 THEN 'fixed_chunk' ELSE 'whole_day' END AS mode,
CASE k WHEN 0 THEN 'Event must contain ''input'' field.' WHEN 3 THEN 'Either ''audio_url'' or ''audio_urls'' input is required.' WHEN 6 THEN '''model_sizes'' must be a non-empty array.' WHEN 4 THEN 'Unknown diarization_mode ''x''.' END AS error
FROM (SELECT *, o_orderkey % 8 AS k FROM orders)""")
def job_validate(spark, sf_dir):
    v = validated(_jobs(spark, sf_dir))
    return v.select("id", "recording_id", F.coalesce(F.size("audio_urls"), F.lit(0)).alias("n_urls"), F.array_join("model_sizes", ",").alias("models"), F.col("diarization_mode").alias("mode"), "error")


@query("""SELECT CASE WHEN k = 7 THEN o_orderpriority ELSE 'recording' END AS recording_id, i AS file_idx, CASE i WHEN 0 THEN 'https://host/a.opus' ELSE 'https://host/b.wav' END AS url
FROM (SELECT o_orderpriority, o_orderkey % 8 AS k, unnest(CASE WHEN o_orderkey % 8 IN (1, 6, 7) THEN [0, 1] WHEN o_orderkey % 8 IN (2, 4, 5) THEN [0] ELSE [] END) AS i FROM orders)""")
def audio_urls(spark, sf_dir):
    return inputs.audio_urls(_jobs(spark, sf_dir))


@query("""SELECT s_suppkey AS recording_id, 'en' AS detected_language, round((s_suppkey + 1) / 7.0::DOUBLE, 4) AS language_probability, round((s_suppkey + 1) / 3.0::DOUBLE, 2) AS audio_duration_s, 2 AS num_files, round((s_suppkey + 1)::DOUBLE * 2 / ((s_suppkey + 1) / 3.0::DOUBLE), 4) AS rtf_total, NULL::DOUBLE AS cost FROM supplier""")
def run_summary(spark, sf_dir):
    k = F.col("s_suppkey").cast("double") + 1
    audio = k / 3.0
    jobs = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("recording_id"), F.concat(F.lit("job"), F.col("s_suppkey")).alias("id"), F.array(F.lit("base.en")).alias("model_sizes"), F.lit("en").alias("detected_language"), (k / 7.0).alias("language_probability"), audio.alias("audio_duration_s"),
        F.array(audio / 2, audio / 2).alias("file_durations_s"), F.lit(2).alias("num_speakers"), F.lit(0.5).alias("cluster_threshold"), F.lit("whole_day").alias("diarization_mode"), F.lit(True).alias("cpu_only"), job.timing({"total_s": k * 2, "transcription_base_en_s": k}, audio, ["base.en"]).alias("timing"), F.lit(None).cast("double").alias("cost_estimate_usd"),
    )
    field = lambda path, kind="double": F.get_json_object("content", path).cast(kind)
    return job.run_summary(jobs).select("recording_id", field("$.detected_language", "string").alias("detected_language"), field("$.language_probability").alias("language_probability"), field("$.audio_duration_s").alias("audio_duration_s"), field("$.num_files", "int").alias("num_files"), field("$.timing.rtf_total").alias("rtf_total"), field("$.cost_estimate_usd").alias("cost"))


@query(f"WITH {SEG} SELECT recording_id, count(DISTINCT speaker)::INTEGER AS num_speakers, count(*)::INTEGER AS n, round(min(b), 6) AS first_start FROM s GROUP BY recording_id")
def diarization_json(spark, sf_dir):
    made = job.diarization_document(segments(spark, sf_dir).withColumn("seg_idx", F.col("seg_idx")))
    parsed = F.from_json("content", "struct<segments:array<struct<start:double,end:double,speaker:string>>,num_speakers:int>")
    return made.select("recording_id", parsed.alias("p")).select("recording_id", "p.num_speakers", F.size("p.segments").alias("n"), F.round(F.array_min(F.transform("p.segments", lambda x: x["start"])), 6).alias("first_start"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE value END AS duration_s, CASE WHEN event_id % 4 <> 0 THEN user_id ELSE -1 END AS size_bytes FROM events")
def probe_metadata(spark, sf_dir):
    good = F.concat(F.lit('{"format":{"duration":"'), F.col("value").cast("string"), F.lit('","size":"'), F.col("user_id").cast("string"), F.lit('"}}'))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("recording_id"), F.lit(0).alias("file_idx"), F.lit("a").alias("filename"), F.when(F.col("event_id") % 4 == 0, "not json").otherwise(good).alias("probe"))
    return inputs.probe_rows(rows).select(F.col("recording_id").alias("event_id"), "duration_s", F.coalesce("size_bytes", F.lit(-1).cast("long")).alias("size_bytes"))


@query("SELECT n_nationkey, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey * 1000 AS VARCHAR) ELSE n_nationkey || ' MiB' END AS memory_mb, '550.1' AS driver_version, '8.9' AS cuda_version FROM nation")
def worker_info(spark, sf_dir):
    memory = F.when(F.col("n_nationkey") % 2 == 0, (F.col("n_nationkey") * 1000).cast("string")).otherwise(F.concat(F.col("n_nationkey").cast("string"), F.lit(" MiB")))
    text = F.concat("n_name", F.lit(", "), memory, F.lit(", 550.1, 8.9\nbroken, line\n"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.explode(inputs.worker_gpus(text)).alias("g")).select("n_nationkey", "g.name", "g.memory_mb", "g.driver_version", "g.cuda_version")


class _Ticks:
    """A clock that goes on by a second whenever it is read, so that each call of a role takes one."""

    def __init__(self) -> None:
        self.now = 0.0

    def __call__(self) -> float:
        self.now += 1
        return self.now


def _stub_roles() -> run.Roles:
    """Deterministic stand-ins: ten samples a second, as many seconds as the URL has letters."""

    def transcribe(samples: np.ndarray, model: str) -> list[tuple]:
        return [(float(a), min(a + 10.0, len(samples) / 10), f"{model} says {a}", 0.1, -0.2, 1.5, 0.0) for a in range(0, len(samples) // 10, 10)]

    def speakers(samples: np.ndarray, number: int | None, threshold: float) -> list[tuple[float, float, int]]:
        return [(float(a), min(a + 15.0, len(samples) / 10), a // 15 % 2) for a in range(0, len(samples) // 10, 15)]

    return run.Roles(
        detect=lambda samples: ("es", 0.8), diarize=speakers, transcribe=transcribe, text_language=lambda text: ("en" if "base" in text else "pt", 0.75),
        fetch=lambda url: url.encode(), decode=lambda content: np.zeros(10 * len(content), np.float32), rate=10, chunk_samples=200, block_samples=150, clock=_Ticks(),
    )


# a URL of 19 or 18 letters is a file of as many seconds; in fixed_chunk, chunks of 20 s are diarized on their own
ANSWERS = """j AS (SELECT o_orderkey AS id, o_orderkey % 8 AS k, o_orderpriority FROM orders),
e AS (SELECT id, k, CASE WHEN k = 7 THEN o_orderpriority ELSE 'recording' END AS recording_id, CASE k WHEN 0 THEN 'Event must contain ''input'' field.' WHEN 3 THEN 'Either ''audio_url'' or ''audio_urls'' input is required.' WHEN 6 THEN '''model_sizes'' must be a non-empty array.' WHEN 4 THEN 'Unknown diarization_mode ''x''.' END AS error,
 CASE WHEN k IN (1, 7) THEN 37 WHEN k IN (2, 5) THEN 19 END AS s, CASE k WHEN 5 THEN ['tiny.en'] WHEN 7 THEN ['base.en'] WHEN 1 THEN ['base.en', 'small.en'] WHEN 2 THEN ['base.en', 'small.en'] END AS models FROM j),
m AS (SELECT id, k, recording_id, s, unnest(models) AS model FROM e WHERE error IS NULL),
l AS (SELECT *, unnest(range(0, s, 10)) AS t FROM m),
w AS (SELECT *, '[00:00:' || lpad(t::VARCHAR, 2, '0') || ']' AS stamp, model || ' says ' || t AS text, CASE WHEN k <> 7 THEN (CASE WHEN t <= 15 THEN 0 ELSE 1 END) ELSE (CASE WHEN t <= 15 THEN 0 WHEN t <= 20 THEN 1 ELSE 2 END) END AS speaker FROM l),
d AS (SELECT id, k, recording_id, model, count(*) AS n, string_agg(stamp || '  ' || text, chr(10) ORDER BY t) AS transcript, string_agg(stamp || ' speaker_0' || speaker || ': ' || text, chr(10) ORDER BY t) AS labeled FROM w GROUP BY id, k, recording_id, model)"""


@query(f"""WITH {ANSWERS}, x AS (SELECT id, string_agg(model || ':' || n || ':' || md5(transcript) || ':' || md5(labeled), ',' ORDER BY model) AS texts FROM d GROUP BY id)
SELECT e.id::VARCHAR AS id, recording_id, error, CASE WHEN error LIKE 'Unknown%' THEN 'Supported: whole_day, fixed_chunk' END AS detail, CASE WHEN error IS NULL THEN 'pt' END AS detected_language, CASE WHEN error IS NULL THEN round(0.8::DOUBLE * 0.7::DOUBLE, 4) END AS language_probability,
CASE WHEN error IS NOT NULL THEN -1 WHEN k = 7 THEN 4 ELSE 2 END AS num_speakers, s::DOUBLE AS audio_duration_s, CASE WHEN s = 37 THEN '19.0,18.0' WHEN s = 19 THEN '19.0' END AS file_durations, texts FROM e LEFT JOIN x ON e.id = x.id""")
def job_answers(spark, sf_dir):
    made, _ = run.answers(_jobs(spark, sf_dir).withColumn("id", F.col("id").cast("string")), _stub_roles(), shared_folder(spark))
    text = lambda kv: F.concat_ws(":", kv["key"], kv["value"]["transcript_lines"].cast("string"), F.md5(kv["value"]["transcript"]), F.md5(kv["value"]["labeled_transcript"]))
    texts = F.when(F.col("models").isNotNull(), F.array_join(F.array_sort(F.transform(F.map_entries("models"), text)), ","))
    durations = F.when(F.col("file_durations_s").isNotNull(), F.array_join(F.col("file_durations_s").cast("array<string>"), ","))
    return made.select("id", "recording_id", "error", "detail", "detected_language", "language_probability", F.coalesce("num_speakers", F.lit(-1)).alias("num_speakers"), "audio_duration_s", durations.alias("file_durations"), texts.alias("texts"))


@query(f"""WITH {ANSWERS}, p AS (SELECT *, CASE WHEN k = 7 THEN 'fixed_chunk' ELSE 'whole_day' END AS mode, CASE WHEN k = 7 THEN 4 ELSE 2 END AS speakers, CASE WHEN k = 7 THEN [0, 15, 20, 35, 37] WHEN s = 37 THEN [0, 15, 30, 37] ELSE [0, 15, 19] END AS cuts FROM e WHERE error IS NULL),
g AS (SELECT *, unnest(range(1, len(cuts))) AS i FROM p),
h AS (SELECT id, recording_id, '{{"segments":[' || string_agg('{{"start":' || cuts[i] || '.0,"end":' || cuts[i + 1] || '.0,"speaker":"speaker_0' || ((i - 1) % speakers) || '"}}', ',' ORDER BY i) || '],"num_speakers":' || speakers || ',"threshold":0.5,"model":"adapter","mode":"' || mode || '"}}' AS c FROM g GROUP BY id, recording_id, speakers, mode),
f AS (SELECT *, CASE WHEN model LIKE '%base%' THEN 'en' ELSE 'pt' END AS lang FROM d)
SELECT id::VARCHAR AS id, recording_id || '_transcript_' || model || '.txt' AS filename, md5(transcript) AS content_md5 FROM d UNION ALL SELECT id::VARCHAR, recording_id || '_labeled_' || model || '.txt', md5(labeled) FROM d
UNION ALL SELECT id::VARCHAR, recording_id || '_language_flags_' || model || '.json', md5('{{"model":"' || model || '","overall_detected_language":"' || lang || '","overall_confidence":0.75,"window_flags":[{{"start_line":0,"end_line":' || (n - 1) || ',"detected_language":"' || lang || '","confidence":0.75,"flag":null}}]}}') FROM f
UNION ALL SELECT id::VARCHAR, recording_id || '_run_summary.json', md5('{{"recording_id":"' || recording_id || '","model_sizes":["' || array_to_string(models, '","') || '"],"detected_language":"pt","language_probability":0.56,"audio_duration_s":' || s || '.0,"file_durations_s":[' || CASE WHEN s = 37 THEN '19.0,18.0' ELSE '19.0' END
 || '],"file_metadata":[' || array_to_string(list_transform(CASE WHEN s = 37 THEN ['a.opus', 'b.wav'] ELSE ['a.opus'] END, lambda x: '{{"filename":"' || x || '","duration_s":0.0,"creation_time_utc":null,"size_bytes":null,"format_name":null}}'), ',') || '],"num_files":' || n || ',"num_speakers":' || speakers || ',"cluster_threshold":0.5,"diarization_mode":"' || mode
 || '","cpu_only":true,"timing":{{"audio_download_s":' || n || '.0,"diarization_s":' || u || '.0,"language_detection_s":1.0,' || array_to_string(list_transform(list_sort(models), lambda x: '"transcription_' || replace(x, '.', '_') || '_s":1.0'), ',') || ',"total_s":' || n + u + 1 + len(models) || '.0,"rtf_total":' || round((n + u + 1 + len(models))::DOUBLE / s, 4) || ',' || array_to_string(list_transform(list_sort(models), lambda x: '"rtf_transcription_' || replace(x, '.', '_') || '":' || round(1::DOUBLE / s, 4)), ',')
 || '}},"job_id":"' || id || '","worker":{{}},"cost_estimate_usd":null}}') FROM (SELECT *, CASE WHEN s = 37 THEN 2 ELSE 1 END AS n, CASE WHEN k = 7 THEN 2 ELSE 1 END AS u FROM p)
UNION ALL SELECT id::VARCHAR, recording_id || '_diarization.json', md5(c) FROM h
UNION ALL SELECT id::VARCHAR, recording_id || '_segment_metadata_' || model || '.json', md5('{{"model":"' || model || '","detected_language":"pt","language_probability":0.56,"segments":[' || string_agg('{{"start":' || t || '.0,"end":' || least(t + 10, s) || '.0,"no_speech_prob":0.1,"avg_logprob":-0.2,"compression_ratio":1.5,"temperature":0.0,"text":"' || text || '"}}', ',' ORDER BY t) || ']}}') FROM w GROUP BY id, recording_id, model""")
def job_artifacts(spark, sf_dir):
    _, made = run.answers(_jobs(spark, sf_dir).withColumn("id", F.col("id").cast("string")), _stub_roles(), shared_folder(spark))
    # what the pretty printer adds between tokens goes, so that documents compare whole; patterns start with what is rare, so that few places are looked at twice
    compact = F.regexp_replace(F.replace(F.regexp_replace("content", r"\n\s*", ""), F.lit('" : '), F.lit('":')), r' (?<=[\[\]{}"0-9,] )(?=[\]\[{}"0-9-])', "")
    return made.select(F.col("recording_id").alias("id"), "filename", F.md5(F.when(F.col("filename").like("%.json"), compact).otherwise(F.col("content"))).alias("content_md5"))


@query(f"""WITH {ANSWERS.replace("o_orderkey AS id,", "o_orderkey AS n, CASE WHEN o_orderkey % 5 <> 0 THEN (o_orderkey // 3)::VARCHAR END AS id,").replace("SELECT id, k,", "SELECT n, id, k,")}
SELECT id, recording_id, error, CASE WHEN error IS NOT NULL THEN -1 WHEN k = 7 THEN 4 ELSE 2 END AS num_speakers, coalesce(s, -1)::DOUBLE AS audio_duration_s, coalesce(len(models), 0)::INTEGER AS n_models,
CASE WHEN error IS NULL THEN CASE WHEN s = 37 THEN 2 ELSE 1 END + CASE WHEN k = 7 THEN 2 ELSE 1 END + 1 + len(models) ELSE 0 END::DOUBLE AS total_s FROM e""")
def job_repeats(spark, sf_dir):
    """Ids that several events share, and events without one: each has its own answer."""
    given = F.when(F.col("id") % 5 != 0, F.floor(F.col("id") / 3).cast("string"))
    made, _ = run.answers(_jobs(spark, sf_dir).withColumn("id", given), _stub_roles(), shared_folder(spark))
    return made.select("id", "recording_id", "error", F.coalesce("num_speakers", F.lit(-1)).alias("num_speakers"), F.coalesce("audio_duration_s", F.lit(-1.0)).alias("audio_duration_s"), F.coalesce(F.size("models"), F.lit(0)).alias("n_models"), F.coalesce(F.try_element_at("timing", F.lit("total_s")), F.lit(0.0)).alias("total_s"))


def _planted_roles() -> run.Roles:
    """Sounds of 100 samples a second, made of parts of three seconds: the k-th of sound n is silence, speaker 1 or speaker 2 as (n + k k) % 3 says.

    Speakers are told by loudness; blocks are shorter than windows and end within parts.
    """

    def decode(content: bytes):
        n = int(content)
        for k in range(n % 11 + 4):
            yield np.full(300, (n + k * k) % 3 * 0.1, np.float32)

    def segment(window: np.ndarray) -> np.ndarray:
        return np.eye(7)[np.rint(window.reshape(100, -1).mean(axis=1) * 10).astype(int)]

    def embed(features: np.ndarray) -> np.ndarray:
        return np.eye(3)[int(np.rint(features.mean() * 10))]

    return run.Roles(
        detect=lambda samples: ("en", 1.0), fetch=lambda url: url.split("/")[-1].encode(), decode=decode, transcribe=lambda samples, model: [], rate=100, block_samples=770, chunk_samples=1500,
        engine=diarize.Engine(segment=segment, features=lambda x: x[None, :], embed=embed, size=1000, rate=100),
    )


def _planted_jobs(spark, sf_dir) -> DataFrame:
    none = F.lit(None)
    fields = {"audio_url": F.concat(F.lit("https://host/"), F.col("s_suppkey").cast("string")), "diarization_mode": F.when(F.col("s_suppkey") % 4 == 3, "fixed_chunk")}
    body = F.struct(*(fields.get(f.name, none.cast(f.dataType)).alias(f.name) for f in _parse_datatype_string(schemas.JOB)["input"].dataType))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), body.alias("input"))


# units are recordings or chunks of 15 s; windows of 10 s cut speech, gap merging joins it again;
# a unit's speakers are named in the order of their first interval by window, local speaker and start
PLANTED = """p AS (SELECT s_suppkey AS n, unnest(range(0, s_suppkey % 11 + 4)) AS k, CASE WHEN s_suppkey % 4 = 3 THEN 15 ELSE 1000 END AS size FROM supplier),
q AS (SELECT n, k // (size // 3) AS unit, k % (size // 3) * 3 AS b, size, (n + k * k) % 3 AS speaker FROM p),
v AS (SELECT n, unit, size, speaker, b, speaker - coalesce(lag(speaker) OVER (PARTITION BY n, unit ORDER BY b), -1) <> 0 AS new FROM q),
i AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY n, unit ORDER BY b) AS island FROM v),
s AS (SELECT n, unit, size, speaker, min(b) AS b, max(b) + 3 AS e FROM i WHERE speaker > 0 GROUP BY n, unit, size, island, speaker),
f AS (SELECT n, unit, speaker, min(b // 10 * 1000000 + speaker * 1000 + b % 10) AS first FROM s GROUP BY n, unit, speaker),
g AS (SELECT n, unit, speaker, row_number() OVER (PARTITION BY n, unit ORDER BY first) - 1 AS label, count(*) OVER (PARTITION BY n, unit) AS held FROM f),
o AS (SELECT n, unit, coalesce(sum(held) OVER (PARTITION BY n ORDER BY unit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM (SELECT DISTINCT n, unit, held FROM g))"""


@query(f"""WITH {PLANTED} SELECT s.n::VARCHAR AS id, (unit * size + b)::DOUBLE AS start, (unit * size + e)::DOUBLE AS "end", printf('speaker_%02d', label + before) AS speaker FROM s JOIN g USING (n, unit, speaker) JOIN o USING (n, unit)""")
def diarize_blocks(spark, sf_dir):
    """The engine's own diarization of jobs whose recordings lie as blocks."""
    made, _ = run.answers(_planted_jobs(spark, sf_dir), _planted_roles(), shared_folder(spark))
    return made.select("id", F.explode("diarization_segments").alias("x")).select("id", "x.start", "x.end", "x.speaker")

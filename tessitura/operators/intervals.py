"""Interval joins, gap merging and chunk timelines, keyed by ``recording_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ranges

UNKNOWN = "[unknown]"


def align(lines: DataFrame, segments: DataFrame, *, reach: float = 5.0, bucket_s: float = 30.0, mode: str = "labeled") -> DataFrame:
    """Each line (recording_id, t, ...) with the speaker of its segment; repeated lines are kept.

    A line belongs to the segment that contains it (both ends included; of several the
    first by start and seg_idx), else to the nearest one less than ``reach`` away (first on
    ties), else it is ``[unknown]``. ``mode`` "contains" or "nearest" applies one rule only.

    Time is cut into buckets of ``bucket_s``; a segment goes to every bucket that it or its
    reach touches, a line to exactly one. The join is then on (recording_id, bucket), so a
    long recording spreads over many tasks. Only the distinct times of lines are joined and
    aggregated; the lines themselves, with their texts, meet one label for each time.

    Null times match nothing and stay unknown; segments with a null end are ignored.
    """
    bucket = lambda t: F.floor(t / bucket_s)
    # one bucket more on either side: the quotient's rounding must not lose an edge
    spread = segments.where("start IS NOT NULL AND end IS NOT NULL").select(
        F.col("recording_id").alias("__rec"), F.col("start").alias("__start"), F.col("end").alias("__end"), F.col("seg_idx").alias("__seg"), F.col("speaker").alias("__speaker"),
        F.explode(F.sequence(F.least(bucket(F.col("start") - reach), bucket(F.col("end") - reach)), F.greatest(bucket(F.col("end") + reach), bucket(F.col("start") + reach)))).alias("__bucket"),
    )
    t, start, end = F.col("t"), F.col("__start"), F.col("__end")
    inside = (start <= t) & (t <= end)
    distance = F.least(F.abs(t - start), F.abs(t - end))
    fits = {"contains": inside, "nearest": ~inside & (distance < reach), "labeled": inside | (distance < reach)}[mode]
    times = lines.where("t IS NOT NULL").select("recording_id", "t").distinct().withColumn("__b", bucket(t))
    joined = times.join(spread, (F.col("recording_id") == F.col("__rec")) & (F.col("__b") == F.col("__bucket")) & fits)
    key = F.struct(F.when(inside, 0).otherwise(1), F.when(inside, 0.0).otherwise(distance), start, F.col("__seg"))
    labels = joined.groupBy("recording_id", "__b", "t").agg(F.min_by("__speaker", key).alias("__label")).select(F.col("recording_id").alias("__of"), F.col("t").alias("__at"), "__label")
    found = lines.join(labels, (lines["recording_id"] == F.col("__of")) & (lines["t"] == F.col("__at")), "left")
    return found.select(*(lines[c] for c in lines.columns), F.coalesce("__label", F.lit(UNKNOWN)).alias("speaker"))


def min_duration(segments: DataFrame, start: str = "start_s", end: str = "end_s", least: float = 0.3) -> DataFrame:
    """Segments of at least ``least`` seconds, before any rounding."""
    return segments.where(F.col(end) - F.col(start) >= least)


def merged(segments: DataFrame, gap_s: float = 0.5, parts: int | None = None) -> DataFrame:
    """(recording_id, start, seg_idx of the first, end, speaker): neighbouring segments of one speaker with a gap under ``gap_s`` as one.

    Order is (start, seg_idx) over the whole recording: another speaker between ends a run.
    The merged end is that of the run's last segment, even if an earlier one ends later.
    """
    joins = (F.col("speaker") == F.col("before_speaker")) & (F.col("start") - F.col("before_end") < gap_s)
    order = F.struct("start", "seg_idx")
    return ranges.islands(segments, "recording_id", ["start", "seg_idx"], joins, {"end": F.max_by("end", order), "speaker": F.max_by("speaker", order)}, parts)


def merge_gaps(segments: DataFrame, gap_s: float = 0.5, parts: int | None = None) -> DataFrame:
    """(recording_id, island, start, end, speaker): merged segments, numbered from 1 in each recording.

    Neither step puts a recording into one task: both go by ranges of the whole order.
    """
    found = ranges.numbered(merged(segments, gap_s, parts), "recording_id", ["start", "seg_idx"], "island", parts)
    return found.select("recording_id", (F.col("island") + 1).alias("island"), "start", "end", "speaker")


def speaker_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("recording_id").agg(F.countDistinct("speaker").alias("num_speakers"), F.count(F.lit(1)).alias("num_segments"))


def clip(intervals: DataFrame, limit: Column, start: str = "start_s", end: str = "end_s") -> DataFrame:
    """Ends cut at ``limit``; what is then empty goes."""
    return intervals.withColumn(end, F.least(end, limit)).where(F.col(end) > F.col(start))


def file_timeline(files: DataFrame) -> DataFrame:
    """Offset of each file when a recording's files follow each other without a gap."""
    before = Window.partitionBy("recording_id").orderBy("file_idx").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("offset_s", F.coalesce(F.sum("duration_s").over(before), F.lit(0.0)))


def fixed_chunks(recordings: DataFrame, chunk_samples: int = 40_000_000, rate: int = 16_000) -> DataFrame:
    """(recording_id, chunk_idx, first_sample, n_samples, offset_s) of each fixed chunk."""
    n = F.ceil(F.col("n_samples") / chunk_samples)
    each = ranges.counted(recordings.where("n_samples > 0").select("recording_id", "n_samples"), n, "chunk_idx").withColumnRenamed("n_samples", "total")
    first = F.col("chunk_idx") * chunk_samples
    return each.select("recording_id", "chunk_idx", first.alias("first_sample"), F.least(F.lit(chunk_samples), F.col("total") - first).alias("n_samples"), (first / rate).alias("offset_s"))


def chunk_id_offsets(segments: DataFrame) -> DataFrame:
    """Distinct speakers of each chunk and the running sum of those before: what ids are shifted by."""
    counts = segments.groupBy("recording_id", "chunk_idx").agg(F.countDistinct("speaker_id").alias("speakers"))
    before = Window.partitionBy("recording_id").orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("id_offset", F.coalesce(F.sum("speakers").over(before), F.lit(0)))


def append_chunks(segments: DataFrame, chunk_s: float = 2500.0) -> DataFrame:
    """Chunk-local segments (start, end, speaker_id) on the recording's timeline with shifted ids."""
    moved = segments.join(chunk_id_offsets(segments).drop("speakers"), ["recording_id", "chunk_idx"])
    shift = F.col("chunk_idx") * chunk_s
    return moved.select("recording_id", "chunk_idx", F.round(F.col("start") + shift, 3).alias("start"), F.round(F.col("end") + shift, 3).alias("end"), (F.col("speaker_id") + F.col("id_offset")).alias("speaker_id"))


def head(lines: DataFrame, within_s: float = 30.0) -> DataFrame:
    """The first line of each recording that starts in its first ``within_s`` seconds: what detection reads."""
    early = lines.where(F.col("t") < within_s)
    rest = [c for c in lines.columns if c != "recording_id"]
    first = F.min_by(F.struct(*rest), F.struct("t", "line_idx")).alias("__first")
    return early.groupBy("recording_id").agg(first).select("recording_id", *(F.col("__first")[c].alias(c) for c in rest))

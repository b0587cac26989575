"""Column functions that format times, labels, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_to_hms(seconds: Column) -> Column:
    """``[HH:MM:SS]`` of seconds cut to whole ones; hours are not wrapped and may grow wider."""
    s = seconds.cast("bigint")
    return F.format_string("[%02d:%02d:%02d]", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def speaker_label(number: Column) -> Column:
    """``speaker_07``; numbers of three digits widen the label."""
    return F.format_string("speaker_%02d", number.cast("bigint"))


def model_key(model: Column) -> Column:
    """A model's name as a part of a key: dots become underscores."""
    return F.replace(model, F.lit("."), F.lit("_"))


def labeled_line(stamp: Column, label: Column, text: Column) -> Column:
    return F.concat(stamp, F.lit(" "), label, F.lit(": "), text)


def transcript_line(stamp: Column, text: Column) -> Column:
    return F.concat(stamp, F.lit("  "), text)


def strip(text: Column) -> Column:
    """The text without white space of any script at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def url_extension(url: Column, default: Column) -> Column:
    """What follows the last dot of the URL's last path part (query and end slashes cut), else ``default``."""
    path = F.rtrim(F.substring_index(url, "?", 1), F.lit("/"))
    last = F.substring_index(path, "/", -1)
    return F.when(F.instr(last, ".") > 0, F.substring_index(last, ".", -1)).otherwise(default)


def concat_entry(path: Column) -> Column:
    """A line of a concatenation list: the path in single quotes, its own quotes escaped."""
    return F.concat(F.lit("file '"), F.replace(path, F.lit("'"), F.lit("'\\''")), F.lit("'"))


def description(recording: Column) -> Column:
    return F.concat_ws("_", recording, F.date_format(F.current_date(), "yyyy-MM-dd"))


def artifact_names(recording: Column, models: Column) -> Column:
    """Names of a recording's artifacts: four of each model, then two shared ones."""
    parts = (("_transcript_", ".txt"), ("_labeled_", ".txt"), ("_segment_metadata_", ".json"), ("_language_flags_", ".json"))
    of_model = F.flatten(F.transform(models, lambda m: F.array(*(F.concat(recording, F.lit(a), m, F.lit(b)) for a, b in parts))))
    shared = F.array(F.concat(recording, F.lit("_diarization.json")), F.concat(recording, F.lit("_run_summary.json")))
    return F.concat(of_model, shared)

"""Writers of segments, speakers, flags and audits. Each makes a table of lines or documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar

KEYS = ("recording_id", "model")
ORDER = ("start_ms", "end_ms", "seg_seq")


def _said(segments: DataFrame) -> DataFrame:
    return segments.withColumn("text", scalar.strip("text")).where("text <> ''")


def _seconds(c: str) -> Column:
    return (F.col(c) / 1000).cast("double")


def transcript_lines(segments: DataFrame, *, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """``keys, place, line``: ``[HH:MM:SS] Speaker N: text``; empty text is left out.

    The older form leaves the order of the input: ``order=("seg_seq",)``, here and for subtitles.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    line = F.concat(F.lit("["), scalar.clock("start_ms"), F.lit("] "), scalar.speaker_label("speaker"), F.lit(": "), F.col("text"))
    return _said(segments).select(*keys, F.row_number().over(w).alias("place"), line.alias("line"))


def subtitle_cues(segments: DataFrame, *, keys: Sequence[str] = KEYS, order: Sequence[str] = ORDER) -> DataFrame:
    """``keys, cue, times, line``; cues number the segments with text only."""
    w = Window.partitionBy(*keys).orderBy(*order)
    times = F.concat(scalar.subtitle_clock("start_ms"), F.lit(" --> "), scalar.subtitle_clock("end_ms"))
    return _said(segments).select(*keys, F.row_number().over(w).alias("cue"), times.alias("times"), F.concat(scalar.speaker_label("speaker"), F.lit(": "), F.col("text")).alias("line"))


def jsonl_lines(segments: DataFrame, *, keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys, place, line``: one JSON object a segment with text."""
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    row = F.struct(_seconds("start_ms").alias("start"), _seconds("end_ms").alias("end"), scalar.speaker_label("speaker").alias("speaker"), "text")
    return _said(segments).select(*keys, F.row_number().over(w).alias("place"), F.to_json(row, {"ignoreNullFields": "false"}).alias("line"))


def write_lines(lines: DataFrame, path: str, *, keys: Sequence[str] = KEYS, order: str = "place", blank: bool = False) -> None:
    """A folder per key with its lines in order; ``blank`` puts an empty line after each.

    A key's lines go to one file, sorted on the way; refuses to overwrite.
    """
    text = F.concat("line", F.lit("\n")) if blank else F.col("line")
    parted = lines.withColumn("value", text).repartition(*keys).sortWithinPartitions(*keys, order)
    parted.select(*keys, "value").write.mode("errorifexists").partitionBy(*keys).text(path)


def write_packed(lines: DataFrame, path: str, *, keys: Sequence[str] = KEYS, order: str = "place") -> None:
    """What :func:`write_lines` writes, a document a row: ``keys, content``, many documents a file.

    For what programs read on: as files of their own, documents cost a folder and an opening each, and
    the driver holds all their names. Refuses to overwrite. :mod:`readers` has the way back.
    """
    value = F.coalesce(F.col("line"), F.lit(""))
    held = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda x: F.concat(x.v, F.lit("\n")))
    write_new(lines.groupBy(*keys).agg(F.array_join(held, "").cast("binary").alias("content")), path)


def write_subtitles(segments: DataFrame, path: str, *, keys: Sequence[str] = KEYS) -> None:
    cues = subtitle_cues(segments, keys=keys).withColumn("line", F.concat_ws("\n", F.col("cue").cast("string"), "times", "line"))
    write_lines(cues, path, keys=keys, order="cue", blank=True)


def documents(owners: DataFrame, rows: DataFrame, *, keys: Sequence[str], item: Column, order: Column) -> DataFrame:
    """``keys, json``: the rows of each owner as a JSON array in order; ``[]`` for those without any."""
    held = rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), item.alias("i")))), lambda x: x.i).alias("items"))
    found = held.select(*keys, F.to_json("items", {"ignoreNullFields": "false"}).alias("json"))
    return owners.select(*keys).join(found, list(keys), "left").select(*keys, F.coalesce("json", F.lit("[]")).alias("json"))


def segments_json(owners: DataFrame, segments: DataFrame, *, keys: Sequence[str] = KEYS, keep_empty: bool = True) -> DataFrame:
    """All segments, empty ones too, under raw and shown speaker.

    Without ``keep_empty`` this is the older form, in the order of the input.
    """
    rows = segments if keep_empty else _said(segments)
    item = F.struct(_seconds("start_ms").alias("start"), _seconds("end_ms").alias("end"), F.col("speaker").alias("speaker_raw"), scalar.speaker_label("speaker").alias("speaker"), scalar.strip("text").alias("text"))
    return documents(owners, rows, keys=keys, item=item, order=F.struct(*ORDER) if keep_empty else F.struct("seg_seq"))


def speakers_json(owners: DataFrame, summary: DataFrame, *, keys: Sequence[str] = KEYS) -> DataFrame:
    item = F.struct("speaker_raw", "speaker", _seconds("diarized_ms").alias("diarized_seconds"), "transcript_word_count", "first_sample_text")
    return documents(owners, summary, keys=keys, item=item, order=F.struct("speaker_raw"))


def flags_json(owners: DataFrame, flags: DataFrame, *, keys: Sequence[str] = KEYS, order: Sequence[str] = ("start_ms",)) -> DataFrame:
    """Flags, inversions or warnings, with all their columns but the keys."""
    return documents(owners, flags, keys=keys, item=F.struct(*[c for c in flags.columns if c not in keys]), order=F.struct(*order))


def coverage_json(recordings: DataFrame, turns: DataFrame, summary: DataFrame, gaps: DataFrame, *, least_pct: float = 95.0, most_tail_ms: int = 30_000, metadata: dict[str, str] | None = None) -> DataFrame:
    """``recording_id, json``: length, time of all turns, thresholds, and each model's audit with its gaps."""
    per_gap = F.struct(_seconds("start_ms").alias("start"), _seconds("end_ms").alias("end"), _seconds("duration_ms").alias("duration"), "speaker")
    held = gaps.groupBy("recording_id", "model").agg(F.array_sort(F.collect_list(per_gap)).alias("gaps"))
    none = F.expr("array()").cast("array<struct<start: double, end: double, duration: double, speaker: string>>")
    audit = F.struct(_seconds("speech_ms").alias("speech_seconds"), _seconds("covered_ms").alias("covered_seconds"), _seconds("uncovered_ms").alias("uncovered_seconds"), "coverage_pct", F.coalesce("gaps", none).alias("gaps"))
    models = summary.join(held, ["recording_id", "model"], "left").groupBy("recording_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("model"), audit.alias("audit"))))).alias("models"))
    speech = turns.groupBy("recording_id").agg((F.sum(F.col("end_ms") - F.col("start_ms")) / 1000).alias("speech"))
    both = recordings.select("recording_id", "duration_ms").distinct().join(speech, "recording_id", "left").join(models, "recording_id", "left")
    body = F.struct(
        _seconds("duration_ms").alias("duration_seconds"), F.coalesce("speech", F.lit(0.0)).alias("pyannote_speech_seconds"),
        F.lit(float(least_pct)).alias("coverage_min_pct_threshold"), F.lit(most_tail_ms / 1000).alias("max_trailing_gap_seconds_threshold"),
        *[F.lit(v).alias(k) for k, v in (metadata or {}).items()], "models",
    )
    return both.select("recording_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


def turns_json(recordings: DataFrame, turns: DataFrame) -> DataFrame:
    item = F.struct(_seconds("start_ms").alias("start"), _seconds("end_ms").alias("end"), "speaker")
    return documents(recordings.select("recording_id").distinct(), turns, keys=["recording_id"], item=item, order=F.struct("start_ms", "turn_seq"))


def write_checkpoint(words: DataFrame, path: str) -> None:
    """Words with their keys beside them, a file a task; the committer makes a finished write appear as a whole.

    A folder a key would take a file for each key in each task, and the driver would hold all their names.
    """
    words.write.mode("overwrite").parquet(path)


def write_new(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Refuses a path that is there; the folder's success mark comes last."""
    df.write.mode("errorifexists").format(fmt).save(path)

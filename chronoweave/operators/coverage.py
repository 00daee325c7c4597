"""How much of the speech a transcript covers: by turns, by frames, at the tail; and warnings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..sources.staging import stage
from .islands import change_islands, interval_gaps, interval_union
from .rangejoin import clip_join


def turn_clips(turns: DataFrame, segments: DataFrame, keys: Sequence[str], width_ms: int = 30_000) -> DataFrame:
    """Segments cut to the turns that they overlap: ``keys, turn_seq, start_ms, end_ms``."""
    a = turns.select("recording_id", "turn_seq", F.col("start_ms").alias("l_start"), F.col("end_ms").alias("l_end"))
    b = segments.select(*keys, F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    met = clip_join(a, b, ["recording_id"], width=width_ms)
    return met.select(*keys, "turn_seq", F.greatest("l_start", "r_start").alias("start_ms"), F.least("l_end", "r_end").alias("end_ms"))


def audit(turns: DataFrame, segments: DataFrame, recordings: DataFrame, *, grace_ms: int = 500, least_ms: int = 2000, keys: Sequence[str] = ("recording_id", "model")) -> tuple[DataFrame, DataFrame]:
    """Coverage of each key of ``recordings``, and its gaps.

    Time counts per turn, so turns that overlap count twice. Summary: ``keys, speech_ms,
    covered_ms, uncovered_ms, coverage_pct`` (100 without speech). Gaps longer than
    ``grace_ms`` and of ``least_ms`` or more: ``keys, turn_seq, start_ms, end_ms, duration_ms,
    speaker``.
    """
    each = recordings.select(*keys).join(turns, "recording_id")
    inner = [*keys, "turn_seq"]
    runs = stage(interval_union(turn_clips(turns, segments, keys), inner), "runs")  # for the summary, the gaps and what warns of them
    covered = runs.groupBy(*keys).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("covered_ms"))
    speech = each.groupBy(*keys).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"))
    summary = recordings.select(*keys).join(speech, list(keys), "left").join(covered, list(keys), "left")
    s, c = F.coalesce("speech_ms", F.lit(0)).cast("long"), F.coalesce("covered_ms", F.lit(0)).cast("long")
    summary = summary.select(*keys, s.alias("speech_ms"), c.alias("covered_ms")).withColumn("uncovered_ms", F.col("speech_ms") - F.col("covered_ms"))
    summary = summary.withColumn("coverage_pct", scalar.share(F.col("covered_ms"), F.col("speech_ms"), 100.0))
    gaps = interval_gaps(each, runs, inner).withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))
    gaps = gaps.where((F.col("duration_ms") > grace_ms) & (F.col("duration_ms") >= least_ms))
    return summary, gaps.join(each.select(*inner, "speaker"), inner)


def tail_gaps(recordings: DataFrame, segments: DataFrame, *, most_ms: int = 30_000, keys: Sequence[str] = ("recording_id", "model")) -> DataFrame:
    """``keys, duration_ms, gap_ms, ok``: from the last end of any segment to the end; none: all of it, not ok."""
    last = segments.groupBy(*keys).agg(F.max("end_ms").alias("last_ms"))
    gap = F.col("duration_ms") - F.coalesce("last_ms", F.lit(0))
    both = recordings.select(*keys, "duration_ms").join(last, list(keys), "left")
    return both.select(*keys, "duration_ms", gap.alias("gap_ms"), (F.col("last_ms").isNotNull() & (gap <= most_ms)).alias("ok"))


def warnings(summary: DataFrame, tails: DataFrame, *, least_pct: float = 95.0, keys: Sequence[str] = ("recording_id", "model")) -> DataFrame:
    """One wide row a warning, ordered by ``place``: coverage below the floor, then a trailing gap."""
    low = summary.where(F.col("coverage_pct") < least_pct).select(
        *keys, F.lit(0).alias("place"), F.lit("high").alias("severity"), F.lit("coverage_below_threshold").alias("kind"), "coverage_pct", F.lit(float(least_pct)).alias("threshold_pct")
    )
    cut = tails.where("not ok").select(
        *keys, F.lit(1).alias("place"), F.lit("critical").alias("severity"), F.lit("trailing_gap").alias("kind"),
        "duration_ms", (F.col("duration_ms") - F.col("gap_ms")).alias("last_end_ms"), F.col("gap_ms").alias("trailing_gap_ms"),
    )
    return low.unionByName(cut, allowMissingColumns=True)


def frame_cover(frames: DataFrame, segments: DataFrame, *, frame_ms: int, speech: Column, keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    """``keys, frame_idx, speech, covered``: a segment covers all frames that it touches, both ends included."""
    first = F.greatest(F.lit(0), F.floor(F.col("start_ms") / frame_ms)).cast("long")
    last = F.floor(F.col("end_ms") / frame_ms).cast("long")
    held = segments.where(last >= first).select(*keys, F.explode(F.sequence(first, last)).alias("frame_idx")).distinct()
    return frames.join(held.withColumn("covered", F.lit(True)), [*keys, "frame_idx"], "left").select(*keys, "frame_idx", speech.alias("speech"), F.coalesce("covered", F.lit(False)).alias("covered"))


def frame_summary(mask: DataFrame, *, frame_ms: int, keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    out = mask.groupBy(*keys).agg(F.count("*").alias("frames"), F.count_if("speech").alias("speech_frames"), F.count_if(F.col("speech") & F.col("covered")).alias("covered_frames"))
    return out.select(
        *keys, (F.col("frames") * frame_ms).alias("total_ms"), (F.col("speech_frames") * frame_ms).alias("speech_ms"), (F.col("covered_frames") * frame_ms).alias("covered_ms"),
        scalar.share(F.col("covered_frames"), F.col("speech_frames"), 100.0).alias("coverage_pct"),
    )


def frame_gaps(mask: DataFrame, *, frame_ms: int, least_ms: int, keys: Sequence[str] = ("recording_id",)) -> DataFrame:
    """Runs of speech frames that nothing covers, the one at the end included."""
    open_ = F.col("speech") & ~F.col("covered")
    runs = change_islands(mask.withColumn("__open", open_), keys, ["frame_idx"], F.col("__open"), "__run").where("__open")
    out = runs.groupBy(*keys, "__run").agg((F.min("frame_idx") * frame_ms).alias("start_ms"), ((F.max("frame_idx") + 1) * frame_ms).alias("end_ms")).drop("__run")
    return out.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms")).where(F.col("duration_ms") >= least_ms)

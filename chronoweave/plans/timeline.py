"""The pipeline from emitted words to audited segments, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, detecting, merging, speakers
from ..sources.staging import stage

KEYS = ["recording_id", "model"]


@dataclass
class Tuned:
    """What a re-run of everything after recognition gives."""

    words: DataFrame
    segments: DataFrame
    summary: DataFrame
    gaps: DataFrame
    tails: DataFrame
    warnings: DataFrame


def tune(words: DataFrame, turns: DataFrame, recordings: DataFrame, *, smoothing_ms: int = 2000, grace_ms: int = 500, least_gap_ms: int = 2000, least_pct: float = 95.0, most_tail_ms: int = 30_000) -> Tuned:
    """Merge overlaps, assign speakers, build segments, audit coverage, warn.

    ``recordings`` has ``recording_id, model, duration_ms``. Segments are staged, as every audit
    and writer reads them; the rest runs where a result is used.
    """
    merged = merging.merge_overlaps(words, keys=KEYS)
    labelled = speakers.assign_speakers(merged, turns, smoothing_ms=smoothing_ms, keys=KEYS)
    segments = stage(speakers.build_segments(labelled, keys=KEYS), "segments", together=True)
    summary, gaps = coverage.audit(turns, segments, recordings, grace_ms=grace_ms, least_ms=least_gap_ms, keys=KEYS)
    tails = coverage.tail_gaps(recordings, segments, most_ms=most_tail_ms, keys=KEYS)
    return Tuned(labelled, segments, summary, gaps, tails, coverage.warnings(summary, tails, least_pct=least_pct, keys=KEYS))


def report(tuned: Tuned) -> DataFrame:
    """One row a recording and model: segments, coverage, gaps, tail, warnings."""
    counts = tuned.segments.groupBy(*KEYS).agg(F.count("*").alias("segments"))
    gaps = tuned.gaps.groupBy(*KEYS).agg(F.count("*").alias("gaps"))
    warned = tuned.warnings.groupBy(*KEYS).agg(F.count("*").alias("warnings"))
    both = tuned.summary.join(tuned.tails, KEYS).join(counts, KEYS, "left").join(gaps, KEYS, "left").join(warned, KEYS, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select(*KEYS, zero("segments"), "speech_ms", "covered_ms", "coverage_pct", zero("gaps"), "gap_ms", "ok", zero("warnings"))


def run(words: DataFrame, turns: DataFrame, recordings: DataFrame, **settings) -> tuple[Tuned, DataFrame, DataFrame]:
    """:func:`tune`, then corrected segments and what no one said among them."""
    tuned = tune(words, turns, recordings, **settings)
    corrected = detecting.correct_segments(tuned.segments)
    return tuned, corrected, detecting.unsaid(corrected)

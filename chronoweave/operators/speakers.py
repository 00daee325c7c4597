"""Speakers of words by overlapping turns, and segments of one speaker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.fixed import UNKNOWN_SPEAKER
from .islands import change_islands
from .rangejoin import over_buckets


def assign_speakers(words: DataFrame, turns: DataFrame, *, smoothing_ms: int = 2000, keys: Sequence[str] = ("recording_id", "model"), width_ms: int = 30_000) -> DataFrame:
    """``words`` with the ``speaker`` who holds most of the ``smoothing_ms`` around its middle.

    Of speakers with as much, the one whose turn comes first; none: ``SPEAKER_UNKNOWN``. All is
    doubled, so that middles are whole. A word meets the turns once, in the bucket of its middle, where
    those within ``smoothing_ms`` of the bucket stand in one row; it is voted on in its own row, so
    words are neither multiplied nor dealt by word.
    """
    by_start = Window.partitionBy("recording_id").orderBy("start_ms", "turn_seq")
    ranked = turns.select("recording_id", (2 * F.col("start_ms")).alias("rs"), (2 * F.col("end_ms")).alias("re"), F.col("speaker").alias("who"), F.row_number().over(by_start).alias("rank"))
    middle, width = F.col("start_ms") + F.col("end_ms"), 2 * width_ms
    reach = ranked.where("re > rs").withColumn("__from", F.col("rs") - smoothing_ms).withColumn("__to", F.col("re") + smoothing_ms)
    near = over_buckets(reach, "__from", "__to", width).groupBy("recording_id", "__bucket").agg(F.collect_list(F.struct("rs", "re", "who", "rank")).alias("__turns"))
    met = words.drop("speaker").withColumn("__bucket", F.floor(middle / width).cast("long")).join(near.hint("shuffle_hash"), ["recording_id", "__bucket"], "left")
    ms = lambda t: scalar.overlap(middle - smoothing_ms, middle + smoothing_ms, t.rs, t.re)
    held = met.withColumn("__held", F.filter(F.coalesce("__turns", F.array().cast(near.schema["__turns"].dataType)), lambda t: ms(t) > 0))
    own = lambda who: F.filter("__held", lambda t: t.who.eqNullSafe(who))
    tally = F.transform(F.array_distinct(F.transform("__held", lambda t: t.who)), lambda who: F.struct(
        F.aggregate(own(who), F.lit(0).cast("long"), lambda n, t: n + ms(t)).alias("ms"), (-F.array_min(F.transform(own(who), lambda t: t.rank))).alias("first"), who.alias("who"),
    ))
    vote = F.when(F.size("__held") == 1, F.col("__held")[0].who).when(F.size("__held") > 1, F.array_max(tally).who)
    return held.select(*[c for c in words.columns if c != "speaker"], F.coalesce(vote, F.lit(UNKNOWN_SPEAKER)).alias("speaker"))


def build_segments(words: DataFrame, *, keys: Sequence[str] = ("recording_id", "model"), max_gap_ms: int | None = None) -> DataFrame:
    """Runs of words of one speaker: ``keys, seg_seq, start_ms, end_ms, speaker, text``.

    A segment ends where its last word ends. A pause does not end it unless ``max_gap_ms``, an
    extension, is given. The group of a segment is one speaker's run.
    """
    order = ["start_ms", "seq"]
    runs = change_islands(words, keys, order, F.col("speaker"), "seg_seq")
    if max_gap_ms is not None:
        w = Window.partitionBy(*keys).orderBy(*order)
        far = F.coalesce((F.col("start_ms") - F.lag("end_ms").over(w) > max_gap_ms).cast("int"), F.lit(0))
        runs = runs.withColumn("__far", far).withColumn("seg_seq", F.col("seg_seq") + F.sum("__far").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    place = F.struct(*order)
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda x: x.text)
    out = runs.groupBy(*keys, "seg_seq").agg(
        F.min_by("start_ms", place).alias("start_ms"), F.max_by("end_ms", place).alias("end_ms"), F.first("speaker").alias("speaker"), parts.alias("__parts")
    )
    return out.select(*keys, F.col("seg_seq").cast("long").alias("seg_seq"), "start_ms", "end_ms", "speaker", scalar.strip(F.array_join("__parts", " ")).alias("text"))


def speaker_summary(segments: DataFrame, turns: DataFrame, *, keys: Sequence[str] = ("recording_id", "model"), preview: int = 400) -> DataFrame:
    """Per speaker: time by turns, words and first text by segments; a speaker of either is there."""
    said = segments.withColumn("__t", scalar.strip("text"))
    place = F.struct("start_ms", "end_ms", "seg_seq")
    by_text = said.groupBy(*keys, "speaker").agg(
        F.sum(scalar.word_count("text")).alias("transcript_word_count"),
        F.min_by(F.left("__t", F.lit(preview)), F.when(F.col("__t") != "", place)).alias("__first"),
        F.max((F.col("__t") != "").cast("int")).alias("__any"),
    )
    others = [k for k in keys if k != "recording_id"]
    time = turns.groupBy("recording_id", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("diarized_ms"))
    models = segments.select(*keys).distinct()
    timed = models.join(time, "recording_id") if others else time
    both = timed.join(by_text, [*keys, "speaker"], "full_outer")
    return both.select(
        *keys,
        F.col("speaker").alias("speaker_raw"),
        scalar.speaker_label("speaker").alias("speaker"),
        F.coalesce("diarized_ms", F.lit(0)).cast("long").alias("diarized_ms"),
        F.coalesce("transcript_word_count", F.lit(0)).cast("long").alias("transcript_word_count"),
        F.when(F.col("__any") == 1, F.col("__first")).otherwise("").alias("first_sample_text"),
    )


def speaker_shares(turns: DataFrame) -> DataFrame:
    """Each speaker's time and percent of all turns of a recording."""
    time = turns.groupBy("recording_id", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"))
    return time.withColumn("share_pct", scalar.share(F.col("speech_ms"), F.sum("speech_ms").over(Window.partitionBy("recording_id"))))


def segment_distribution(segments: DataFrame, *, keys: Sequence[str] = ("recording_id", "model")) -> DataFrame:
    """Segments, words and time of each speaker."""
    return segments.groupBy(*keys, "speaker").agg(
        F.count("*").alias("segments"), F.sum(scalar.word_count("text")).alias("words"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("span_ms")
    )

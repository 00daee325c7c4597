"""Text detectors over segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.fixed import CORRECTIONS, OPPOSITES, PATTERNS
from .rangejoin import band_join


def correct_segments(segments: DataFrame, corrections: Mapping[str, str] = CORRECTIONS) -> DataFrame:
    return segments.withColumn("text", scalar.correct("text", corrections))


def unsaid(segments: DataFrame, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """Segments with text that no one said, one row each: the first pattern and what it matched."""
    found = segments.withColumn("__m", scalar.first_match("text", patterns)).where("__m is not null")
    return found.withColumn("pattern", F.col("__m.pattern")).withColumn("matched_text", F.col("__m.matched")).withColumnRenamed("text", "segment_text").drop("__m")


def inversions(first: DataFrame, second: DataFrame, *, band_ms: int = 3000, opposites: Mapping[str, str] = OPPOSITES) -> DataFrame:
    """Words of ``first`` whose opposite ``second`` heard at the same time.

    Times are those of the segments. For each word and prefix the first such word of the other
    model, by time and then by text, is named. Both sides are filtered to words with a
    prefix before they meet.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(o).alias("opposite")) for p, o in opposites.items()]))
    said = first.select("recording_id", "seg_seq", F.col("start_ms").alias("time_ms"), "speaker", F.posexplode(scalar.words_of("text")).alias("pos", "word"))
    said = said.where(" or ".join(f"contains(lower(word), '{p}')" for p in opposites)).withColumn("p", pairs)
    said = said.select("*", "p.*").drop("p").where("contains(lower(word), prefix)")
    heard = second.select("recording_id", F.col("start_ms").alias("at"), F.explode(scalar.words_of(F.lower("text"))).alias("other"))
    heard = heard.where(" or ".join(f"contains(other, '{p}')" for p in opposites))
    met = band_join(said, heard, ["recording_id"], "time_ms", "at", band_ms).where("contains(other, opposite) and not contains(other, prefix)")
    best = met.groupBy("recording_id", "seg_seq", "pos", "prefix", "opposite", "time_ms", "speaker", "word").agg(F.min(F.struct("at", "other")).alias("b"))
    return best.select("recording_id", "seg_seq", "pos", "time_ms", scalar.speaker_label("speaker").alias("speaker"), "prefix", F.col("word").alias("first_word"), F.col("b.other").alias("second_word"))

"""Overlap removal by ownership of time, and words from hypotheses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar


def flatten_hypotheses(hypotheses: DataFrame, *, keys: Sequence[str] = ("recording_id", "model")) -> DataFrame:
    """Words in recording time from ``keys, window_idx, start, end, hypothesis`` in seconds.

    ``text, abs_start, abs_end, window_idx, window_center``: a word without an end ends where it
    starts, one without a start starts with its window; empty words go, and so does a failed
    window, whose hypothesis is null.
    """
    timed = hypotheses.select(*keys, "window_idx", F.col("start").alias("ws"), F.col("end").alias("we"), F.posexplode(scalar.hypothesis_words("hypothesis")).alias("pos", "w"))
    at = F.coalesce("w.start", F.lit(0.0))
    return timed.select(
        *keys, "window_idx", "pos",
        scalar.strip("w.word").alias("text"),
        (F.col("ws") + at).alias("abs_start"),
        (F.col("ws") + F.coalesce("w.end", at)).alias("abs_end"),
        ((F.col("ws") + F.col("we")) / 2).alias("window_center"),
    ).where("text <> ''")


def owned_ranges(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, window_idx, low4, high4``: the stretch that each window owns, in quarter milliseconds.

    Only windows that gave a word own time: an empty or failed one leaves it to its
    neighbours. The ends are open (null).
    """
    windows = words.groupBy(*keys, "window_idx").agg(F.max_by("center2_ms", "seq").alias("c2"), F.min("seq").alias("first_seq"))
    w = Window.partitionBy(*keys).orderBy("c2", "first_seq")
    return windows.select(*keys, "window_idx", (F.lag("c2").over(w) + F.col("c2")).alias("low4"), (F.col("c2") + F.lead("c2").over(w)).alias("high4"))


def merge_overlaps(words: DataFrame, *, keys: Sequence[str] = ("recording_id", "model")) -> DataFrame:
    """Of words that overlapping windows heard, those whose start their own window owns.

    ``center2_ms`` is twice the window's centre, so ownership needs no fraction.
    """
    owned = words.join(owned_ranges(words, keys).hint("shuffle_hash"), [*keys, "window_idx"])  # a row a window, so words need no sort
    at = 4 * F.col("start_ms")
    mine = (F.col("low4").isNull() | (F.col("low4") <= at)) & (F.col("high4").isNull() | (at < F.col("high4")))
    return owned.where(mine).drop("low4", "high4")

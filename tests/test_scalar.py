"""Scalar rules: labels, clocks, text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chronoweave.functions import fixed, scalar


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(make(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("raw", "shown"),
    [("SPEAKER_00", "Speaker 1"), ("SPEAKER_11", "Speaker 12"), ("A_02_x", "Speaker 3"), (None, "Speaker ?"), ("", "Speaker ?"), ("SPEAKER_UNKNOWN", "Speaker ?"), ("WEIRD", "WEIRD"), ("SPEAKER_x", "SPEAKER_x")],
)
def test_speaker_label(spark, raw, shown):
    assert one(spark, raw, scalar.speaker_label) == shown


@pytest.mark.parametrize(("ms", "shown"), [(0, "00:00:00"), (59_999, "00:00:59"), (3_661_000, "01:01:01"), (360_000_000, "100:00:00")])
def test_clock_cuts(spark, ms, shown):
    assert one(spark, ms, scalar.clock, "long") == shown


@pytest.mark.parametrize(("ms", "shown"), [(0, "00:00:00,000"), (1_005, "00:00:01,005"), (3_725_040, "01:02:05,040")])
def test_subtitle_clock(spark, ms, shown):
    assert one(spark, ms, scalar.subtitle_clock, "long") == shown


@pytest.mark.parametrize(("s", "shown"), [(59.9996, "00:00:60,000"), (1.0005, "00:00:01,000"), (3661.25, "01:01:01,250")])
def test_subtitle_clock_of_seconds_does_not_carry(spark, s, shown):
    assert one(spark, s, scalar.subtitle_clock_seconds, "double") == shown


def test_text_rules(spark):
    assert one(spark, "It's 5 O'Clock!", scalar.letters_and_digits) == "its5oclock"
    assert one(spark, "  a b \n", scalar.strip) == "a b"
    assert one(spark, " a b \n c ", scalar.word_count) == 3
    assert one(spark, "one\ntwo \n", scalar.last_line) == "two"
    assert one(spark, None, scalar.last_line) == ""


def test_corrections_are_ordered_and_bounded(spark):
    fix = lambda rules: lambda c: scalar.correct(c, rules)
    assert one(spark, "insightful singing in", fix({"in": "OUT"})) == "insightful singing OUT"
    assert one(spark, "alpha", fix({"alpha": "beta", "beta": "gamma"})) == "gamma"
    assert one(spark, "cost x", fix({"x": "$1 \\"})) == "cost $1 \\"
    assert one(spark, "A.B aXb", fix({"a.b": "ok"})) == "ok aXb"
    assert one(spark, "the Spring and BROUX", fix(fixed.CORRECTIONS)) == "the Spiering and Bruch's"
    assert len(fixed.CORRECTIONS) == 53 and len(fixed.PATTERNS) == 12


def test_first_pattern_in_order(spark):
    found = one(spark, "[Music] thank you for watching", lambda c: scalar.first_match(c, fixed.PATTERNS))
    assert (found.pattern, found.matched) == (fixed.PATTERNS[0], "thank you for watching")
    assert one(spark, "nothing", lambda c: scalar.first_match(c, fixed.PATTERNS)) is None
    assert one(spark, "nothing", lambda c: scalar.first_match(c, [])) is None


def test_model_names_and_paths(spark):
    assert one(spark, "a.Parakeet.canary.json", scalar.model_of) == "canary"
    assert one(spark, "x.parakeet.json", scalar.model_of) == "parakeet"
    assert one(spark, "x", scalar.model_of) == "model"
    assert one(spark, "x", lambda c: scalar.output_path(c, F.lit("m"), F.lit(".srt"))) == "x.m.srt"


def test_poll_parts(spark):
    got = one(spark, "RUNNING\n---progress---\nline 1\n", scalar.poll_parts)
    assert (got.status, got.progress) == ("RUNNING", "line 1")
    assert one(spark, "DONE", scalar.poll_parts).progress is None


def test_hypothesis_shape(spark):
    from pyspark.errors import PySparkException

    kind = "h struct<timestamp: struct<word: array<struct<word: string, start: double, end: double>>>>"
    good = spark.createDataFrame([(((([("a", 0.0, 1.0)],),)),), ((([],),),)], kind)
    assert good.select(scalar.checked_hypothesis("h", "m").alias("h")).count() == 2
    assert [len(r[0]) for r in good.select(scalar.hypothesis_words("h")).collect()] == [1, 0]
    none = spark.createDataFrame([(None,)], kind)
    assert none.select(scalar.hypothesis_words("h")).first()[0] == []
    with pytest.raises(PySparkException, match="no hypothesis"):
        none.select(scalar.checked_hypothesis("h", "m").alias("h")).collect()
    part = spark.createDataFrame([(((([("a", None, 1.0)],),)),)], kind)
    with pytest.raises(PySparkException, match="lacks"):
        part.select(scalar.checked_hypothesis("h", "m").alias("h")).collect()

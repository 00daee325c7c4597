"""Scalar expressions: labels, clock formats, text rules. All are built-in Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixed import UNKNOWN_SPEAKER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def speaker_label(speaker: Column | str) -> Column:
    """``Speaker N`` from an id whose second part between underscores is a number from 0.

    Missing and unknown speakers are ``Speaker ?``; other ids stay. Only ASCII digits count.
    """
    c = _col(speaker)
    part = F.get(F.split(c, "_"), F.lit(1))
    n = F.trim(part).try_cast("int") + 1
    known = F.when(n.isNotNull(), F.concat(F.lit("Speaker "), n.cast("string"))).otherwise(c)
    return F.when(c.isNull() | (c == "") | (c == UNKNOWN_SPEAKER), "Speaker ?").otherwise(known)


def clock(ms: Column | str) -> Column:
    """``HH:MM:SS``, cut to the second."""
    s = F.floor(_col(ms) / 1000).cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def subtitle_clock(ms: Column | str) -> Column:
    """``HH:MM:SS,mmm`` of whole milliseconds."""
    m = _col(ms).cast("long")
    return F.concat(clock(m), F.lit(","), F.lpad((m % 1000).cast("string"), 3, "0"))


@F.pandas_udf(T.StringType())
def subtitle_clock_seconds(seconds: pd.Series) -> pd.Series:
    """``HH:MM:SS,mmm`` of seconds in a double, for writers only; in batches, as no built-in rounds alike.

    Rounding is that of the exact binary value and does not carry into the minute: 59.9996 is ``00:00:60,000``.
    """
    return seconds.map(lambda s: f"{int(s // 3600):02d}:{int(s % 3600 // 60):02d}:{s % 60:06.3f}".replace(".", ","), na_action="ignore")


def letters_and_digits(text: Column | str) -> Column:
    return F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]", "")


def strip(text: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")


def word_count(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def words_of(text: Column | str) -> Column:
    return F.filter(F.split(_col(text), r"(?U)\s+"), lambda w: w != "")


def linear_gain(db: Column | str) -> Column:
    return F.pow(F.lit(10.0), _col(db) / 20)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.least(e1, e2) - F.greatest(s1, s2)


def share(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """Percent, ``empty`` where there is no whole."""
    return F.when(whole == 0, F.lit(empty)).otherwise(part * F.lit(100.0) / F.when(whole == 0, F.lit(1)).otherwise(whole))


def correct(text: Column | str, corrections: Mapping[str, str]) -> Column:
    """Whole words replaced in order, whatever their case; a later rule sees what earlier ones left."""

    def one(c: Column, rule: tuple[str, str]) -> Column:
        heard, meant = rule
        literal = "".join("\\" + x if not x.isalnum() and x not in "_ " else x for x in heard)
        return F.regexp_replace(c, rf"(?iu)\b{literal}\b", re.sub(r"([\\$])", r"\\\1", meant))

    if not corrections:
        return _col(text)
    # Texts that no rule finds as they are stay: one search for all of them.
    any_of = "|".join("".join("\\" + x if not x.isalnum() and x not in "_ " else x for x in heard) for heard in corrections)
    return F.when(_col(text).rlike(rf"(?iu)\b(?:{any_of})\b"), reduce(one, corrections.items(), _col(text))).otherwise(_col(text))


def first_match(text: Column | str, patterns: Sequence[str]) -> Column:
    """``struct(pattern, matched)`` of the first pattern, in the order given, that is found; else null."""
    c = _col(text)
    if not patterns:
        return F.lit(None).cast("struct<pattern: string, matched: string>")
    found = [F.when(c.rlike(p), F.struct(F.lit(p).alias("pattern"), F.regexp_extract(c, p, 0).alias("matched"))) for p in patterns]
    return F.coalesce(*found)


def model_of(name: Column | str) -> Column:
    """The model that a file name tells of."""
    c = F.lower(_col(name))
    return F.when(c.contains("canary"), "canary").when(c.contains("parakeet"), "parakeet").otherwise("model")


def last_line(text: Column | str) -> Column:
    return F.element_at(F.split(strip(F.coalesce(_col(text), F.lit(""))), "\n"), -1)


def eta(spent: Column, done: Column, total: Column) -> Column:
    return F.try_divide(spent, done) * (total - done)


def poll_parts(output: Column | str) -> Column:
    """``struct(status, progress)`` of a poll: its first line, and what follows the progress mark."""
    c = _col(output)
    status = strip(F.element_at(F.split(strip(c), "\n"), 1))
    progress = F.when(c.contains("---progress---"), strip(F.element_at(F.split(c, "---progress---", 2), 2)))
    return F.struct(status.alias("status"), progress.alias("progress"))


def hypothesis_words(hypothesis: Column | str) -> Column:
    """The timed words of a hypothesis; an empty array where there are none."""
    return F.coalesce(_col(hypothesis)["timestamp"]["word"], F.expr("array()").cast("array<struct<word: string, start: double, end: double>>"))


def checked_hypothesis(hypothesis: Column | str, model: str) -> Column:
    """The hypothesis, or an error where it has no timed words in the shape that is needed."""
    c = _col(hypothesis)
    first = F.get(c["timestamp"]["word"], F.lit(0))
    bad = (
        F.when(c.isNull(), f"{model}: no hypothesis")
        .when(c["timestamp"].isNull(), f"{model}: no timestamps")
        .when(c["timestamp"]["word"].isNull(), f"{model}: no words among the timestamps")
        .when((F.size(c["timestamp"]["word"]) > 0) & (first["word"].isNull() | first["start"].isNull() | first["end"].isNull()), f"{model}: a word lacks its text, start or end")
    )
    return F.when(bad.isNotNull(), F.raise_error(bad)).otherwise(c)


def output_path(base: Column | str, model: Column | str, suffix: Column | str) -> Column:
    return F.concat(F.concat_ws(".", _col(base), _col(model)), _col(suffix))

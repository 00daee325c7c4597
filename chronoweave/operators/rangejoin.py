"""Interval and band joins as equi-joins on time buckets.

A join on ranges alone compares all rows of a key with each other. Here both sides are laid
out over buckets of ``width``, so that the join is on (key, bucket): a long recording spreads
over its buckets, and a pair is kept in one bucket only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def over_buckets(df: DataFrame, low: str, high: str, width: int) -> DataFrame:
    """Each row once for every bucket that its range touches, with ``__bucket``."""
    first, last = F.floor(F.col(low) / width).cast("long"), F.floor(F.col(high) / width).cast("long")
    return df.withColumn("__bucket", F.explode(F.sequence(first, F.greatest(first, last))))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, width: int, left_range: tuple[str, str] = ("l_start", "l_end"), right_range: tuple[str, str] = ("r_start", "r_end")) -> DataFrame:
    """Pairs of equal ``keys`` whose ranges overlap by more than nothing.

    Ranges that only touch, and empty ones at another's edge, do not overlap; an empty range
    strictly inside another does not either, its overlap being 0. Other columns must differ.
    """
    (ls, le), (rs, re) = [tuple(map(F.col, r)) for r in (left_range, right_range)]
    a = over_buckets(left.where(le > ls), *left_range, width)
    b = over_buckets(right.where(re > rs), *right_range, width)
    first = F.floor(F.greatest(ls, rs) / width).cast("long") == F.col("__bucket")
    return a.join(b, [*keys, "__bucket"]).where((ls < re) & (rs < le) & first).drop("__bucket")


def clip_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, width: int, left_range: tuple[str, str] = ("l_start", "l_end"), right_range: tuple[str, str] = ("r_start", "r_end")) -> DataFrame:
    """Like :func:`interval_join`, but an empty range strictly inside another pairs with it."""
    (ls, le), (rs, re) = [tuple(map(F.col, r)) for r in (left_range, right_range)]
    a = over_buckets(left, *left_range, width)
    b = over_buckets(right, *right_range, width)
    first = F.floor(F.greatest(ls, rs) / width).cast("long") == F.col("__bucket")
    return a.join(b, [*keys, "__bucket"]).where((ls < re) & (rs < le) & first).drop("__bucket")


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_at: str, right_at: str, band: int) -> DataFrame:
    """Pairs of equal ``keys`` at most ``band`` apart, ends included."""
    size = max(1, band)
    a = left.withColumn("__bucket", F.explode(F.array(*[F.floor(F.col(left_at) / size).cast("long") + i for i in (-1, 0, 1)])))
    b = right.withColumn("__bucket", F.floor(F.col(right_at) / size).cast("long"))
    return a.join(b, [*keys, "__bucket"]).where(F.abs(F.col(left_at) - F.col(right_at)) <= band).drop("__bucket")


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], ids: Sequence[str], left_at: str, right_at: str, band: int) -> DataFrame:
    """``keys, ids, right_at``: the nearest of ``right`` within ``band``; of two as near, the earlier."""
    pairs = band_join(left, right.select(*keys, right_at), keys, left_at, right_at, band)
    return pairs.groupBy(*keys, *ids).agg(F.min_by(right_at, F.struct(F.abs(F.col(left_at) - F.col(right_at)), F.col(right_at))).alias(right_at))

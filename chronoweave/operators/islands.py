"""Gaps and islands over ordered rows of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def change_islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str = "island") -> DataFrame:
    """``df`` with the running number of its run of equal ``value``, from 0; null equals null."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = F.when(F.row_number().over(w) == 1, 0).when(F.lag(value).over(w).eqNullSafe(value), 0).otherwise(1)
    return df.withColumn("__changed", changed).withColumn(name, F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__changed")


def interval_union(df: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """Maximal intervals of a key; touching ones are one."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = df.withColumn("__new", F.when(F.col(start) <= reach, 0).otherwise(1))
    numbered = opened.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__run")


def interval_gaps(spans: DataFrame, covered: DataFrame, keys: Sequence[str], start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """What disjoint ``covered`` intervals leave of the one span of each key; zero lengths too."""
    outer = spans.select(*keys, F.col(start).alias("__a"), F.col(end).alias("__b"))
    both = outer.join(covered.select(*keys, F.col(start).alias("__s"), F.col(end).alias("__e")), list(keys), "left")
    w = Window.partitionBy(*keys).orderBy("__s")
    before = both.where("__s is not null").select(*keys, F.coalesce(F.lag("__e").over(w), F.col("__a")).alias(start), F.col("__s").alias(end))
    after = both.groupBy(*keys, "__a", "__b").agg(F.max("__e").alias("__last")).select(*keys, F.coalesce("__last", "__a").alias(start), F.col("__b").alias(end))
    return before.unionByName(after)

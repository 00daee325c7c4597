"""Control-plane queries: picking an offer, watching polls, missing outputs, progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.fixed import MODEL_SUFFIXES, MODELS, SHARED_SUFFIXES
from .islands import change_islands


def pick_offers(offers: DataFrame, keys: Sequence[str] = (), *, least_reliability: float = 0.985, least_down: float = 800.0) -> DataFrame:
    """The best offer of each key, or of all.

    Data centres come first where there are any, then those above the quality floor where
    there are any, then the cheapest; a missing price counts as 999, ties keep their order. No
    offers at all is an error where the row is asked for; a key without any has no row.
    """
    passes = (F.coalesce("reliability2", F.lit(0.0)) >= least_reliability) & (F.coalesce("inet_down", F.lit(0.0)) >= least_down)
    best = F.struct(*[(-c if i else c).alias(f"o{i}") for i, c in enumerate([F.col("is_dc").cast("int") * 2 + passes.cast("int"), F.coalesce("dph_total", F.lit(999.0)), F.col("seq")])])
    if not keys:
        one = offers.agg(F.max_by(F.struct(*offers.columns), best).alias("__o"))
        return one.select(F.when(F.col("__o").isNull(), F.raise_error(F.lit("no offers"))).otherwise(F.col("__o")).alias("__o")).select("__o.*")
    picked = offers.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in offers.columns if c not in keys]), best).alias("__o"))
    return picked.select(*keys, "__o.*")


def runs_of(polls: DataFrame, value: str, *, keys: Sequence[str] = ("instance_id",), order: Sequence[str] = ("seq",)) -> DataFrame:
    """Runs of equal values: ``keys, run, value, first_seq, polls``."""
    marked = change_islands(polls, keys, order, F.col(value), "run")
    return marked.groupBy(*keys, F.col("run").cast("long").alias("run")).agg(F.first(value).alias(value), F.min(order[0]).alias("first_seq"), F.count("*").alias("polls"))


def verdicts(polls: DataFrame, *, repeats: int = 4, deadline_ms: int | None = None, at: str = "at_ms") -> DataFrame:
    """The first verdict on each instance, ``instance_id, seq, verdict, msg``, as the watch of a stream gives it.

    ``offline`` at once; ``ready`` where it runs with an address; ``stuck`` where the same retry message
    comes ``repeats`` times more. Polls with an ``error`` are passed over. With ``deadline_ms`` an
    instance that is polled so long after its first poll (by ``at``) without a verdict is ``late``.
    """
    there = polls.where("error is null") if "error" in polls.columns else polls
    said = there.withColumn("msg", scalar.last_line("status_msg"))
    retry = F.lower("msg").contains("retrying") & (F.col("msg") != "")
    runs = change_islands(said, ["instance_id"], ["seq"], F.col("msg"), "run").withColumn("retry", retry)
    nth = runs.withColumn("nth", F.row_number().over(Window.partitionBy("instance_id", "run").orderBy("seq")))
    address = [F.col(c).isNotNull() & ~F.col(c).cast("string").isin("", "0") if c in polls.columns else F.lit(False) for c in ("ssh_host", "ssh_port")]
    verdict = (
        F.when(F.col("actual_status") == "offline", "offline")
        .when((F.col("actual_status") == "running") & address[0] & address[1], "ready")
        .when(F.col("retry") & (F.col("nth") == repeats + 1), "stuck")
    )
    found = nth.withColumn("verdict", verdict)
    if deadline_ms is not None:
        found = found.withColumn("__late", F.col(at) - F.min(at).over(Window.partitionBy("instance_id")) >= deadline_ms)
        found = found.withColumn("verdict", F.when(F.col("__late"), "late").otherwise(F.col("verdict"))).withColumn("__seq", F.when(F.col("__late"), -1).otherwise(F.col("seq")))
    else:
        found = found.withColumn("__seq", F.col("seq"))
    best = found.where("verdict is not null").groupBy("instance_id").agg(F.min_by(F.struct(F.col("__seq").alias("seq"), "verdict", "msg"), "seq").alias("v"))
    return best.select("instance_id", "v.seq", "v.verdict", "v.msg")


def stuck(polls: DataFrame, *, repeats: int = 4) -> DataFrame:
    """First poll of each instance at which it is stuck: the same retry message ``repeats`` times more."""
    return verdicts(polls, repeats=repeats).where("verdict = 'stuck'").select("instance_id", "seq", "msg")


def changes(df: DataFrame, value: str, *, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows whose value differs from the one before; a key's first row is one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("__n", F.row_number().over(w)).withColumn("__p", F.lag(value).over(w))
    return marked.where((F.col("__n") == 1) | ~F.col("__p").eqNullSafe(F.col(value))).drop("__n", "__p")


def expected_outputs(bases: DataFrame, *, models: Sequence[str] = tuple(MODELS)) -> DataFrame:
    """``base, file``: the outputs that a complete run has; a fixed list for each base."""
    shared = F.array(*map(F.lit, SHARED_SUFFIXES))
    own = F.array(*[F.lit(f".{m}{s}") for m in models for s in MODEL_SUFFIXES])
    return bases.select("base", F.explode(F.concat(shared, own)).alias("suffix")).select("base", F.concat("base", "suffix").alias("file"))


def missing_outputs(bases: DataFrame, present: DataFrame) -> DataFrame:
    return expected_outputs(bases).join(present.select("file"), "file", "left_anti").select("base", "file")


def latest(df: DataFrame, n: int, *, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The last ``n`` rows of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)

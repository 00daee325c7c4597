"""Silences of a recording, and windows whose edges lie in them."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .islands import change_islands


def silences(frames: DataFrame, *, loud: Column, frame_ms: int, least_ms: int, keys: Sequence[str] = ("recording_id",), lengths: DataFrame | None = None) -> DataFrame:
    """``keys, start_ms, end_ms`` of runs of frames that are not ``loud``, ``least_ms`` long or more.

    ``frames`` has ``frame_idx`` without gaps. A run that lasts to the end goes to the length in
    ``lengths (keys, duration_ms)``, which may lie behind the last whole frame, or else to the
    last frame's end.
    """
    marked = change_islands(frames.withColumn("__loud", loud), keys, ["frame_idx"], F.col("__loud"), "__run")
    runs = marked.where(~F.col("__loud")).groupBy(*keys, "__run").agg(F.min("frame_idx").alias("a"), F.max("frame_idx").alias("b"))
    if lengths is None:
        out = runs.select(*keys, (F.col("a") * frame_ms).alias("start_ms"), ((F.col("b") + 1) * frame_ms).alias("end_ms"))
    else:
        last = frames.groupBy(*keys).agg(F.max("frame_idx").alias("__last")).join(lengths.select(*keys, "duration_ms"), list(keys))
        end = F.when(F.col("b") == F.col("__last"), F.col("duration_ms")).otherwise((F.col("b") + 1) * frame_ms)
        out = runs.join(last, list(keys)).select(*keys, (F.col("a") * frame_ms).alias("start_ms"), end.alias("end_ms"))
    return out.where(F.col("end_ms") - F.col("start_ms") >= least_ms)


def window_grid(recordings: DataFrame, *, window: int, step: int, most: int = 10_000, least_tail: int = 300) -> DataFrame:
    """Windows of recordings without silences, in closed form: ``recording_id, window_idx, start_ms, end_ms``."""
    n = F.col("duration_ms")
    last = F.least(F.lit(most - 1), F.greatest(F.lit(0), F.ceil((n - window) / step))).cast("int")
    grid = recordings.where(n > 0).select("recording_id", "duration_ms", F.explode(F.sequence(F.lit(0), last)).alias("window_idx"))
    start = F.col("window_idx").cast("long") * step
    out = grid.select("recording_id", "window_idx", start.alias("start_ms"), F.least(start + window, n).alias("end_ms"))
    return out.where((F.col("window_idx") > 0) | (F.col("end_ms") - F.col("start_ms") >= least_tail))


def plan_one(length: int, mids: list[int], *, window: int, overlap: int, least_overlap: int, tolerance: int, most: int = 10_000, least_tail: int = 300) -> list[tuple[int, int]]:
    """Windows of one recording; ``mids`` are the middles of its silences, in order."""

    def snap(to: int) -> int:
        i = bisect_left(mids, to)
        near = [m for m in mids[max(0, i - 1) : i + 1] if abs(m - to) <= tolerance]
        return min(near, key=lambda m: (abs(m - to), m), default=to)

    found: list[tuple[int, int]] = []
    at = 0
    while at < length and len(found) < most:
        end = length if at + window >= length else snap(at + window)
        found.append((at, end))
        if end >= length:
            break
        onward = min(snap(end - overlap), end - least_overlap)
        at = onward if onward > at else at + max(1, (window - overlap) // 2)
    while found and found[-1][1] - found[-1][0] < least_tail:
        found.pop()
    return found


def window_plan(recordings: DataFrame, silent: DataFrame, *, window: int, overlap: int, least_overlap: int, tolerance: int, most: int = 10_000, least_tail: int = 300) -> DataFrame:
    """Windows whose edges snap to silences: ``recording_id, window_idx, start_ms, end_ms``.

    Where a window starts depends on where the last one ended, so a recording is planned in one
    pass; recordings are planned side by side, many in a batch. At most ``most`` windows are
    planned; :func:`unplanned` tells the recordings that have more.
    """
    mid = F.floor((F.col("start_ms") + F.col("end_ms")) / 2).cast("long")
    mids = silent.groupBy("recording_id").agg(F.array_sort(F.collect_list(mid)).alias("mids"))
    both = recordings.groupBy("recording_id").agg(F.max("duration_ms").alias("duration_ms")).join(mids, "recording_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rec, length, near in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if length is None:
                    continue
                found = plan_one(length, near or [], window=window, overlap=overlap, least_overlap=least_overlap, tolerance=tolerance, most=most, least_tail=least_tail)
                starts, ends = zip(*found, strict=True) if found else ((), ())
                yield pa.RecordBatch.from_pydict({"recording_id": pa.array([rec] * len(found), pa.int64()), "window_idx": pa.array(range(len(found)), pa.int32()), "start_ms": pa.array(starts, pa.int64()), "end_ms": pa.array(ends, pa.int64())})

    return both.select(F.col("recording_id").cast("long"), F.col("duration_ms").cast("long"), "mids").mapInArrow(run, "recording_id long, window_idx int, start_ms long, end_ms long")


def unplanned(recordings: DataFrame, windows: DataFrame, *, least_tail: int = 300) -> DataFrame:
    """``recording_id, duration_ms, planned_ms`` of recordings whose windows end before them.

    More than a tail is left where a plan reached its number of windows.
    """
    ends = windows.groupBy("recording_id").agg(F.max("end_ms").alias("planned_ms"))
    both = recordings.select("recording_id", "duration_ms").join(ends, "recording_id", "left").withColumn("planned_ms", F.coalesce("planned_ms", F.lit(0)).cast("long"))
    return both.where(F.col("duration_ms") - F.col("planned_ms") >= least_tail)


def in_batches(windows: DataFrame, size: int) -> DataFrame:
    """Windows with ``batch_idx`` and their place in the batch."""
    return windows.withColumn("batch_idx", F.floor(F.col("window_idx") / size).cast("int")).withColumn("in_batch", (F.col("window_idx") % size).cast("int"))

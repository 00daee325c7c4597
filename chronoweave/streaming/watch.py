"""Watching polls as a stream: which hosts are ready, offline or stuck."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "instance_id long, seq long, verdict string, msg string"
STATE = "msg string, repeats int, done boolean, since long"


def step(state: tuple[str, int, bool], row: dict, repeats: int) -> tuple[tuple[str, int, bool], str | None]:
    """The state after a poll, and the verdict it leads to.

    Offline is final at once, running with an address too. The same last line that speaks of
    retrying, ``repeats`` polls in a row after the first, is stuck; any other poll starts
    the count again, one without a status as well. A poll that failed (``error``) changes nothing.
    """
    msg, n, done = state
    if done or row.get("error") is not None:
        return state, None
    said = (row["status_msg"] or "").strip().split("\n")[-1]
    if row["actual_status"] == "offline":
        return (said, n, True), "offline"
    if row["actual_status"] == "running" and row["ssh_host"] and row["ssh_port"]:
        return (said, n, True), "ready"
    n = n + 1 if said and said == msg and "retrying" in said.lower() else 0
    return (said, n, n >= repeats), "stuck" if n >= repeats else None


def watch(polls: DataFrame, *, repeats: int = 4, deadline_ms: int | None = None) -> DataFrame:
    """Verdicts on a stream of polls, one an instance at most; state is one small row each.

    With ``deadline_ms`` an instance without a verdict for so long after its first poll is ``late``,
    however often it answers. :func:`control.verdicts` says the same of a table of polls.
    """
    timeout = GroupStateTimeout.ProcessingTimeTimeout if deadline_ms else GroupStateTimeout.NoTimeout

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs() if deadline_ms else 0
        msg, n, done, since = state.get if state.exists else ("", 0, False, now)
        held = (msg, n, done)
        late = deadline_ms is not None and now - since >= deadline_ms
        if late or state.hasTimedOut:
            if not done:
                yield pd.DataFrame({"instance_id": [key[0]], "seq": [-1], "verdict": ["late"], "msg": [msg]})
            state.update((msg, n, True, since))
            return
        rows = pd.concat(list(batches)).sort_values("seq").astype(object)
        rows = rows.where(rows.notna(), None)
        for row in rows.to_dict("records"):
            held, verdict = step(held, row, repeats)
            if verdict:
                yield pd.DataFrame({"instance_id": [key[0]], "seq": [row["seq"]], "verdict": [verdict], "msg": [held[0]]})
        state.update((*held, since))
        if deadline_ms and not held[2]:
            state.setTimeoutDuration(max(1, deadline_ms - (now - since)))

    return polls.groupBy("instance_id").applyInPandasWithState(run, OUTPUT, STATE, "append", timeout)


def first_good_attempt(attempts: DataFrame, *, retries: int) -> DataFrame:
    """Of each job's attempts ``(job, attempt, ok)`` the first that went well, of ``retries + 1`` at most."""
    return attempts.where((F.col("attempt") <= retries + 1) & F.col("ok")).groupBy("job").agg(F.min("attempt").alias("attempt"))


def last_status(polls: DataFrame) -> DataFrame:
    """Each instance's last status that is known."""
    return polls.where("actual_status is not null").groupBy("instance_id").agg(F.max_by("actual_status", "seq").alias("status"))


def event_windows(events: DataFrame, *, length: str = "30 seconds", step: str = "10 seconds", late: str = "10 minutes") -> DataFrame:
    """Counts of a stream over hopping windows; the windows of a plan without silences (an extension)."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length, step), "event_type").agg(F.count("*").alias("n"))

"""Progress of a streaming run: a row a batch, as a log that only grows."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressLog(StreamingQueryListener):
    """Gives ``write`` one JSON line a batch, and one at the end; counters never fall.

    ``total`` units, where known, give the time that is left at the pace so far.
    """

    def __init__(self, write: Callable[[str], None], total: int | None = None):
        self.write, self.total, self.done, self.spent, self.batches = write, total, 0, 0.0, 0

    def onQueryStarted(self, event) -> None:
        self.write(json.dumps({"query": str(event.id), "state": "started"}))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        wall = (p.durationMs or {}).get("triggerExecution", 0) / 1000
        self.done += p.numInputRows
        self.spent += wall
        left = self.spent / self.done * max(0, self.total - self.done) if self.total and self.done else None
        self.write(json.dumps({"batch_idx": self.batches, "chunks_done": self.done, "total_chunks": self.total, "batch_wall_sec": wall, "cum_sec": self.spent, "eta_sec": left}))
        self.batches += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.write(json.dumps({"state": "failed" if event.exception else "done"}))


def append_batches(stream: DataFrame, path: str, checkpoint: str, *, available: bool = False):
    """Writes a stream of words as they come: each micro-batch is committed as a whole, once.

    A task adds one file to the table, whatever keys its rows have; a folder a key would be a small
    file for each key that comes. With ``available`` the query ends with what is there now.
    """
    out = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if available else out).start()

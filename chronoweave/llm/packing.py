"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. In each round a source is owed its share of a window;
what it is owed and has not sent is its deficit, and it sends in slices of ``QUANTUM``
tokens, so deficits carry from round to round. The sent slices form one stream, which is
cut every ``window`` tokens: no window but the last is short.

A source whose share of a window is ``s`` thus sends once in ``QUANTUM / (s * window)`` windows,
a slice of at least ``QUANTUM`` tokens: the target proportions hold within ``QUANTUM`` tokens a source
over any run of windows, not in each one.

Rounds are grouped into lanes, and a source's share of a lane is the difference of two
rounded running totals, so deficits carry across lanes too. Given the sources' totals, the
place of any token is then a closed form: each task lays out its own documents. Texts are
tokenised once; the ids go to a table that is bucketed by the task that wrote them, where the
totals of ``(task, source)`` come to them: no ids are shuffled, whatever the number of tasks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spread, text_or_empty, write_bucketed, write_table

WINDOW = 2048
#: Tokens that a source sends at least once its deficit allows.
QUANTUM = 512
#: Rounds in a lane.
LANE = 1024
END_ID = 1
#: Sources at most; many more would be no mixture.
MOST_SOURCES = 10_000
BATCH_BYTES = 4 << 20
#: A run of white space that the rank-based encoder is not given.
LONG_SPACE = 100_000
_SPACE = re.compile(r"\s+")


# ---- tokenising ----------------------------------------------------------------------

def ranks_of(vocabulary: str) -> str | None:
    """The file of ranks beside the tokenizer file, where it is there and names the same tokens.

    Asked once, on the driver: every task then takes the encoder that this decides.
    """
    import base64
    import os

    ranked = vocabulary.removesuffix(".json") + ".tiktoken"
    if ranked == vocabulary or not os.path.exists(ranked):
        return None
    from tokenizers import Tokenizer

    with open(ranked, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    exact = Tokenizer.from_file(vocabulary)
    special = {int(i) for i in exact.get_added_tokens_decoder()}
    shown = dict(zip((bytes([b]) for b in range(256)), _byte_letters(), strict=True))
    names = {"".join(shown[bytes([b])] for b in token): rank for token, rank in ranks.items()}
    plain = {t: i for t, i in exact.get_vocab(with_added_tokens=False).items() if i not in special}
    return ranked if {t: i for t, i in names.items() if i not in special} == plain else None


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it can be seen, else the next free one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranked: str | None = None):
    """``text -> ids`` of the tokenizer file ``vocabulary``.

    With a file of its ranks (:func:`ranks_of`), ordinary texts take the faster rank-based
    encoder, whose ids are the same; texts that may have special tokens, or have a
    run of ``LONG_SPACE`` spaces, take the file itself: near a million the other one panics.
    """
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if ranked is None:
        return slow
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranked, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: slow(text) if "<|" in text or has_long_space(text) else fast(text)


def has_long_space(text: str) -> bool:
    """Whether ``LONG_SPACE`` characters of white space follow each other; in one pass."""
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in _SPACE.finditer(text))


def token_table(docs: DataFrame, vocabulary: str, *, end_id: int = END_ID) -> DataFrame:
    """``doc_id, source, part, slot, at, n, ids``: ids of each text and ``end_id``, as 32-bit integers.

    ``part`` is the task that read the document, ``slot`` the number of its source among those of the
    task, and ``at`` the tokens of that source that the task had read before.
    """
    schema = "doc_id long, source string, part int, slot int, at long, n long, ids binary"
    ranked = ranks_of(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, sent, end = encoder(vocabulary, ranked), TaskContext.get().partitionId(), {}, array("I", [end_id]).tobytes()
        slots: dict[str | None, int] = {}

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "source", "part", "slot", "at", "n", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        rows, size = [], 0
        for batch in batches:
            for doc_id, source, text in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                source, ids = source.as_py(), array("I", encode(text.as_py())).tobytes() + end
                rows.append((doc_id.as_py(), source, part, slots.setdefault(source, len(slots)), sent.get(source, 0), len(ids) // 4, ids))
                sent[source] = sent.get(source, 0) + len(ids) // 4
                size += len(ids)
                if size > BATCH_BYTES:
                    yield out(rows)
                    rows, size = [], 0
        if rows:
            yield out(rows)

    return spread(docs).mapInArrow(run, schema)


# ---- the schedule --------------------------------------------------------------------


class Phase:
    """A stretch of the stream in which every source sends in fixed proportion.

    ``sizes[s]`` tokens of source ``s`` from its queue position ``starts[s]`` on fill the stream
    from ``at`` on.
    """

    def __init__(self, sizes: list[int], starts: list[int], at: int, window: int):
        self.sizes, self.starts, self.at, self.window = sizes, starts, at, window
        self.total = sum(sizes)
        self.lanes = max(1, -(-self.total // (window * LANE)))
        self._lane: tuple[int, tuple] | None = None

    def lane_of(self, s: int, x: int) -> int:
        """The lane that has the phase's ``x``-th token of source ``s``."""
        return ((x + 1) * self.lanes - 1) // self.sizes[s]

    def lane(self, lane: int) -> tuple[list[int], int, np.ndarray, np.ndarray]:
        """Queue positions and stream position where it starts; tokens sent by source up to each round, and before each source's turn."""
        if self._lane is None or self._lane[0] != lane:
            lows = [n * lane // self.lanes for n in self.sizes]
            owed = np.array([n * (lane + 1) // self.lanes - low for n, low in zip(self.sizes, lows, strict=True)], np.int64)
            rounds = max(1, -(-int(owed.sum()) // self.window))
            r = np.arange(rounds + 1, dtype=np.int64)
            sent = (2 * owed[:, None] * r + rounds * QUANTUM) // (2 * rounds * QUANTUM) * QUANTUM
            sent = np.minimum(sent, owed[:, None])
            sent[:, -1] = owed
            turns = np.diff(sent, axis=1)
            before = sent[:, :-1].sum(0) + np.cumsum(turns, axis=0) - turns
            self._lane = (lane, (lows, self.at + sum(lows), sent, before))
        return self._lane[1]

    def chunks(self, s: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
        """Where source ``s``'s tokens of the lane go: starts in its queue, starts in the stream.

        A chunk lies in one window.
        """
        lows, at, sent, before = self.lane(lane)
        x, n = sent[s, :-1], np.diff(sent[s])
        full = n > 0
        x, n, g = x[full], n[full], (before[s] + at)[full]
        cuts = (g + n - 1) // self.window - g // self.window
        which = np.repeat(np.arange(len(x)), cuts + 1)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts + 1) - cuts - 1, cuts + 1)
        to = np.where(nth > 0, (g[which] // self.window + nth) * self.window, g[which])
        return x[which] + (to - g[which]) + lows[s] + self.starts[s], to


def schedule(totals: list[int], window: int = WINDOW, weights: list[float] | None = None) -> list[Phase]:
    """Phases for queues of ``totals`` tokens.

    Without ``weights`` the targets are the sources' shares of all tokens and all queues end
    together. With weights a queue ends early or late; each end starts a new phase, in
    which those left share by weight.
    """
    if weights is None:
        return [Phase(totals, [0] * len(totals), 0, window)] if sum(totals) else []
    phases, sent, at = [], [0] * len(totals), 0
    for last in sorted(range(len(totals)), key=lambda s: totals[s] / weights[s]):
        level = totals[last] / weights[last]
        upto = [min(n, max(done, round(level * w))) for n, w, done in zip(totals, weights, sent, strict=True)]
        upto[last] = totals[last]
        sizes = [b - a for a, b in zip(sent, upto, strict=True)]
        if sum(sizes):
            phases.append(Phase(sizes, sent, at, window))
            at, sent = at + sum(sizes), upto
    return phases


def pieces_of(phases: list[Phase], s: int, start: int, end: int) -> Iterator[tuple[int, int, int]]:
    """``queue start, length, stream start`` of the pieces of queue positions ``[start, end)``."""
    for phase in phases:
        low = phase.starts[s]
        a, b = max(start, low), min(end, low + phase.sizes[s])
        if a >= b:
            continue
        for lane in range(phase.lane_of(s, a - low), phase.lane_of(s, b - 1 - low) + 1):
            xs, gs = _chunks(phase, s, lane)
            i, j = max(0, np.searchsorted(xs, a, "right") - 1), np.searchsorted(xs, b, "left")
            x, last = xs[i:j].tolist(), low + phase.sizes[s] * (lane + 1) // phase.lanes
            for k, (x0, g) in enumerate(zip(x, gs[i:j].tolist(), strict=True)):
                x1 = x[k + 1] if k + 1 < len(x) else (int(xs[j]) if j < len(xs) else last)
                p, q = max(a, x0), min(b, x1)
                if p < q:
                    yield p, q - p, g + p - x0


def _chunks(phase: Phase, s: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """The phase's chunks; a task asks for few lanes of a source in a row."""
    cache = phase.__dict__.setdefault("_chunks", {})
    if (s, lane) not in cache:
        if len(cache) > 256:
            cache.clear()
        cache[s, lane] = phase.chunks(s, lane)
    return cache[s, lane]


# ---- the operator --------------------------------------------------------------------


def pack(docs: DataFrame, vocabulary: str, *, window: int = WINDOW, weights: dict[str | None, float] | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, padded_to, ids``.

    A document is the ids of its text (null: empty) and ``end_id``, so an empty text is one
    token. Every id lies in one piece; the pieces of a sequence fill it from offset 0
    without a gap. ``padded_to`` is ``window``, or the tokens in the sequence where their number
    is a power of two. Rows are packed one by one, also those that share an identifier;
    null is a source. Targets are the sources' shares of all tokens unless ``weights`` names
    others. Texts of any length are tokenised whole; other columns are ignored; an empty table
    gives no rows. Each task holds ``LANE`` numbers a source, so more than ``MOST_SOURCES`` are an error.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), text_or_empty())
    tokens = write_bucketed(token_table(plain, vocabulary, end_id=end_id), "pack-tokens", "part")
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    per_part = write_table(tokens.groupBy(name.alias("name"), "part", "slot").agg(F.sum("n").alias("n")), "pack-parts")
    summed = per_part.groupBy("name").agg(F.sum("n").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(summed) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: every task holds their totals")
    totals = sorted(map(tuple, summed))
    sizes = [n for _, n in totals]
    given = None if weights is None else [float(weights[None if n == "null" else n[1:]]) for n, _ in totals]
    everything = sum(sizes)
    # By part, where each of its sources starts in that source's queue, and which source it is.
    place = spark.createDataFrame([(n, i) for i, (n, _) in enumerate(totals)], "name string, queue int")
    based = per_part.withColumn("base", F.sum("n").over(Window.partitionBy("name").orderBy("part")) - F.col("n")).join(F.broadcast(place), "name")
    starts = based.groupBy(F.col("part").alias("of")).agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "base", "queue"))), lambda x: F.struct(x.base.alias("base"), x.queue.alias("queue"))).alias("starts"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, padded_to long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phases = schedule(sizes, window, given)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (*[pa.int64()] * 7, pa.string(), pa.int64(), pa.binary())
            heads = [x.split(" ")[0] for x in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=heads)

        rows: list[tuple] = []
        size = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("doc_id", "source", "queue", "queued", "n", "ids")]
            for row in zip(*cols, strict=True):
                doc_id, source, queue, queued, n, ids = (x.as_py() for x in row)
                for x, length, g in pieces_of(phases, queue, queued, queued + n):
                    own = ids[4 * (x - queued) : 4 * (x - queued + length)]
                    held = min(window, everything - g // window * window)
                    rows.append((doc_id, x - queued, length, zlib.crc32(own), n, g // window, g % window, source, held if held & (held - 1) == 0 else window, own))
                size += len(ids)
                if size > BATCH_BYTES:
                    yield out(rows)
                    rows, size = [], 0
        if rows:
            yield out(rows)

    if not totals:
        return spark.createDataFrame([], schema)
    own = F.get("starts", F.col("slot"))
    queued = tokens.join(starts.hint("shuffle_hash"), F.col("part") == F.col("of"))
    return queued.select("doc_id", "source", own["queue"].alias("queue"), (own["base"] + F.col("at")).alias("queued"), "n", "ids").mapInArrow(run, schema)

"""Finding repeated windows of a corpus: blocks, anchors, and the exchange of candidates.

A window is ``win`` consecutive units (bytes or words) of one document. Its anchor is the least
hash of the ``k``-grams inside, so equal windows have equal anchors and neighbouring windows
mostly share one. The work then goes:

1. Texts are packed into blocks of bounded size, one compressed row each, in a table that is
   bucketed by block: later joins on the block move no text.
2. Each block sends its different anchors, dealt by hash; an anchor that is alone in the
   corpus is dropped, the others go back to their blocks.
3. Each block sends the stretches under repeated anchors, dealt by anchor. A shard indexes
   each different stretch once, at its first place, and the index (a suffix array or an FM-index)
   gives for every window the interval of its occurrences, whose first place decides for all
   runs of the stretch; each window that starts earlier elsewhere goes back to its block.
4. Each block removes the units that such windows cover.

An anchor is sent once a block, and a stretch's text once a parcel, so a passage that very
many documents hold costs one short entry an occurrence and one text a parcel. A task gathers what several
blocks send to one place into one row. An anchor in more than
``hot_blocks`` blocks would gather many different stretches in one shard: its windows are dealt
one by one, by a hash of the whole window.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_bytes, spread, text_or_empty, write_bucketed, write_table

BLOCK_BYTES = 1 << 20
#: Bytes that a task gathers for all buckets or shards before it sends them.
SEND_BYTES = 16 << 20
#: Windows whose hashes are held at once.
PIECE = 1 << 18
#: Anchors that a bucket of step 2 is meant to hold.
BUCKET_ANCHORS = 1 << 20
#: Bytes that a shard indexes at once; stretches of one anchor stay together.
CHUNK_BYTES = 1 << 20
HOT_BLOCKS = 4096
#: Runs of a shard that are looked up at once.
RUNS = 1 << 16
#: Order of a missing identifier: before all others.
NO_ID = -(1 << 63)

_MULT = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def gram_hashes(sym: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive symbols."""
    n = len(sym)
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 4096)
        _powers[:] = [np.cumprod(np.full(size, m, np.uint64)) for m in (_MULT, pow(_MULT, -1, 1 << 64))]
    up, down = _powers
    sums = np.zeros(n + 1, np.uint64)
    np.multiply(sym, down[:n], out=sums[1:])
    np.cumsum(sums, out=sums)
    h = sums[k:] - sums[:-k]
    h *= up[: n - k + 1]
    return _mix(h)


def window_anchors(sym: np.ndarray, k: int, win: int) -> np.ndarray:
    """The least hash of the ``k``-grams in each window of ``win`` symbols."""
    least, span, width = gram_hashes(sym, k), 1, win - k + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least


# ---- units of a block ----------------------------------------------------------------


@dataclass
class Units:
    """The documents of a block as units."""

    #: Bytes of all documents; unit ``i`` is ``body[low[i]:high[i]]``, or byte ``i`` where low is None.
    body: bytes
    sym: np.ndarray | None
    low: np.ndarray | None
    high: np.ndarray | None
    #: First unit of each document, and one past the last of all.
    bounds: np.ndarray

    def slice(self, a: int, b: int) -> bytes:
        return self.body[a:b] if self.low is None else self.body[self.low[a] : self.high[b - 1]]

    def symbols(self, a: int, b: int) -> np.ndarray:
        return _SYMBOLS[np.frombuffer(self.body, np.uint8, b - a, a)] if self.sym is None else self.sym[a:b]


def byte_units(body: bytes, sizes: np.ndarray) -> Units:
    return Units(body, None, None, None, np.concatenate([[0], np.cumsum(sizes)]))


def word_units(body: bytes, sizes: np.ndarray, hashed: bool = True) -> Units:
    """Words of each document, one space between them in ``body``."""
    ends = np.cumsum(sizes).tolist()
    docs = [body[b - a : b].split() for a, b in zip(np.asarray(sizes).tolist(), ends, strict=True)]
    words = [w for d in docs for w in d]
    lens = np.fromiter(map(len, words), np.int64, len(words))
    high = np.cumsum(lens + 1) - 1
    sym = _mix(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))) | np.uint64(1) if hashed else None
    return Units(b" ".join(words), sym, high - lens, high, np.concatenate([[0], np.cumsum([len(d) for d in docs], dtype=np.int64)]))


def anchor_runs(units: Units, k: int, win: int, inner: bool = False) -> tuple[np.ndarray, ...]:
    """``first window, windows, anchor, document, again`` of each run of windows with one anchor.

    With ``inner``, ``again`` says whether the run may hold one window twice: an anchor reaches
    ``win - k + 1`` windows, so a longer run has it twice, and in a shorter one equal windows
    are less than that apart.
    """
    out = []
    total = int(units.bounds[-1])
    for p in range(0, max(0, total - win + 1), PIECE):
        q = min(total, p + PIECE + win - 1)
        least = window_anchors(units.symbols(p, q), k, win)
        new = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        inside = units.bounds[np.searchsorted(units.bounds, p) : np.searchsorted(units.bounds, p + len(least))]
        new[inside - p] = True
        first = np.flatnonzero(new)
        at = first + p
        doc = np.searchsorted(units.bounds, at, "right") - 1
        last = units.bounds[doc + 1] - win
        after = np.append(first[1:], len(least))
        again = after - first > win - k + 1
        if inner:
            run, whole = np.cumsum(new) - 1, gram_hashes(units.symbols(p, q), win)
            for apart in range(1, min(win - k + 1, len(whole))):
                i = np.flatnonzero(whole[:-apart] == whole[apart:])
                again[run[i[run[i] == run[i + apart]]]] = True
        n = np.minimum(after + p, last + 1) - at
        fits = n > 0
        out.append((at[fits], n[fits], least[first[fits]], doc[fits], again[fits]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none, np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


# ---- what an operator fixes ----------------------------------------------------------


@dataclass(frozen=True)
class Task:
    """What is looked for: windows of ``win`` units with anchors of ``k``.

    ``classes(stretches, win)`` numbers the windows of some stretches, equal numbers for equal
    windows. With ``within`` a window also counts as repeated where it starts earlier in the
    same document.
    """

    units: Callable[[bytes, np.ndarray], Units]
    classes: Callable[[list[bytes], int], np.ndarray]
    win: int
    k: int
    within: bool
    hot_blocks: int = HOT_BLOCKS
    block_bytes: int = BLOCK_BYTES
    chunk_bytes: int = CHUNK_BYTES


BLOCK_DDL = "block long, doc_ids array<long>, sizes array<long>, body binary"


def block_table(docs: DataFrame, task: Task) -> DataFrame:
    """Step 1: ``block, doc_ids, sizes, body``, bucketed by block."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n = TaskContext.get().partitionId() << 24, 0
        squeeze = zstandard.ZstdCompressor(level=3)
        ids, texts, held = [], [], 0

        def out() -> pa.RecordBatch:
            cols = ([base + n], [ids], [[len(t) for t in texts]], [squeeze.compress(b"".join(texts))])
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "doc_ids", "sizes", "body"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append(text.as_py().encode())
                held += len(texts[-1])
                if held >= task.block_bytes:
                    yield out()
                    n, ids, texts, held = n + 1, [], [], 0
        if ids:
            yield out()

    rows = spread(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))).mapInArrow(run, BLOCK_DDL)
    return write_bucketed(rows.repartition("block"), "blocks", "block", compression="none")


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n) for n in names), strict=True)


def _units(task: Task, sizes: pa.Scalar, body: pa.Scalar) -> Units:
    return task.units(zstandard.decompress(body.as_py()), sizes.values.to_numpy(zero_copy_only=False))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where an anchor is dealt. Anchors are least hashes, so their own high bits are mostly 0."""
    spread = (h | np.uint64(1)) * np.uint64(_MULT)
    return ((spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def repeated_anchors(blocks: DataFrame, task: Task, buckets: int) -> DataFrame:
    """Step 2: ``block, anchors``: the anchors of the block that occur elsewhere too.

    Sorted 64-bit hashes, their lowest bit set where the anchor is hot. An anchor that
    may occur twice in its block says so by the same bit on its way up.
    """
    one = np.uint64(1)

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            if held:
                cols = ([*held], [[b for b, _ in x] for x in held.values()], [[len(h) for _, h in x] for x in held.values()], [b"".join(h.tobytes() for _, h in x) for x in held.values()])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], names=["bucket", "blocks", "sizes", "anchors"])
            held.clear()

        for block, sizes, body in _rows(batches, ["block", "sizes", "body"]):
            _, _, h, doc, again = anchor_runs(_units(task, sizes, body), task.k, task.win, task.within)
            if not len(h):
                continue
            h = h & ~one
            order = np.lexsort((doc, h))
            h, doc, again = h[order], doc[order], again[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            first = np.flatnonzero(new)
            ends = np.append(first[1:], len(h)) - 1
            twice = (ends > first) | np.logical_or.reduceat(again, first) if task.within else doc[ends] != doc[first]
            h = h[first] | twice.astype(np.uint64)
            bucket = _bucket(h, buckets)
            order = np.argsort(bucket, kind="stable")
            h, bucket = h[order], bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            for low, high in zip(first.tolist(), [*first[1:].tolist(), len(h)], strict=True):
                held.setdefault(int(bucket[low]), []).append((block.as_py(), h[low:high]))
            size += h.nbytes
            if size >= SEND_BYTES:
                yield from sent()
                size = 0
        yield from sent()

    def meet(group: pa.Table) -> pa.Table:
        ids = np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in group.column("blocks")])
        owner = np.repeat(np.arange(len(ids)), np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in group.column("sizes")]))
        h = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in group.column("anchors")])
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] & ~one) != (h[:-1] & ~one)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(h)))
        twice = np.bitwise_or.reduceat(h, first) & one == one
        keep = np.repeat(twice | (count > 1), count)
        marked = (h & ~one) | np.repeat(count > task.hot_blocks, count).astype(np.uint64)
        h, owner = marked[keep], owner[keep]
        order = np.argsort(owner, kind="stable")
        h, owner = h[order], owner[order]
        cut = np.searchsorted(owner, np.arange(len(ids) + 1))
        full = [i for i in range(len(ids)) if cut[i] < cut[i + 1]]
        return pa.table({"block": pa.array([ids[i] for i in full], pa.int64()), "anchors": pa.array([h[cut[i] : cut[i + 1]].tobytes() for i in full], pa.binary())})

    sent = blocks.select("block", "sizes", "body").mapInArrow(up, "bucket long, blocks array<long>, sizes array<long>, anchors binary")
    return sent.groupBy("bucket").applyInArrow(meet, "block long, anchors binary")


def _joined(blocks: DataFrame, replies: DataFrame, column: str, how: str) -> DataFrame:
    """Blocks with all replies to them in one array; a block's replies are bounded by its size."""
    return blocks.join(replies.groupBy("block").agg(F.collect_list(column).alias(column)), "block", how)


# A parcel: what a task sends to a shard. Header, then arrays, then the stretches' bytes.
_HEAD = struct.Struct("<qq")


def _parcel(runs: list[tuple[np.ndarray, ...]], stretches: list[list[bytes]]) -> bytes:
    """Runs ``(sub, at, doc, start, block)`` of several blocks; equal stretches are there once."""
    index: dict[bytes, int] = {}
    which = np.array([index.setdefault(x, len(index)) for own in stretches for x in own], np.uint32)
    sub, at, doc, start, block = (np.concatenate(x) for x in zip(*runs, strict=True))
    subs = np.zeros(len(index), np.uint16)
    subs[which] = sub
    arrays = (subs, which, at, doc, start, block, np.array([len(x) for x in index], np.uint32))
    return zstandard.compress(_HEAD.pack(len(which), len(index)) + b"".join(x.tobytes() for x in arrays) + b"".join(index), 1)


def _opened(data: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    data = zstandard.decompress(data)
    runs, n = _HEAD.unpack_from(data)
    at, arrays = _HEAD.size, []
    for kind, size in ((np.uint16, n), (np.uint32, runs), *[(np.int64, runs)] * 4, (np.uint32, n)):
        arrays.append(np.frombuffer(data, kind, size, at))
        at += arrays[-1].nbytes
    ends = (np.cumsum(arrays.pop(), dtype=np.int64) + at).tolist()
    return arrays, [data[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)]


def earlier_windows(blocks: DataFrame, anchors: DataFrame, task: Task, shards: int) -> DataFrame:
    """Step 3: ``block, windows``: pairs (first window, number) that start earlier elsewhere."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([*held], pa.int64()), pa.array([_parcel(*x) for x in held.values()], pa.binary())], names=["shard", "parcel"])
            held.clear()

        for block, ids, sizes, body, lists in _rows(batches, ["block", "doc_ids", "sizes", "body", "anchors"]):
            units = _units(task, sizes, body)
            known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in lists.as_py()]))
            one = np.uint64(1)
            plain = known & ~one
            first, n, h, doc, _ = anchor_runs(units, task.k, task.win)
            h = h & ~one
            place = np.minimum(np.searchsorted(plain, h), len(plain) - 1)
            keep = plain[place] == h
            first, n, h, doc, hot = first[keep], n[keep], h[keep], doc[keep], (known[place[keep]] & one) == one
            if hot.any():  # window by window, dealt by the whole window
                many = n[hot]
                each = np.repeat(first[hot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                own = np.array([xxhash.xxh64_intdigest(units.slice(a, a + task.win)) for a in each.tolist()], np.uint64)
                first, n, h, doc = (np.concatenate(x) for x in ((first[~hot], each), (n[~hot], np.ones(len(each), np.int64)), (h[~hot], own), (doc[~hot], np.repeat(doc[hot], many))))
            if not len(first):
                continue
            shard = _bucket(h, shards)
            order = np.argsort(shard, kind="stable")
            shard, first, n, h, doc = shard[order], first[order], n[order], h[order], doc[order]
            doc_ids = np.array([NO_ID if x is None else x for x in ids.as_py()], np.int64)[doc]
            sub = ((h >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16)
            start, mine = first - units.bounds[doc], np.full(len(first), block.as_py(), np.int64)
            stretches = [units.slice(a, b) for a, b in zip(first.tolist(), (first + n + task.win - 1).tolist(), strict=True)]
            cut = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(shard)], strict=True):
                runs, texts = held.setdefault(int(shard[low]), ([], []))
                runs.append(tuple(x[low:high] for x in (sub, first, doc_ids, start, mine)))
                texts.append(stretches[low:high])
            size += sum(map(len, stretches))
            if size >= SEND_BYTES:
                yield from sent()
                size = 0
        yield from sent()

    def meet(group: pa.Table) -> pa.Table:
        blocks_, pairs = shard_windows([_opened(x.as_py()) for x in group.column("parcel")], task)
        return pa.table({"block": pa.array(blocks_, pa.int64()), "windows": pa.array([zstandard.compress(w.tobytes(), 1) for w in pairs], pa.binary())})

    sent = _joined(blocks, anchors, "anchors", "inner").mapInArrow(up, "shard long, parcel binary")
    return sent.groupBy("shard").applyInArrow(meet, "block long, windows binary")


def shard_windows(parcels: list, task: Task) -> tuple[list[int], list[np.ndarray]]:
    """Blocks, and for each the pairs (first window, number) of its windows that start earlier elsewhere."""
    index: dict[bytes, int] = {}
    which, at, doc, start, owner, subs = [], [], [], [], [], []
    for arrays, stretches in parcels:
        own = np.array([index.setdefault(x, len(index)) for x in stretches], np.int64)
        stretches.clear()
        subs.append((own, arrays[0]))
        which.append(own[arrays[1]])
        at.append(arrays[2])
        doc.append(arrays[3])
        start.append(arrays[4])
        owner.append(arrays[5])
    which, at, doc, start, owner = (np.concatenate(x) for x in (which, at, doc, start, owner))
    stretches = list(index)
    index.clear()
    sub = np.zeros(len(stretches), np.uint16)
    for own, s in subs:
        sub[own] = s
    windows = np.array([_windows(x, task) for x in stretches], np.int64)
    # The first run of each stretch: its place in the index.
    order = np.lexsort((start, doc, which))
    lead = order[np.append(True, which[order][1:] != which[order][:-1])]
    # The stretches by chunks of whole anchors, one index each.
    by_sub = np.argsort(sub, kind="stable")
    size = np.cumsum([len(stretches[i]) for i in by_sub])
    group_end = np.flatnonzero(np.append(sub[by_sub][1:] != sub[by_sub][:-1], True)) + 1
    low, spent, parts = 0, 0, []
    for end in group_end.tolist():
        if size[end - 1] - spent >= task.chunk_bytes or end == len(by_sub):
            ids, low, spent = by_sub[low:end], end, int(size[end - 1])
            parts.append(_least_places([stretches[i] for i in ids], windows[ids], ids, doc[lead[ids]], start[lead[ids]], task))
    ids, off, num, first_doc, first_start = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(ids, kind="stable")
    ids, off, num, first_doc, first_start = (x[order] for x in (ids, off, num, first_doc, first_start))
    # Every run, stretch by stretch: a window goes where the index knows an earlier place of its words or bytes.
    blocks, found = [], []
    a, b = np.searchsorted(ids, which), np.searchsorted(ids, which, "right")
    for at_run in range(0, len(which), RUNS):
        mine = slice(at_run, at_run + RUNS)
        n = (b - a)[mine]
        each = np.repeat(a[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run = np.repeat(np.arange(at_run, at_run + len(n)), n)
        gone = first_doc[each] < doc[run]
        if task.within:
            gone |= (first_doc[each] == doc[run]) & (first_start[each] < start[run])
        each, run = each[gone], run[gone]
        blocks.append(owner[run])
        found.append(np.stack([at[run] + off[each], num[each]], axis=1))
    own, pairs = np.concatenate(blocks), np.concatenate(found)
    order = np.argsort(own, kind="stable")
    pairs, own = pairs[order], own[order]
    cut = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else []
    return [int(own[i]) for i in cut], np.split(pairs, cut[1:]) if len(own) else []


def _least_places(stretches: list[bytes], n: np.ndarray, ids: np.ndarray, doc: np.ndarray, start: np.ndarray, task: Task) -> tuple[np.ndarray, ...]:
    """For runs of windows of each stretch, where the index has them first: ``stretch, first window, number, document, start``.

    The start is that of a stretch of which these windows have the same offsets, so that it
    compares with the start of any copy. A stretch lies in the index once, at its first place.
    """
    cls = task.classes(stretches, task.win)
    ends = np.cumsum(n)
    of = np.repeat(np.arange(len(n)), n)
    off = np.arange(len(of)) - np.repeat(ends - n, n)
    first_doc, first_start = doc[of], start[of] + off
    order = np.argsort(cls, kind="stable")
    c = cls[order]
    tied = np.zeros(len(c), bool)
    tied[1:] = c[1:] == c[:-1]
    tied[:-1] |= tied[1:].copy()
    pos, c = order[tied], c[tied]  # those of intervals with several places
    if len(pos):
        order = np.lexsort((first_start[pos], first_doc[pos], c))
        head = np.append(True, c[order][1:] != c[order][:-1])
        best = pos[order[head][np.cumsum(head) - 1]]
        first_doc[pos[order]], first_start[pos[order]] = first_doc[best], first_start[best]
    base = first_start - off
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (first_doc[1:] != first_doc[:-1]) | (base[1:] != base[:-1])
    at = np.flatnonzero(new)
    return ids[of[at]], off[at], np.diff(np.append(at, len(of))), first_doc[at], base[at]


def _windows(stretch: bytes, task: Task) -> int:
    units = len(stretch) if task.units is byte_units else stretch.count(b" ") + 1
    return units - task.win + 1


def covered(n: int, lists: list[bytes], win: int) -> np.ndarray:
    """Which of ``n`` units the given windows cover."""
    edge = np.zeros(n + 1, np.int32)
    for x in lists:
        pairs = np.frombuffer(zstandard.decompress(x), np.int64).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs[:, 0] + pairs[:, 1] + win - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def with_windows(docs: DataFrame, task: Task) -> DataFrame:
    """Steps 1 to 3: the blocks, and for each the ``windows`` to remove (null: none)."""
    spark: SparkSession = docs.sparkSession
    bounded_bytes(spark)
    blocks = block_table(docs, task)
    held = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    per_unit = 1 if task.units is byte_units else 6
    anchors = int(2 * held / per_unit / (task.win - task.k + 2))
    # Several a partition, so that partitions come out even and one at a time is in memory.
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), anchors // BUCKET_ANCHORS + 1)
    repeated = write_table(repeated_anchors(blocks, task, buckets), "anchors")
    windows = write_table(earlier_windows(blocks, repeated, task, buckets), "windows")
    return _joined(blocks, windows, "windows", "left")

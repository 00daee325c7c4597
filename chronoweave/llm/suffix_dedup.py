"""Suffix-array dedup: bytes that repeat an earlier document, by two-stage sorting.

:mod:`.passages` brings stretches that may hold equal windows together. Here a suffix array
of them is built in two stages: suffixes smaller than their successors are sorted
directly, the rest is induced by scanning the buckets of first bytes in order; adjacent
suffixes with a common prefix of a window's length then name equal windows. The order need
not go deeper than a window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .passages import Task, _rows, byte_units, covered, with_windows

WIN, K = 50, 16


def _big_endian_words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, so that their order is the order of numbers."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for j in range(8):
        words |= padded[j : j + len(data)] << np.uint64(56 - 8 * j)
    return words


def sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of what starts there, eight bytes at a time, ties only."""
    order = np.argsort(words[places], kind="stable")
    places = places[order]
    key = words[places]
    same = key[1:] == key[:-1]
    for off in range(8, depth, 8):
        tied = np.zeros(len(places), bool)
        tied[1:] |= same
        tied[:-1] |= same
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(np.append(True, ~same))[rows]
        key = words[places[rows] + off]
        order = np.lexsort((key, group))
        places[rows] = places[rows][order]
        key = key[order]
        same = np.zeros(len(places) - 1, bool)
        same[rows[:-1][(group[1:] == group[:-1]) & (key[1:] == key[:-1])]] = True
    return places


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (bytes plus 1, 0 ends a stretch) in order, true to ``depth`` symbols."""
    n = len(text)
    # Whether a suffix is smaller than its successor: by the next place that differs.
    change = np.flatnonzero(text[1:] != text[:-1])
    nearest = change[np.minimum(np.searchsorted(change, np.arange(n)), len(change) - 1)] if len(change) else np.zeros(n, np.int64)
    smaller = text[nearest] < text[np.minimum(nearest + 1, n - 1)]
    smaller[text == 0] = True
    direct = sort_directly(np.flatnonzero(smaller & (text > 0)), words, depth)
    cut = np.searchsorted(text[direct], np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    for c in range(257):
        scan = [np.concatenate(waiting[c])] if waiting[c] else []
        while scan and len(scan[-1]):  # those induced within the bucket follow one another
            before = scan[-1][scan[-1] > 0] - 1
            scan.append(before[(text[before] == c) & ~smaller[before]])
        scan.append(np.flatnonzero(text == 0) if c == 0 else direct[cut[c] : cut[c + 1]])
        bucket = np.concatenate(scan)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & ~smaller[before]]
        if len(before):
            key = text[before]
            order = np.argsort(key, kind="stable")
            before, key = before[order], key[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True):
                waiting[key[a]].append(before[a:b])
    return np.concatenate(out)


def window_classes(stretches: list[bytes], win: int) -> np.ndarray:
    """Numbers of all windows of all stretches, in order; equal numbers for equal windows."""
    data = np.frombuffer(b"\0".join(stretches) + b"\0", np.uint8)
    lens = np.array([len(x) for x in stretches])
    ends = np.cumsum(lens + 1) - 1
    text = data.astype(np.uint16) + 1
    text[ends] = 0
    words = _big_endian_words(np.concatenate([data, np.zeros(win + 8, np.uint8)]))
    place = np.arange(len(data))
    fits = place + win <= np.repeat(ends, lens + 1)
    order = suffix_array(text, words, win)
    order = order[fits[order]]
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    for off in (*range(0, win - 8, 8), max(0, win - 8)):
        same = same[words[a[same] + off] == words[b[same] + off]]
    if win < 8:
        raise ValueError("a window has eight bytes at least")
    new = np.ones(len(order), bool)
    new[same + 1] = False
    numbers = np.empty(len(data), np.int64)
    numbers[order] = np.cumsum(new)
    return numbers[fits]


def task(win: int = WIN, k: int = K, **limits: int) -> Task:
    return Task(byte_units, window_classes, win, k, within=False, **limits)


def remove_repeats(docs: DataFrame, *, win: int = WIN, k: int = K, keep_text: bool = True, **limits: int) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    A byte goes where a string of ``win`` bytes covers it that also starts in a document of a
    smaller doc_id; strings are judged on the input. ``kept`` has the remaining bytes (null
    without ``keep_text``). Null text is empty; a null doc_id is smaller than all others; rows
    of one doc_id do not remove from each other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for ids, sizes, body, windows in _rows(batches, ["doc_ids", "sizes", "body", "windows"]):
            data = zstandard.decompress(body.as_py())
            ids, ends = ids.as_py(), np.cumsum(sizes.values.to_numpy(zero_copy_only=False), dtype=np.int64)
            lists = windows.as_py() or []
            gone = covered(len(data), lists, win) if lists else None
            raw, rows, low = np.frombuffer(data, np.uint8), [], 0
            for doc_id, end in zip(ids, ends.tolist(), strict=True):
                own, kept, spans, removed = None, data[low:end], 0, 0
                if gone is not None and gone[low:end].any():
                    own = gone[low:end]
                    removed, spans = int(own.sum()), int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                    kept = raw[low:end][~own].tobytes()
                rows.append((doc_id, end - low, removed, spans, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
                low = end
            kinds = (*[pa.int64()] * 4, pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    found = with_windows(docs, task(win, k, **limits))
    return found.select("doc_ids", "sizes", "body", "windows").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
windows AS (
  SELECT doc_id, i, md5(substring(h, 2 * i - 1, 100)) AS w FROM texts, unnest(range(1, n - 48)) AS t(i)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first_id FROM windows) WHERE first_id < doc_id),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 49 AS b FROM (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM (
      SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM later))
  GROUP BY doc_id, run),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
parts AS (
  SELECT e.doc_id, e.before AS low, e.a - 1 AS high FROM edges e
  UNION ALL SELECT t.doc_id, coalesce(r.b, 0), t.n FROM texts t LEFT JOIN (SELECT doc_id, max(b) AS b FROM runs GROUP BY doc_id) r USING (doc_id)),
kept AS (
  SELECT t.doc_id, t.n, sum(p.high - p.low) AS left_over, string_agg(substring(t.h, 2 * p.low + 1, 2 * (p.high - p.low)), '' ORDER BY p.low, p.high) AS h
  FROM texts t JOIN parts p USING (doc_id) GROUP BY t.doc_id, t.n)
SELECT k.doc_id, k.n AS n_bytes, CAST(k.n - k.left_over AS BIGINT) AS n_removed,
       coalesce(s.spans, 0) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM kept k LEFT JOIN (SELECT doc_id, count(*) AS spans FROM runs GROUP BY doc_id) s USING (doc_id)
"""

"""Substring dedup: words of repeated passages, by FM-indexes of shards.

:mod:`.passages` brings passages that may hold equal windows together, a shard at a time.
A shard is a sequence of word numbers under an FM-index: the Burrows-Wheeler transform in a
wavelet tree whose branches follow a prefix code of the words' frequencies, so that its packed
bits take the transform's entropy and not the width of a number. Nothing else of the text is kept.
The passages are streamed through it by backward search: from every word the match is
extended to the left, which gives the matching statistic up to the threshold, the length of what
occurs in a second place too, and the interval of its occurrences. Intervals that
reach the threshold are reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .passages import Task, _rows, covered, with_windows, word_units

WIN, K = 20, 8


class BitVector:
    """Packed bits and the ones before each word of 64."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.uint32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word].astype(np.int64) + np.bitwise_count(self.words[word] & mask)


def prefix_code(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``code, length`` of each symbol: a canonical prefix code of lengths ``ceil(log2(total / count))``, one bit at least."""
    length = np.maximum(1, np.ceil(np.log2(counts.sum() / np.maximum(counts, 1)))).astype(np.int64)
    code = np.empty(len(counts), np.int64)
    order = np.argsort(length, kind="stable")
    # Canonical: the next code of a length follows the last one, shifted to its width.
    spent = np.cumsum(1 / np.exp2(length[order].astype(np.float64))) - 1 / np.exp2(length[order].astype(np.float64))
    code[order] = np.round(spent * np.exp2(length[order].astype(np.float64))).astype(np.int64)
    return code, length


class WaveletTree:
    """Rank over a sequence of numbers; a symbol's path is its code, its leaf as deep as its code is long.

    A level holds the bits of all its nodes, from left to right; of a node only its first bit's
    place is kept.
    """

    def __init__(self, seq: np.ndarray, counts: np.ndarray):
        self.code, self.length = prefix_code(counts)
        self.levels: list[BitVector] = []
        self.nodes: list[np.ndarray] = []  # prefixes of the nodes of a level, in order
        self.starts: list[np.ndarray] = []  # where the bits of each begin
        code, length = self.code[seq], self.length[seq]
        node = np.zeros(len(seq), np.int64)
        for level in range(int(self.length.max())):
            bit = (code >> (length - level - 1)) & 1
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            self.levels.append(BitVector(bit.astype(np.uint8)))
            self.nodes.append(node[first].astype(np.uint32))
            self.starts.append(first.astype(np.uint32))
            deeper = length > level + 1
            node = (node << 1 | bit)[deeper]
            order = np.argsort(node, kind="stable")
            code, length, node = code[deeper][order], length[deeper][order], node[order]

    def rank(self, symbols: np.ndarray, places: list[np.ndarray]) -> list[np.ndarray]:
        """How often each symbol occurs before each place."""
        own, length = self.code[symbols], self.length[symbols]
        places = [p.copy() for p in places]
        live = np.arange(len(symbols))
        for level, vector in enumerate(self.levels):
            live = live[length[live] > level]
            if not len(live):
                break
            width = length[live]
            start = self.starts[level][np.searchsorted(self.nodes[level], own[live] >> (width - level))].astype(np.int64)
            before = vector.rank(start)
            up = (own[live] >> (width - level - 1)) & 1 == 1
            for p in places:
                ones = vector.rank(start + p[live]) - before
                p[live] = np.where(up, ones, p[live] - ones)
        return places


class FMIndex:
    """Backward search over ``text``, numbers from 1 on, 0 ending each passage; true to ``depth``.

    What is kept is the transform in its tree and where each symbol's suffixes begin.
    """

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, span = text.copy(), 1
        while span < depth:  # order by prefixes of twice the length
            after = np.zeros(n, np.int64)
            after[:-span] = rank[span:] + 1
            key = rank * (int(rank.max()) + 2) + after
            _, rank = np.unique(key, return_inverse=True)
            span *= 2
        order = np.argsort(rank, kind="stable")
        counts = np.bincount(text)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.tree = WaveletTree(text[order - 1], counts)

    def interval(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of single symbols."""
        return self.first[symbols], self.first[symbols + 1]

    def extend(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the matches with one more symbol to the left."""
        a, b = self.tree.rank(symbols, [low, high])
        return a + self.first[symbols], b + self.first[symbols]


def matching_statistics(fm: FMIndex, text: np.ndarray, ends: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``length, low, high`` for the matches that end with each of ``ends``, streamed through the index.

    The length, up to ``threshold``, is how far left of an end (that included) the words still occur
    in a second place; the interval is that of the match so far, of one place more where it ended.
    """
    length = np.zeros(len(ends), np.int64)
    low, high = fm.interval(text[ends])
    live = np.flatnonzero(high - low > 1)
    length[live] = 1
    for back in range(1, threshold):
        if not len(live):
            break
        low[live], high[live] = fm.extend(low[live], high[live], text[ends[live] - back])
        live = live[high[live] - low[live] > 1]
        length[live] = back + 1
    return length, low, high


def window_classes(passages: list[bytes], win: int) -> np.ndarray:
    """Numbers of all windows of all passages, in order; equal numbers for equal windows."""
    words = [p.split(b" ") for p in passages]
    index: dict[bytes, int] = {}
    lens = np.array([len(w) for w in words])
    flat = np.fromiter((index.setdefault(x, len(index) + 1) for w in words for x in w), np.int64, int(lens.sum()))
    index.clear()
    ends = np.cumsum(lens + 1) - 1
    text = np.zeros(len(flat) + len(lens), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = flat
    starts = np.flatnonzero(np.arange(len(text)) + win <= np.repeat(ends, lens + 1))
    length, low, _ = matching_statistics(FMIndex(text, win), text, starts + win - 1, win)
    return np.where(length >= win, low, len(text) + np.arange(len(starts)))  # alone, if not above the threshold


def task(win: int = WIN, k: int = K, **limits: int) -> Task:
    return Task(word_units, window_classes, win, k, within=True, **limits)


def remove_repeats(docs: DataFrame, *, win: int = WIN, k: int = K, keep_text: bool = True, **limits: int) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256, kept``.

    A word goes where a window of ``win`` words covers it whose words also start earlier: in
    a smaller doc_id, or before in the same one; windows are judged on the input. ``kept``
    has the kept words, one space between them (null without ``keep_text``). Null text has
    no words; a null doc_id is smaller than all others; of rows with one doc_id, those
    at the same start do not remove from each other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for ids, sizes, body, windows in _rows(batches, ["doc_ids", "sizes", "body", "windows"]):
            units = word_units(zstandard.decompress(body.as_py()), sizes.values.to_numpy(zero_copy_only=False), hashed=False)
            lists = windows.as_py() or []
            bounds = units.bounds.tolist()
            gone = covered(bounds[-1], lists, win) if lists else None
            rows = []
            for doc_id, a, b in zip(ids.as_py(), bounds[:-1], bounds[1:], strict=True):
                removed = int(gone[a:b].sum()) if gone is not None else 0
                kept = units.slice(a, b) if b > a else b""
                if removed:
                    kept = b" ".join(w for w, g in zip(kept.split(b" "), gone[a:b].tolist(), strict=True) if not g)
                rows.append((doc_id, b - a, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None))
            kinds = (*[pa.int64()] * 3, pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    found = with_windows(docs, task(win, k, **limits))
    return found.select("doc_ids", "sizes", "body", "windows").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w FROM texts, unnest(range(1, len(words) - 18)) AS t(i)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM later, unnest(range(0, 20)) AS t(j)),
each AS (
  SELECT t.doc_id, p.pos, t.words[p.pos] AS word, g.pos IS NOT NULL AS removed
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS pos FROM texts) p JOIN texts t USING (doc_id)
  LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos),
sums AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT removed) AS kept
  FROM each GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n_words, 0) AS n_words, coalesce(s.n_removed, 0) AS n_removed, sha256(coalesce(s.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN sums s USING (doc_id)
"""

"""Language ID as multilingual mixture inference.

Every language has a distribution over hashed byte n-grams, fitted on a bounded sample of
labelled texts; one more component, the background, is uniform. For each document,
expectation-maximisation estimates the components' proportions; then nested language sets,
taken in order of proportion, compete by penalised likelihood. The model is the only thing
that is collected: one table of ``BINS`` numbers a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, text_or_empty

BINS = 1 << 16
#: Different labelled texts of a language that are fitted, about; the sample is drawn by a hash of the text.
SAMPLE_ROWS = 2000
SMOOTHING = 0.2
STEPS = 6
#: A language below this share of a document is not in its set.
LEAST_SHARE = 0.05
#: N-grams of a text that are held at once while they are counted.
PIECE_BYTES = 1 << 20
#: Different n-grams of several documents that are taken together, about: what a processor's cache holds.
TOGETHER = 1 << 16
#: Languages that a model has at most: it is collected and broadcast, a table of ``BINS`` numbers each.
MOST_LANGUAGES = 1000

_CLASS = np.full(256, 32, np.uint8)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def grams(text: str) -> np.ndarray:
    """Hashed n-grams of four bytes of the lower-cased text; whatever ASCII is no letter is a space."""
    pieces = list(gram_pieces(text))
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint16)


def gram_pieces(text: str) -> Iterator[np.ndarray]:
    """The n-grams of the whole text, ``PIECE_BYTES`` of them at a time; those across a cut included."""
    raw = _CLASS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    raw = raw[keep]
    if len(raw) < 3:
        return
    if len(raw) == 3:
        raw = np.append(raw, np.uint8(32))
    for at in range(0, len(raw) - 3, PIECE_BYTES):
        part = raw[at : at + PIECE_BYTES + 3].astype(np.uint32)
        word = part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24
        yield ((word * np.uint32(2654435761)) >> 16).astype(np.uint16)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bins of a text's n-grams and how often each occurs: all that its mixture depends on."""
    total = None
    for piece in gram_pieces(text):
        if len(piece) < BINS >> 3 and total is None and len(piece) < PIECE_BYTES:
            return np.unique(piece, return_counts=True)
        own = np.bincount(piece, minlength=BINS)
        total = own if total is None else total + own
    if total is None:
        return np.zeros(1, np.uint16), np.ones(1, np.int64)
    bins = np.flatnonzero(total)
    return bins.astype(np.uint16), total[bins]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    #: Rows: bins. Columns: languages, then the background. Each row divided by its largest.
    ratio: np.ndarray

    @cached_property
    def columns(self) -> list[np.ndarray]:
        return [np.ascontiguousarray(c) for c in self.ratio.T]

    def mixtures(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the components and the selected set, for the counted n-grams of one document each.

        Equal n-grams are weighed once, by their number, so a document takes no more than ``BINS``
        of them, whatever its length. Everything is held component by component, so that each
        operation runs over one stretch of memory.
        """
        sizes = np.array([len(b) for b, _ in parts])
        held = np.concatenate([b for b, _ in parts])
        times = np.concatenate([n for _, n in parts]).astype(np.float64)
        like = [column[held] for column in self.columns]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        totals = np.add.reduceat(times, starts)
        often = times.astype(np.float32)
        k, n = len(like), len(parts)

        def step(share: np.ndarray) -> np.ndarray:
            """Shares after a step of expectation-maximisation."""
            weighed = [column * np.repeat(share[:, c].astype(np.float32), sizes) for c, column in enumerate(like)]
            total = weighed[0].copy()
            for column in weighed[1:]:
                total += column
            np.divide(often, total, out=total)
            out = np.empty((n, k))
            for c, column in enumerate(weighed):
                column *= total
                out[:, c] = np.add.reduceat(column, starts, dtype=np.float64)
            return out / totals[:, None]

        share = np.full((n, k), 1 / k)
        for _ in range(STEPS):
            share = step(np.maximum(share, 1e-9))
        order = np.argsort(-share, axis=1, kind="stable")
        chosen = np.zeros((n, k), bool)
        np.put_along_axis(chosen, order[:, :1], True, axis=1)
        several = np.flatnonzero((share >= LEAST_SHARE).sum(1) > 1)
        for i in several:  # the others have one candidate, which needs no comparison
            own = slice(starts[i], starts[i] + sizes[i])
            chosen[i] = self._set(share[i], order[i], np.stack([c[own] for c in like]), times[own])
        return share, chosen

    @staticmethod
    def _set(share: np.ndarray, order: np.ndarray, like: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Of the sets of the largest components, down to ``LEAST_SHARE``, the one of the best penalised likelihood."""
        best, chosen, size = -np.inf, None, np.log(times.sum())
        for n in range(1, int((share >= LEAST_SHARE).sum()) + 1):
            held = np.zeros(len(share), bool)
            held[order[:n]] = True
            within = np.where(held, np.maximum(share, 1e-9), 1e-12)
            fit = float(np.log((within / within.sum()).astype(np.float32) @ like) @ times)
            score = fit - 0.5 * (n - 1) * size
            if score > best:
                best, chosen = score, held
        return chosen

    def predict(self, texts: list[str]) -> list[tuple[str, float, list[str], float]]:
        """``language, its share, the selected set, the background's share`` of each text."""
        none = ("und", 0.0, [], 1.0)
        found: list = [none] * len(texts)
        if not self.languages:
            return found
        rows, parts, held = [], [], 0

        def flush() -> None:
            share, chosen = self.mixtures(parts)
            for i, s, c in zip(rows, share, chosen, strict=True):
                found[i] = self._verdict(s, c)
            rows.clear()
            parts.clear()

        for i, text in enumerate(texts):
            if not has_letter(text):
                continue
            rows.append(i)
            parts.append(counted(text))
            held += len(parts[-1][0])
            if held >= TOGETHER:
                flush()
                held = 0
        if rows:
            flush()
        return found

    def _verdict(self, share: np.ndarray, chosen: np.ndarray) -> tuple[str, float, list[str], float]:
        known = share[:-1]
        among = np.where(chosen[:-1], known, -1.0) if chosen[:-1].any() else known
        top = int(np.argmax(among))
        languages = [self.languages[j] for j in np.argsort(-known, kind="stable") if chosen[j]]
        return self.languages[top], float(min(1.0, max(0.0, known[top]))), languages, float(share[-1])


def fit(labelled: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``text, lang``; rows without a language are left out.

    Of each language about ``sample_rows`` different texts are fitted, all of them where there are
    fewer; a text counts once, however often it is repeated. More than ``MOST_LANGUAGES``
    values of ``lang`` are an error.
    """
    plain = labelled.where("lang is not null and text is not null")
    drawn = F.xxhash64("text", F.lit("sample"))
    per_lang = plain.select("lang", drawn.alias("drawn")).distinct().groupBy("lang").count()
    counts = {r[0]: r[1] for r in per_lang.limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang: a model has one table for each")
    if not counts:
        return Model([], np.zeros((BINS, 1), np.float32))
    scale = 1 << 30
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(scale, scale * sample_rows // n))])
    sample = plain.where(F.pmod(drawn, F.lit(scale)) < F.element_at(rate, F.col("lang"))).select("lang", "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                bins = held.setdefault(lang, np.zeros(BINS, np.int64))
                for g in gram_pieces(text.as_py()):
                    bins += np.bincount(g, minlength=BINS)
        for lang, bins in held.items():
            full = np.flatnonzero(bins)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(full), "bin": pa.array(full, pa.int64()), "n": bins[full]})

    fitted = sample.repartition(8).mapInArrow(count, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    packed = fitted.groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("bins"))  # at most BINS rows a language
    tables: dict[str, np.ndarray] = {}
    for row in packed.select("lang", F.col("bins.bin").alias("bin"), F.col("bins.n").alias("n")).toArrow().to_pylist():
        bins = np.zeros(BINS)
        bins[row["bin"]] = row["n"]
        tables[row["lang"]] = bins
    languages = sorted(tables)
    known = np.stack([(tables[x] + SMOOTHING) / (tables[x].sum() + SMOOTHING * BINS) for x in languages], axis=1)
    every = np.concatenate([known, np.full((BINS, 1), 1 / BINS)], axis=1)
    return Model(languages, (every / every.max(1, keepdims=True)).astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred, score, lang_set, background`` added.

    The language is ``und`` where the text is null or has no letter, or nothing was learned. The
    score is the language's share of the document. Texts of any length are taken whole; equal
    texts get the same answer up to rounding; columns of ``docs`` with those four names are an
    error, as nothing is replaced silently; an empty table gives no rows.
    """
    from pyspark.sql import types as T

    extra = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("lang_set", T.ArrayType(T.StringType())), ("background", T.DoubleType())]
    taken = {n for n, _ in extra}
    if clash := sorted(taken.intersection(c.lower() for c in docs.columns)):
        raise ValueError(f"columns in the way: {', '.join(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, k in extra]])
    # A text that is a string goes to Python once; any other kind goes there as one, beside itself.
    own, strings = len(docs.columns), [i for i, f in enumerate(docs.schema.fields) if f.name.lower() == "text" and f.dataType == T.StringType()]
    sent = docs if strings else docs.select(*docs.columns, text_or_empty().alias("__text"))
    place = strings[0] if strings else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            for at in range(0, batch.num_rows, 512):
                found = shared.value.predict([t or "" for t in texts.slice(at, 512).to_pylist()])
                cols = [c.slice(at, 512) for c in batch.columns[:own]]
                pred = [pa.array([f[i] for f in found], k) for i, k in enumerate((pa.string(), pa.float64(), pa.list_(pa.string()), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*cols, *pred], names=out.names)

    return spread(sent).mapInArrow(run, out)


def split(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``: the identifier's crc32 modulo 4 is 2. A null identifier is not."""
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    return docs.withColumn("held_out", F.coalesce(rest == 2, F.lit(False)))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: fitted on the rows that are not held out.

    One row per input row, repeated ones too; other columns are ignored; an empty table gives
    no rows, and without a labelled row every language is ``und``.
    """
    parted = split(docs.select("doc_id", "text", "lang"))
    model = fit(parted.where(~F.col("held_out")).select("text", "lang"))
    return predict(parted.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")

"""Readers: signal files, checkpoints, settings, poll and offer snapshots, and pluggable models."""

from __future__ import annotations

import io
import re
import struct
import wave
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schema
from ..functions.fixed import Settings

FRAME_BATCH = 8192


def files(spark: SparkSession, path: str) -> DataFrame:
    """``recording, content`` of each file; the name is the recording's."""
    df = spark.read.format("binaryFile").load(path)
    return df.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("recording"), "content")


def packed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``recording, content`` as :func:`files` has them, of documents that :func:`sinks.write_packed` wrote."""
    return spark.read.parquet(path).select(F.col(key).cast("string").alias("recording"), "content")


def packed_lines(spark: SparkSession, path: str) -> DataFrame:
    """``keys, value``: the lines of packed documents, in no order."""
    df = spark.read.parquet(path)
    lines = F.split(F.col("content").cast("string"), "\n")
    return df.select(*[c for c in df.columns if c != "content"], F.explode(F.slice(lines, F.lit(1), F.size(lines) - 1)).alias("value"))


def _open(content: bytes) -> wave.Wave_read:
    return wave.open(io.BytesIO(content))


def samples(content: bytes, expected_rate: int | None = None) -> tuple[np.ndarray, int]:
    """Samples between -1 and 1, channels averaged, and their rate; another rate than expected is an error."""
    with _open(content) as w:
        rate, width, channels = w.getframerate(), w.getsampwidth(), w.getnchannels()
        raw = w.readframes(w.getnframes())
    if expected_rate is not None and rate != expected_rate:
        raise ValueError(f"sample rate {rate}, expected {expected_rate}")
    if width == 1:
        data = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        data = wide.view("<i4").ravel().astype(np.float32) / 2**31
    else:
        data = np.frombuffer(raw, f"<i{width}").astype(np.float32) / 2 ** (8 * width - 1)
    return data.reshape(-1, channels).mean(axis=1) if channels > 1 else data, rate


def frames(audio: DataFrame, *, frame_ms: int = 50, expected_rate: int | None = 16000) -> DataFrame:
    """``recording, frame_idx, rms``: energy of whole frames; a short last one is not there.

    Samples stay inside the task: one row a frame leaves it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, rate = samples(content.as_py(), expected_rate)
                size = max(1, rate * frame_ms // 1000)
                whole = data[: len(data) // size * size].reshape(-1, size)
                rms = np.sqrt((whole**2).mean(axis=1)).astype(np.float64)
                for at in range(0, len(rms), FRAME_BATCH):
                    part = rms[at : at + FRAME_BATCH]
                    yield pa.RecordBatch.from_pydict({"recording": [name] * len(part), "frame_idx": np.arange(at, at + len(part)), "rms": part})

    return audio.select("recording", "content").mapInArrow(run, "recording string, frame_idx long, rms double")


def _header(content: bytes) -> tuple[int, int, int, int]:
    """``duration_ms, rate, channels, bits`` by walking the chunks, wherever they lie; no data chunk is an error."""
    view, at = memoryview(content), 12
    rate = channels = bits = 0
    while at + 8 <= len(view):
        name, n = struct.unpack_from("<4sI", view, at)
        if name == b"fmt " and at + 24 <= len(view):
            _, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", view, at + 8)
        if name == b"data":
            width = channels * bits // 8
            if not width or not rate:
                raise ValueError("a data chunk before the format of its samples")
            return min(n, len(view) - at - 8) // width * 1000 // rate, rate, channels, bits
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


def durations(audio: DataFrame) -> DataFrame:
    """``recording, duration_ms, rate, channels, bits`` from the headers alone; no sample is decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [_header(c.as_buffer()) for c in batch.column(1)]
            cols = list(zip(*heads, strict=True)) if heads else [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], names=["recording", "duration_ms", "rate", "channels", "bits"])

    return audio.select(F.col("recording").cast("string"), "content").mapInArrow(run, "recording string, duration_ms long, rate int, channels int, bits int")


def slices(audio: DataFrame, windows: DataFrame, *, expected_rate: int | None = 16000) -> DataFrame:
    """``windows (recording, window_idx, start_ms, end_ms)`` with ``samples``, 32-bit floats of their stretch.

    A file meets the windows of its recording once, gathered in an array, and is decoded once.
    """
    own = windows.groupBy("recording").agg(F.array_sort(F.collect_list(F.struct("window_idx", "start_ms", "end_ms"))).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data, rate = samples(content.as_py(), expected_rate)
                for w in own:
                    part = data[w["start_ms"] * rate // 1000 : w["end_ms"] * rate // 1000].astype("<f4").tobytes()
                    yield pa.RecordBatch.from_pydict({"recording": [name], "window_idx": pa.array([w["window_idx"]], pa.int32()), "start_ms": [w["start_ms"]], "end_ms": [w["end_ms"]], "samples": pa.array([part], pa.binary())})

    met = audio.select("recording", "content").join(own, "recording")
    return met.mapInArrow(run, "recording string, window_idx int, start_ms long, end_ms long, samples binary")


def checked_speech_audio(audio: DataFrame) -> DataFrame:
    """The files, or an error for one that is not mono 16-bit at 8, 16, 32 or 48 kHz."""
    bad = ~((F.col("channels") == 1) & (F.col("bits") == 16) & F.col("rate").isin(8000, 16000, 32000, 48000))
    checked = durations(audio).withColumn("rate", F.when(bad, F.raise_error(F.concat(F.lit("not mono 16-bit speech audio: "), "recording"))).otherwise(F.col("rate")))
    return audio.join(checked, "recording").where("rate > 0")


def resampled(audio: DataFrame, rate: int = 16000) -> DataFrame:
    """Mono 16-bit files at ``rate``, by linear interpolation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, own = samples(content.as_py())
                n = len(data) * rate // own
                new = np.interp(np.arange(n) * own / rate, np.arange(len(data)), data) if len(data) else np.zeros(0)
                out = io.BytesIO()
                with wave.open(out, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(rate)
                    w.writeframes(np.clip(np.round(new * 32767), -32768, 32767).astype("<i2").tobytes())
                yield pa.RecordBatch.from_pydict({"recording": [name], "content": pa.array([out.getvalue()], pa.binary())})

    return audio.select("recording", "content").mapInArrow(run, "recording string, content binary")


def checkpoint_words(spark: SparkSession, path: str) -> DataFrame:
    """A recording's words from files of one JSON array each, schema given."""
    return spark.read.schema(schema.CHECKPOINT).json(path, multiLine=True).withColumn("path", F.col("_metadata.file_path"))


def packed_words(spark: SparkSession, path: str) -> DataFrame:
    """``keys`` and the words of packed checkpoints, a JSON array each; one that is none is an error."""
    df = spark.read.parquet(path)
    words = F.from_json(F.col("content").cast("string"), f"array<struct<{schema.CHECKPOINT}>>", {"mode": "FAILFAST"})
    return df.select(*[c for c in df.columns if c != "content"], F.inline(words))


def progress_log(spark: SparkSession, path: str) -> DataFrame:
    """Progress rows; comments and malformed rows (those of failed batches) are told apart."""
    read = spark.read.schema(schema.PROGRESS + ", broken string").option("sep", "\t").option("comment", "#").option("columnNameOfCorruptRecord", "broken")
    return read.csv(path, mode="PERMISSIVE").withColumn("failed", F.col("broken").isNotNull())


def offers(spark: SparkSession, path: str) -> DataFrame:
    """Offers of a snapshot as :func:`control.pick_offers` takes them: ``seq`` is their order, ``is_dc`` that a data centre makes them."""
    read = spark.read.schema("id long, gpu_name string, num_gpus int, disk_space double, reliability2 double, inet_down double, dph_total double, hosting_type int").json(path)
    return read.withColumn("seq", F.monotonically_increasing_id()).withColumn("is_dc", F.coalesce(F.col("hosting_type") == 1, F.lit(False)))


def polls(spark: SparkSession, path: str, *, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).schema(schema.POLLS).json(path)


def settings(text: str) -> Settings:
    """Settings from flat ``name: value`` lines; names that are not known are left out."""
    known = {f.name: type(f.default) for f in fields(Settings)}
    found = {}
    for line in text.splitlines():
        name, colon, value = line.partition(":")
        value = value.split("#")[0].strip().strip("\"'")
        if colon and name in known and value and value != "null":
            found[name] = known[name](float(value))
    return Settings(**found)


@dataclass
class Config:
    """Settings, the rules that texts go through, and whatever else the file has at its top level."""

    settings: Settings
    corrections: dict[str, str]
    patterns: list[str]


def _plain(value: str) -> str:
    value = value.strip()
    if value[:1] == '"':
        body, escapes = value[1 : value.rindex('"')], {"n": "\n", "t": "\t"}
        return re.sub(r"\\(.)", lambda m: escapes.get(m[1], m[1]), body)
    if value[:1] == "'":
        return value[1 : value.rindex("'")].replace("''", "'")
    return re.sub(r"\s+#.*", "", value).strip()


def config(text: str) -> Config:
    """A settings file: flat ``name: value`` lines, one indented mapping of corrections, one list of patterns.

    This is the part of YAML that such a file needs: plain and quoted scalars, comments, one
    level of nesting. Rules keep the order of the file.
    """
    corrections: dict[str, str] = {}
    patterns: list[str] = []
    section = ""
    for line in text.splitlines():
        bare = line.strip()
        if not bare or bare.startswith("#"):
            continue
        if not line[0].isspace():
            section = bare.partition(":")[0]
        elif section == "vocab_corrections" and (m := re.match(r"""("(?:[^"\\]|\\.)*"|'[^']*'|[^:]+?)\s*:\s*(.+)""", bare)):
            corrections[_plain(m[1])] = _plain(m[2])
        elif section == "hallucination_patterns" and bare.startswith("- "):
            patterns.append(_plain(bare[2:]))
    return Config(settings(text), corrections, patterns)


def read_config(spark: SparkSession, path: str) -> Config:
    """:func:`config` of a file that Spark can read."""
    return config(spark.read.text(path, wholetext=True).first()[0])


# ---- pluggable models ----------------------------------------------------------------

_recognisers: dict[str, Callable] = {}
_diarisers: dict[str, Callable] = {}


def register_recogniser(name: str, load: Callable[[], Callable[[list], list]]) -> None:
    """``load()`` runs once a task and gives ``batch of windows -> list of words or None`` each.

    A window is ``(recording, window_idx, start_ms, end_ms)``, and its ``samples`` where the windows
    have them (:func:`slices`); a word ``(text, start, end)`` in seconds from the window's start.
    """
    _recognisers[name] = load


def register_diariser(name: str, load: Callable[[], Callable[[str], list]]) -> None:
    """``load()`` gives ``recording -> list of (start_ms, end_ms, speaker)``."""
    _diarisers[name] = load


def recognise(windows: DataFrame, model: str, *, batch_size: int = 16) -> DataFrame:
    """``recording_id, model, window_idx, start, end, hypothesis, error`` for the windows of a recording.

    Windows go to the model in batches; a batch that fails gives null hypotheses and the error, and
    the run goes on.
    """
    load = _recognisers[model]
    kind = pa.struct([("timestamp", pa.struct([("word", pa.list_(pa.struct([("word", pa.string()), ("start", pa.float64()), ("end", pa.float64())])))]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hear = load()
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for at in range(0, len(rows), batch_size):
                part, error = rows[at : at + batch_size], None
                try:
                    heard = hear(part)
                except Exception as e:  # a failed batch must not end the run
                    heard, error = [None] * len(part), f"{type(e).__name__}: {e}"
                hyps = [None if h is None else {"timestamp": {"word": [dict(zip(("word", "start", "end"), w, strict=True)) for w in h]}} for h in heard]
                yield pa.RecordBatch.from_pydict({
                    "recording_id": [r[0] for r in part], "model": [model] * len(part), "window_idx": pa.array([r[1] for r in part], pa.int32()),
                    "start": [r[2] / 1000 for r in part], "end": [r[3] / 1000 for r in part],
                    "hypothesis": pa.array(hyps, kind), "error": pa.array([error] * len(part), pa.string()),
                })

    out = f"recording_id long, model string, window_idx int, start double, end double, hypothesis struct<{schema.HYPOTHESIS.replace(' struct', ': struct', 1)}>, error string"
    return windows.select("recording_id", "window_idx", "start_ms", "end_ms", *[c for c in ("samples",) if c in windows.columns]).mapInArrow(run, out)


def diarise(recordings: DataFrame, name: str) -> DataFrame:
    """Turns of each recording: ``recording_id, turn_seq, start_ms, end_ms, speaker``."""
    load = _diarisers[name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = load()
        for batch in batches:
            for rec in batch.column(0).to_pylist():
                found = split(rec)
                if found:
                    a, b, s = zip(*found, strict=True)
                    yield pa.RecordBatch.from_pydict({"recording_id": [rec] * len(a), "turn_seq": list(range(len(a))), "start_ms": list(a), "end_ms": list(b), "speaker": list(s)})

    return recordings.select("recording_id").mapInArrow(run, schema.TURNS)

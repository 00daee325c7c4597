"""GIF columns: encoding samples, decoding code streams, rendering timed frames."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread, text_or_empty, write_table

#: Samples in a row of a stored picture, and rows in a frame at most.
ROW, ROWS = 576, 64
DELAY_CS = 4
BATCH_BYTES = 4 << 20
#: Pixels of a canvas or a picture at most; a file that claims more is an error, not a smaller picture.
MOST_PIXELS = 1 << 26
#: Bins of a channel's histogram.
BINS = 8
_LIMIT = 4096


# ---- code streams --------------------------------------------------------------------


def _widths(first: int, n: int) -> Iterator[tuple[int, int]]:
    """``width, count`` of ``n`` codes after a clear; ``first`` is the end code."""
    at = 0
    while at < n:
        width = min(12, (first + at).bit_length())
        upto = n if width == 12 else min(n, (1 << width) - first)
        yield width, upto - at
        at = upto


def lzw_encode(samples: bytes, bits: int = 8) -> bytes:
    """The code stream of ``samples``, each below ``2**bits``; the table is cleared when full."""
    clear, end = 1 << bits, (1 << bits) + 1
    groups: list[list[int]] = []
    codes: list[int] = []
    emit, known, free = codes.append, {}, end + 1
    get = known.get
    if samples:
        prefix = samples[0]
        for b in memoryview(samples)[1:]:
            key = prefix << 8 | b
            code = get(key)
            if code is not None:
                prefix = code
                continue
            emit(prefix)
            prefix = b
            if free < _LIMIT:
                known[key] = free
                free += 1
            else:
                emit(clear)
                groups.append(codes)
                codes = []
                emit = codes.append
                known.clear()
                free = end + 1
        emit(prefix)
    emit(end)
    groups.append(codes)
    out = [np.unpackbits(np.array([clear], "<u2").view(np.uint8), bitorder="little")[: bits + 1]]
    for group in groups:
        spread = np.unpackbits(np.array(group, "<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
        at = 0
        for width, n in _widths(end, len(group)):
            out.append(spread[at : at + n, :width].ravel())
            at += n
    return np.packbits(np.concatenate(out), bitorder="little").tobytes()


def _codes(stream: np.ndarray, at: int, width: int, n: int) -> np.ndarray:
    """Up to ``n`` codes of ``width`` bits from bit ``at`` on."""
    n = min(n, (len(stream) - at) // width)
    wide = np.zeros((max(0, n), 16), np.uint8)
    wide[:, :width] = stream[at : at + max(0, n) * width].reshape(-1, width)
    return np.packbits(wide, axis=1, bitorder="little").view("<u2").ravel()


def lzw_decode(data: bytes, bits: int, size: int) -> bytes:
    """``size`` samples of a code stream; fewer where it breaks off or goes wrong."""
    clear, end = 1 << bits, (1 << bits) + 1
    stream = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    base: list[bytes] = [bytes([i]) for i in range(clear)] + [b"", b""]
    out: list[bytes] = []
    at, done, over = 0, 0, False
    while not over and done < size:
        table, prev, index = base.copy(), b"", 0
        known = table.append
        while not over:  # the codes up to the next clear, a width at a time
            width = min(12, (end + index).bit_length())
            want = (1 << width) - end - index if width < 12 else _LIMIT
            codes = _codes(stream, at, width, want)
            stops = np.flatnonzero((codes == clear) | (codes == end))
            n = int(stops[0]) if len(stops) else len(codes)
            put = out.append
            for code in codes[:n].tolist():
                if code < len(table):
                    entry = table[code]
                elif prev and code == len(table):
                    entry = prev + prev[:1]
                else:
                    over = True
                    break
                if prev and len(table) < _LIMIT:
                    known(prev + entry[:1])
                put(entry)
                prev = entry
            index += n
            at += n * width
            if len(stops):
                at += width
                over |= int(codes[n]) == end
                break
            if not len(codes):
                over = True
        done = sum(map(len, out)) if not over else done
    return b"".join(out)[:size]


# ---- files ---------------------------------------------------------------------------


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(x)]) + x for x in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


_GREYS = bytes(v for i in range(256) for v in (i, i, i))


def encode_samples(payload: bytes) -> bytes:
    """A grey GIF of ``payload``, a positive multiple of ``ROW`` bytes: ``ROWS`` rows a frame."""
    rows = len(payload) // ROW
    out = [b"GIF89a", ROW.to_bytes(2, "little"), min(rows, ROWS).to_bytes(2, "little"), b"\xf7\0\0", _GREYS]
    for top in range(0, rows, ROWS):
        n = min(ROWS, rows - top)
        out.append(b"\x21\xf9\x04\x08" + DELAY_CS.to_bytes(2, "little") + b"\0\0")  # cleared after it is shown
        out.append(b"\x2c\0\0\0\0" + ROW.to_bytes(2, "little") + n.to_bytes(2, "little") + b"\0\x08")
        out.append(_blocks(lzw_encode(payload[top * ROW : (top + n) * ROW])))
    return b"".join(out) + b"\x3b"


@dataclass
class Frame:
    """A rendered frame: the whole picture, and the rectangle that this frame drew."""

    index: int
    start_ms: int
    delay_ms: int
    box: tuple[int, int, int, int]
    picture: np.ndarray


class BadGif(ValueError):
    """Not a GIF, or one that breaks off; the frames before that are there."""


def _table(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    return np.frombuffer(data[at : at + 3 * n].ljust(3 * n, b"\0"), np.uint8).reshape(-1, 3), at + 3 * n


def _join(data: bytes, at: int) -> tuple[bytes, int]:
    parts = []
    while at < len(data) and data[at]:
        parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return b"".join(parts), at + 1


def frames(data: bytes) -> Iterator[Frame]:
    """Rendered frames in order, under each frame's palette, transparency and disposal.

    Disposal 2 clears the frame's rectangle after it was shown, 3 brings back what was
    there before. The picture of a frame is reused for the next one; copy what is kept. A
    picture that breaks off is filled with colour 0; a file that breaks off anywhere raises
    ``BadGif`` after the frames it has, one that claims more than ``MOST_PIXELS`` at once.
    """
    if data[:6] not in (b"GIF87a", b"GIF89a") or len(data) < 13:
        raise BadGif("no GIF header")
    word = lambda i: int.from_bytes(data[i : i + 2], "little")
    width, height = word(6), word(8)
    if width * height > MOST_PIXELS:
        raise BadGif(f"a canvas of {width} x {height}")
    palette, at = _table(data, 13, data[10])
    canvas, fault = None, ""
    disposal, delay, clear, index, clock = 0, 0, None, 0, 0
    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            label, (body, at) = data[at + 1 : at + 2], _join(data, at + 2)
            if label == b"\xf9" and len(body) >= 4:
                disposal, delay = body[0] >> 2 & 7, int.from_bytes(body[1:3], "little") * 10
                clear = body[3] if body[0] & 1 else None
            continue
        if data[at] != 0x2C or at + 10 > len(data):
            fault = "no block is known by its first byte" if at + 10 <= len(data) else "breaks off"
            break
        x, y, w, h, flags = word(at + 1), word(at + 3), word(at + 5), word(at + 7), data[at + 9]
        local, at = _table(data, at + 10, flags)
        colours = local if local is not None else palette
        bits = data[at] if at < len(data) else 0
        stream, at = _join(data, at + 1)
        if not 1 <= bits <= 11 or colours is None or w * h > MOST_PIXELS:
            fault = "a picture without colours, code size or bounds"
            break
        samples = lzw_decode(stream, bits, w * h)
        if len(samples) < w * h:
            fault, samples = "a picture breaks off", samples + bytes(w * h - len(samples))
        plane = np.frombuffer(samples, np.uint8).reshape(h, w)
        if canvas is None:
            canvas = np.zeros((height, width, 3), np.uint8)
        if flags & 0x40:
            order = np.concatenate([np.arange(a, h, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])
            rows = np.empty_like(plane)
            rows[order] = plane
            plane = rows
        seen = plane[: max(0, height - y), : max(0, width - x)]
        box = canvas[y : y + seen.shape[0], x : x + seen.shape[1]]
        before = box.copy() if disposal == 3 else None
        drawn = colours[np.minimum(seen, len(colours) - 1)]
        if clear is None:
            box[:] = drawn
        else:
            np.copyto(box, drawn, where=(seen != clear)[:, :, None])
        yield Frame(index, clock, delay, (x, y, seen.shape[1], seen.shape[0]), canvas)
        if disposal == 2:
            box[:] = 0
        elif before is not None:
            box[:] = before
        index, clock = index + 1, clock + delay
        disposal, delay, clear = 0, 0, None
    if not index or fault or at >= len(data):
        raise BadGif(fault or ("breaks off" if index else "no picture"))


def histogram(pixels: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts of equal bins of each channel, red first."""
    return np.stack([np.bincount(pixels[..., c].ravel() >> (8 - bins.bit_length() + 1), minlength=bins) for c in range(3)])


# ---- columns -------------------------------------------------------------------------


def payload_of(text: str) -> bytes:
    body = text.encode()
    return body + b"\xff" * (ROW - len(body) % ROW if len(body) % ROW or not body else 0)


def encode_texts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, media binary``: each whole text as a GIF; null counts as empty.

    One row per input row, repeated ones too, equal texts the same bytes. A text of any length is
    one file; what a task holds is a batch of rows and the file it makes. Other columns are
    ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

        for batch in batches:
            ids, sizes, media, held = [], [], [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                ids.append(doc_id.as_py())
                sizes.append(len(text.encode()))
                media.append(encode_samples(payload_of(text)))
                held += len(media[-1])
                if held > BATCH_BYTES:
                    yield out()
                    ids, sizes, media, held = [], [], [], 0
            if ids:
                yield out()

    plain = docs.select(F.col("doc_id").cast("long"), text_or_empty(text_col).alias("text"))
    return spread(plain).mapInArrow(run, "doc_id long, n_bytes long, media binary")


FRAME_SCHEMA = (
    "doc_id long, frame int, start_ms long, delay_ms long, width int, height int, x int, y int, box_width int, box_height int, "
    "red array<long>, green array<long>, blue array<long>, pixels binary, error string"
)


def frame_rows(media: DataFrame, *, pixels: bool = True) -> DataFrame:
    """One row per timed frame of ``doc_id, media``: rendered pixels and histograms by channel.

    A null or broken file gives a row with ``error`` after the frames it has. Rows are read one by
    one, repeated identifiers too; an empty table gives no rows.
    """
    names = [x.split(" ")[0] for x in FRAME_SCHEMA.split(", ")]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 6, longs, longs, longs, pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                try:
                    for f in frames(data.as_py() or b""):
                        counts = histogram(f.picture).tolist()
                        rows.append((doc_id, f.index, f.start_ms, f.delay_ms, f.picture.shape[1], f.picture.shape[0], *f.box, *counts, f.picture.tobytes() if pixels else None, None))
                        if len(rows) >= 64:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows = []
                except BadGif as e:
                    rows.append((doc_id, *[None] * 13, str(e)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return media.select("doc_id", "media").mapInArrow(run, FRAME_SCHEMA)


SHOWN_SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "frames array<struct<frame: int, start_ms: bigint, delay_ms: bigint, x: int, y: int, width: int, height: int, red: array<bigint>, green: array<bigint>, blue: array<bigint>>>"
)
_COUNTS = pa.list_(pa.int64())
_FRAME = pa.struct([("frame", pa.int32()), ("start_ms", pa.int64()), ("delay_ms", pa.int64()), *[(c, pa.int32()) for c in ("x", "y", "width", "height")], ("red", _COUNTS), ("green", _COUNTS), ("blue", _COUNTS)])
_SHOWN = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("frames", pa.list_(_FRAME)),
    ]
)


def shown(media: DataFrame) -> DataFrame:
    """What stored texts show: ``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, frames``.

    The payload is the red channel of what each rendered frame drew. ``frames`` are the timed
    frames in order, each with its rectangle and a histogram of the rectangle by channel. One
    row per row of ``doc_id, n_bytes, media``; a broken file is an error, as the files are our own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, n_bytes, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = data.as_py()
                digest, size, tail, seen = hashlib.sha256(), 0, b"", []
                for f in frames(data):
                    x, y, w, h = f.box
                    part = f.picture[y : y + h, x : x + w]
                    body = part[..., 0].tobytes()
                    digest.update(body)
                    size, tail = size + len(body), (tail + body)[-32:]
                    red, green, blue = histogram(part).tolist()
                    seen.append({"frame": f.index, "start_ms": f.start_ms, "delay_ms": f.delay_ms, "x": x, "y": y, "width": w, "height": h, "red": red, "green": green, "blue": blue})
                rows.append((doc_id, n_bytes, size, digest.hexdigest(), zlib.crc32(tail), len(data), hashlib.sha256(data).hexdigest(), seen))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), _SHOWN, strict=True)], schema=_SHOWN)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, SHOWN_SCHEMA)


def feature(seen: str = "frames") -> Column:
    """Frames, their time, and the sum of their histograms by channel, as one string."""

    def total(name: str, i: int) -> Column:
        return F.aggregate(F.col(seen), F.lit(0).cast("long"), lambda a, f: a + f[name][i]).cast("string")

    def channel(name: str) -> Column:
        return F.concat(F.lit(f";{name}="), F.concat_ws(",", *[total(name, i) for i in range(BINS)]))

    time = F.aggregate(F.col(seen), F.lit(0).cast("long"), lambda a, f: a + f["delay_ms"])
    return F.concat(F.lit("frames="), F.size(seen).cast("string"), F.lit(";ms="), time.cast("string"), *map(channel, ("red", "green", "blue")))


def store_texts(docs: DataFrame) -> DataFrame:
    """Each whole text as a stored GIF, and what is read back from it.

    The files are written as a table, read from there and decoded; their timed frames with
    histograms are written as columns of a second one, which the result is read from:
    the columns of :func:`shown` but ``frames``, and ``feature``.
    """
    media = write_table(encode_texts(docs), "gif-media")
    seen = write_table(shown(media), "gif-frames")
    return seen.withColumn("feature", feature()).drop("frames")

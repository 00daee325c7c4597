"""WARC archives as table rows: writing captures, reading records, assembling transactions.

A capture is three records (request, response or revisit, metadata), tied by
``WARC-Concurrent-To``. An archive is a row ``(archive string, content binary)``, so it is
written, committed and read by Spark on any store; ``read_files`` gives files of a folder
the same shape. Payloads are never shuffled: pages are staged once where they are read, and what
becomes of each comes to them.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, join_hot, new_path, numbered, spread, text_or_empty, write_table
from .components import connected_components

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: An archive is closed once it holds so many bytes.
ARCHIVE_BYTES = 4 << 20
RECORD_SCHEMA = (
    "archive string, start long, record_id string, type string, concurrent_to array<string>, target_uri string, date string, "
    "refers_to string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary, error string"
)
RECORD_ARROW = pa.schema(
    [
        ("archive", pa.string()), ("start", pa.int64()), ("record_id", pa.string()), ("type", pa.string()),
        ("concurrent_to", pa.list_(pa.string())), ("target_uri", pa.string()), ("date", pa.string()), ("refers_to", pa.string()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)


# ---- roles ---------------------------------------------------------------------------


def assign_roles(pages: DataFrame, *, least_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, sha1, ident, record_type, refers_to, refers_url, refers_ident`` per row of ``pages``.

    Of pages with equal payloads of ``least_bytes`` or more, the largest page_id is the
    response and the others revisit it. Equality is SHA-1, length and a second hash. Rows
    of equal page_id and payload share a role; a null page_id counts as smallest. ``ident`` tells
    every row apart, repeated ones too. Other columns are ignored.
    """
    payload = text_or_empty("html")
    key = F.concat_ws(":", F.sha1(payload.cast("binary")), F.octet_length(payload), F.xxhash64(payload))
    plain = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"), key.alias("key"))
    rows = numbered(spread(plain).withColumn("small", F.octet_length("payload") < least_bytes), "warc-pages")
    ident = F.concat_ws("-", "__part", "__slot")
    narrow = rows.where(~F.col("small")).select("__part", "__slot", "page_id", "key", "url", ident.alias("ident"))
    groups = write_table(
        narrow.groupBy("key").agg(F.max(F.struct("page_id", "url", "ident")).alias("first"), F.count("*").alias("rows")).where("rows > 1"),
        "warc-groups",
    )
    total = groups.agg(F.sum("rows")).first()[0] or 0
    later = join_hot(narrow.drop("url", "ident"), groups, "key", "rows", total).where(~F.col("first.page_id").eqNullSafe(F.col("page_id")))
    held = attach(rows.withColumn("ident", ident), later.select("__part", "__slot", "first"), "first")
    return held.select(
        "page_id", "url", "payload", "sha1", "ident",
        F.when(F.col("first").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("first.page_id").alias("refers_to"),
        F.col("first.url").alias("refers_url"),
        F.col("first.ident").alias("refers_ident"),
    )


# ---- writing -------------------------------------------------------------------------


def record_id(kind: str, ident: str, sha1: str) -> str:
    """An identifier of the record of a row: a UUID made of what tells the row apart."""
    h = hashlib.blake2b(f"{kind}\n{ident}\n{sha1}".encode(), digest_size=16).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-8{h[13:16]}-a{h[17:20]}-{h[20:]}>"


def _line(value: str | None) -> str:
    """A header value in one line."""
    return " ".join((value or "").split())


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def capture(page_id: int | None, url: str | None, payload: bytes, sha1: str, ident: str, kind: str, refers_url: str | None, refers_ident: str | None) -> bytes:
    """The three records of a capture."""
    uri, main = _line(url), record_id("response", ident, sha1)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "application/http; msgtype=response")]
    if kind == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id("response", refers_ident, sha1)), ("WARC-Refers-To-Target-URI", _line(refers_url))]
    block = http if kind == "revisit" else http + payload
    about = "".join(f"{k}: {v}\r\n" for k, v in (("page-id", "" if page_id is None else page_id), ("payload-length", len(payload)))).encode()
    ask = f"GET {uri} HTTP/1.1\r\nHost: {uri.split('/')[2] if uri.count('/') > 1 else ''}\r\n\r\n".encode()
    return b"".join(
        (
            record("request", [("WARC-Record-ID", record_id("request", ident, sha1)), *common, ("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")], ask),
            record(kind, headers, block),
            record("metadata", [("WARC-Record-ID", record_id("metadata", ident, sha1)), *common, ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], about),
        )
    )


def archive_rows(captures: DataFrame) -> DataFrame:
    """``archive string, content binary``: archives of about ``ARCHIVE_BYTES`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"archive": [f"part-{part:06d}-{n:06d}.warc"], "content": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, payload, *rest = (x.as_py() for x in row)
                held.append(capture(page_id, url, payload.encode(), *rest))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    n, held, size = n + 1, [], 0
        if held:
            yield close()

    cols = ["page_id", "url", "payload", "sha1", "ident", "record_type", "refers_url", "refers_ident"]
    return captures.select(*cols).mapInArrow(run, "archive string, content binary")


def write_archives(captures: DataFrame, path: str) -> None:
    archive_rows(captures).write.parquet(path)


# ---- reading -------------------------------------------------------------------------


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("archive string, content binary").parquet(path)


def read_files(spark: SparkSession, glob: str) -> DataFrame:
    """Real ``.warc`` or ``.warc.gz`` files, one row each."""
    return spark.read.format("binaryFile").load(glob).select(F.col("path").alias("archive"), "content")


def parse_records(content: bytes) -> Iterator[tuple[int, list[tuple[str, str]], bytes, str | None]]:
    """``start, headers (names in lower case, repeated ones too), block, error`` of each record.

    A compressed archive is decompressed as it is read, a record at a time. What is no
    record, or breaks off, gives one entry with ``error``; reading goes on at the next line that begins
    a record.
    """
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    start = at = 0
    astray = False
    try:
        while line := stream.readline():
            start, at = at, at + len(line)
            if not line.startswith(b"WARC/"):
                if line.strip() and not astray:
                    astray = True
                    yield start, [], b"", "not a record"
                continue
            astray, headers, whole = False, [], False
            while line := stream.readline():
                at += len(line)
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if not text:
                    whole = True
                    break
                if text[0] in " \t" and headers:
                    headers[-1] = (headers[-1][0], f"{headers[-1][1]} {text.strip()}".strip())
                else:
                    name, _, value = text.partition(":")
                    headers.append((name.strip().lower(), value.strip()))
            length = dict(headers).get("content-length", "")
            if not whole or not (length.isascii() and length.isdigit()):
                astray = True
                yield start, headers, b"", "headers without an end" if not whole else "no length"
                continue
            block = stream.read(int(length))
            at += len(block)
            yield start, headers, block, None if len(block) == int(length) else "breaks off"
    except (EOFError, gzip.BadGzipFile, zlib.error) as e:
        yield at, [], b"", f"compressed data: {e}"


def records(archives: DataFrame, *, payloads: bool = True) -> DataFrame:
    """One row per record, digest and length taken from the bytes that are there.

    Of a revisit, which has no payload, both come from its headers and metadata. A response's
    payload is what follows its HTTP headers, or all of it where no blank line ends them. Without
    ``payloads`` the bytes themselves stay behind. ``fields`` are those of a metadata record, the
    last of a repeated one. Of what is broken, a row says so in ``error``, with the headers there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for start, headers, block, error in parse_records(content.as_py() or b""):
                    h = dict(headers)
                    kind, digest, size, fields, payload = h.get("warc-type"), None, None, None, None
                    if error:
                        pass
                    elif kind == "metadata":
                        pairs = (x.partition(":") for x in block.decode("utf-8", "replace").splitlines() if x)
                        fields = [*{k.strip(): v.strip() for k, _, v in pairs}.items()]
                    elif kind == "response":
                        end = block.find(b"\r\n\r\n")
                        body = block[end + 4 :] if end >= 0 else block
                        digest, size, payload = hashlib.sha1(body).hexdigest(), len(body), body if payloads else None
                    elif kind == "revisit":
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                    others = [v for k, v in headers if k == "warc-concurrent-to"]
                    rows.append((name, start, h.get("warc-record-id"), kind, others, h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-refers-to"), digest, size, fields, payload, error))
                    held += len(payload or b"")
                    if held >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD_ARROW, strict=True)], schema=RECORD_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD_ARROW, strict=True)], schema=RECORD_ARROW)

    return archives.select("archive", "content").mapInArrow(run, RECORD_SCHEMA)


def transactions(recs: DataFrame, *, direct: bool = False) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``.

    Records belong together where one names another by concurrent-to, whichever does and over any
    number of steps; a capture's row is that of its response (or revisit), and of several within
    reach a record goes to the one it names, else to the smallest identifier. ``response`` is null
    where only the others were found. A record without an identifier is a capture of its own,
    told apart by where it lies; of records repeated under one identifier, the one in the last archive
    counts. Broken records are left out. With ``direct`` every request and metadata record is
    known to name its response, so that all meet in one shuffle.
    """
    main = F.col("type").isin("response", "revisit")
    own = F.coalesce("record_id", F.concat_ws("@", "archive", F.col("start").cast("string")))
    known = recs.where(F.col("error").isNull() & (main | F.col("type").isin("request", "metadata"))).withColumn("capture_id", own)
    named = F.get("concurrent_to", F.lit(0))
    if direct:
        placed = known.withColumn("capture_id", F.when(main, F.col("capture_id")).otherwise(F.coalesce(named, "capture_id")))
    else:
        links = write_table(known.select(F.col("capture_id").alias("a"), main.alias("main"), F.explode("concurrent_to").alias("b")), "warc-links")
        roots = write_table(connected_components(links.select("a", "b")), "warc-roots")
        mains = known.where(main).select(F.col("capture_id").alias("node")).distinct()
        heads = roots.join(mains, "node").groupBy("root").agg(F.min("node").alias("head"))
        reached = roots.join(heads, "root").select("node", "head")
        straight = links.where("not main").join(mains, F.col("b") == F.col("node")).groupBy("a").agg(F.min("b").alias("straight"))
        homes = write_table(reached.join(straight, F.col("node") == F.col("a"), "left").select("node", F.coalesce("straight", "head").alias("home")), "warc-homes")
        # Without a response in reach, those that are linked meet under the smallest of them.
        lone = roots.join(heads, "root", "left_anti").select("node", F.col("root").alias("home"))
        homes = homes.unionByName(lone)
        placed = known.join(homes, (F.col("capture_id") == F.col("node")) & ~main, "left").withColumn("capture_id", F.coalesce("home", "capture_id")).drop("node", "home")
    whole = F.struct(*[c for c in recs.columns if c != "error"])
    of = lambda test: F.max_by(F.when(test, whole), F.when(test, F.struct("archive", "start")))
    return placed.groupBy("capture_id").agg(of(main).alias("response"), of(F.col("type") == "request").alias("request"), of(F.col("type") == "metadata").alias("metadata"))


def page_captures(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write an archive of ``pages``, read it back, and say per page what is there.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to``: one row per row of
    ``pages``, repeated ones too. Null html is an empty payload, a page of any length one
    record; line breaks in a url become spaces. Other columns are ignored; an empty table gives no rows.
    """
    path = new_path(spark, "warc-archives")
    write_archives(assign_roles(pages), path)
    found = transactions(records(read_archives(spark, path), payloads=False).drop("payload"), direct=True)
    flat = write_table(
        found.select(
            "capture_id",
            F.expr("try_cast(metadata.fields['page-id'] AS bigint)").alias("page_id"),
            F.coalesce("response.payload_bytes", F.expr("try_cast(metadata.fields['payload-length'] AS bigint)")).alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
            F.col("response.type").alias("record_type"),
            F.col("response.refers_to").alias("refers_id"),
        ),
        "warc-captures",
    )
    revisits = flat.where("refers_id is not null")
    counts = revisits.groupBy("refers_id").agg(F.count("*").alias("rows"))
    named = flat.select(F.col("capture_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    targets = write_table(counts.join(named, "refers_id", "left"), "warc-targets")
    total = targets.agg(F.sum("rows")).first()[0] or 0
    resolved = join_hot(revisits, targets, "refers_id", "rows", total)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    alone = flat.where("refers_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return alone.select(*cols).unionByName(resolved.select(*cols))


SQL = """
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
grouped AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS first_id FROM sized)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN first_id END AS refers_to
FROM grouped
"""

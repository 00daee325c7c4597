"""Personal data: fixed-form entities, and bootstrapped contextual extraction.

Entities of a fixed form are the seeds. The words around a seed are its lexical patterns: the
one or two words before it, the word after it, and both sides together, each with and without
the shape of the token. The same pattern around another identifier-like token makes that
token an instance. Patterns and instances form a graph that Spark scores in turns: a pattern
by the scores of its instances, an instance by the patterns around it. Confident patterns then
give the instances that no fixed form describes. Texts are read once; what moves is one row
per entity or candidate and pattern, with a hash in place of the token.

Long runs of hexadecimal digits are seeds of a kind of their own, ``secret``: keys and tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, spread, text_or_empty, write_table

KINDS = ("email", "ip", "card", "phone")
#: What the method looks for: the kinds of fixed form, and secrets.
FOUND = (*KINDS, "secret")
#: Different instances that a pattern has at least.
LEAST_SUPPORT = 3
#: Least sum of its instances' scores over their number and one, so that few instances count for less.
LEAST_CONFIDENCE = 0.75
ROUNDS = 3
#: Words longer than this stand in a pattern by a digest of the whole word.
LONG_WORD = 64

# The characters of each form.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]++")
_SECRET = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])")
_SPACE = frozenset(" \t\n\r\x0b\x0c")
_END = re.compile(r"[\x20\x09-\x0D]")
_RUNS = re.compile(r"[0-9]+|[A-Za-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the run before it: a match starts at the run's start or where the last ended."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Entities of fixed form by kind, then start; offsets in code points.

    Leftmost and non-overlapping within a kind; a match that fails its test is dropped and
    not tried in another way.
    """
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(int(p[-9:]) <= 255 and not p[:-9].strip("0") for p in m.group().split(".")):
                spans.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                    spans.append(("phone", m.start(), m.end()))
    return spans


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """Runs of 32 hexadecimal digits or more, letters and digits among them."""
    found = (m for m in _SECRET.finditer(text))
    return [("secret", *m.span()) for m in found if not m.group().isdigit() and _DIGITS.search(m.group())]


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- candidates and their contexts -----------------------------------------------------


def _start_of(text: str, at: int) -> int:
    """Where the word that holds ``at`` starts."""
    while at > 0 and text[at - 1] not in _SPACE:
        at -= 1
    return at


def _end_of(text: str, at: int) -> int:
    m = _END.search(text, at)
    return m.start() if m else len(text)


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Whole tokens that look like an identifier (four digits, or an @) and lie outside all entities.

    What is neither letter nor digit at a token's ends is not part of it. A token has any length.
    """
    found: list[tuple[int, int]] = []
    taken = sorted((a, b) for _, a, b in spans)
    reach = 0  # of the entities that start before the token
    n, last = 0, -1
    marks = [m.start() for m in _DIGITS.finditer(text)]
    at = text.find("@")
    while at >= 0:
        marks.append(at)
        at = text.find("@", at + 1)
    for mark in sorted(marks):
        if mark < last:
            continue
        start, last = _start_of(text, mark), _end_of(text, mark)
        end = last
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while n < len(taken) and taken[n][0] < end:
            reach, n = max(reach, taken[n][1]), n + 1
        if reach > start:
            continue
        token = text[start:end]
        if "@" in token or sum(map(len, _DIGITS.findall(token))) >= 4:
            found.append((start, end))
    return found


def shape(token: str) -> str:
    """What a token is made of: its runs of letters and digits, with lengths where they are few."""
    runs = _RUNS.sub(lambda m: ("0" if m.group()[0].isdigit() else "a") + str(m.end() - m.start()) + ";", token)
    if len(runs) <= 24:
        return runs
    return f"mixed{len(token).bit_length()}{'@' * ('@' in token)}"


def possible(token: str) -> int:
    """The kinds of ``FOUND``, as bits, that a token may be at all."""
    digits, letters = sum(map(len, _DIGITS.findall(token))), any(map(str.isalpha, token))
    may = (
        "@" in token,
        not letters and "@" not in token and token.count(".") + token.count(":") >= 3,
        not letters and "@" not in token and digits >= 12,
        not letters and "@" not in token and 5 <= digits <= 15,
        letters and digits > 0 and "@" not in token and len(token) >= 8,
    )
    return sum(1 << i for i, yes in enumerate(may) if yes)


def _word(text: str, a: int, b: int) -> str:
    word = text[a:b].lower()
    if len(word) > LONG_WORD:
        return "#" + hashlib.blake2b(word.encode(), digest_size=12).hexdigest()
    return _DIGITS.sub("0", word)


def _word_before(text: str, at: int) -> tuple[int, int]:
    """The last run of letters and digits before ``at``; empty at the text's start."""
    while at > 0 and not text[at - 1].isalnum():
        at -= 1
    low = at
    while low > 0 and text[low - 1].isalnum():
        low -= 1
    return low, at


def _word_after(text: str, at: int) -> tuple[int, int]:
    while at < len(text) and not text[at].isalnum():
        at += 1
    high = at
    while high < len(text) and text[high].isalnum():
        high += 1
    return at, high


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a token: two words before it, one, one after it, one on either side.

    Words are whole runs of letters and digits, however long; lower-cased, digits masked. Each
    pattern comes by itself and with the token's shape.
    """
    a, b = _word_before(text, start)
    before = [_word(text, a, b)] if a < b else []
    if before:
        a, b = _word_before(text, a)
        before += [_word(text, a, b)] if a < b else []
    a, b = _word_after(text, end)
    after = _word(text, a, b) if a < b else ""
    found = [f"{w} _" for w in before[:1]]
    if len(before) == 2:
        found.append(f"{before[1]} {before[0]} _")
    if after:
        found.append(f"_ {after}")
        found += [f"{w} _ {after}" for w in before[:1]]
    made = shape(text[start:end])
    return [*found, *[f"{p} | {made}" for p in found]]


_LINK = [("pattern", pa.string()), ("instance", pa.int64()), ("kind", pa.string()), ("may", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]
_SCAN = pa.schema(
    [
        ("row", pa.string()), ("doc_id", pa.int64()),
        *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("base", pa.string()), ("seeds", pa.string()),
        ("links", pa.list_(pa.struct(_LINK))),
    ]
)
_SCAN_DDL = (
    "row string, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, seeds string, "
    "links array<struct<pattern: string, instance: bigint, kind: string, may: int, start: bigint, end: bigint>>"
)


def links_of(text: str, spans: list[tuple[str, int, int]]) -> list[tuple]:
    """``pattern, instance, kind, may, start, end`` of the entities in ``spans`` and of all candidates."""
    out = []
    for kind, a, b in [*spans, *((None, a, b) for a, b in candidates(text, spans))]:
        token = text[a:b].lower()
        h = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "little", signed=True)
        may = possible(token) if kind is None else 1 << FOUND.index(kind)
        if may:
            out += [(p, h, kind, may, a, b) for p in patterns(text, a, b)]
    return out


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its entities, and the links of entities and candidates to patterns."""
    names = [n for n, _ in _LINK]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                rows = []
                for doc_id, text in zip(batch.column(0).slice(low, 1024).to_pylist(), batch.column(1).slice(low, 1024), strict=True):
                    text = text.as_py()
                    spans, seeds = base_spans(text), secret_spans(text)
                    counts = [sum(s[0] == k for s in spans) for k in KINDS]
                    base = join_spans(spans)
                    links = [dict(zip(names, x, strict=True)) for x in links_of(text, spans + seeds)]
                    rows.append((f"{part}-{n}", doc_id, *counts, hashlib.sha256(base.encode()).hexdigest(), base, join_spans(seeds), links))
                    n += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCAN, strict=True)], schema=_SCAN)

    return spread(docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))).mapInArrow(run, _SCAN_DDL)


# ---- the graph -------------------------------------------------------------------------


def _may(kind: Column) -> Column:
    """Whether a token may be of the kind."""
    place = F.array_position(F.array(*map(F.lit, FOUND)), kind).cast("int") - 1
    return F.call_function("getbit", F.col("may"), place) == 1


def confident_patterns(links: DataFrame, *, rounds: int = ROUNDS, least_support: int = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """``pattern, kind, confidence, n`` of the patterns that bootstrapping ends with.

    ``links`` has ``pattern, instance, kind, may``; kind is null where the instance is a candidate.
    A pattern's confidence in a kind is the sum of its different instances' scores for it over
    one more than the number of its instances that may be of that kind. Seeds score 1 for their kind;
    each round gives every candidate the confidence of its best pattern, where that reaches
    ``least_confidence``. Of a pattern's kinds the most confident counts, ties by name.
    """
    edges = write_table(links.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.max("may").alias("may")), "pii-edges")
    sizes = write_table(edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= least_support), "pii-patterns")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # Patterns below the least support never count, so their links end here. One without a seed
    # stays: a later round may reach it through what another pattern found.
    graph = write_table(join_hot(edges, sizes, "pattern", "n", total), "pii-graph")
    rivals = graph.select("pattern", "may", "n").groupBy("pattern").agg(F.first("n").alias("n"), *[F.sum(F.call_function("getbit", F.col("may"), F.lit(i)).cast("long")).alias(k) for i, k in enumerate(FOUND)])
    rivals = write_table(rivals, "pii-rivals")
    among = F.element_at(F.create_map(*[x for k in FOUND for x in (F.lit(k), F.col(k))]), F.col("kind"))
    known = graph.where("kind is not null").select("pattern", "kind", F.lit(1.0).alias("score"))
    open_ = graph.where("kind is null").select("pattern", "instance", "may")
    scored = known
    best = None
    for turn in range(rounds):
        sums = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("held"))
        confident = sums.join(rivals, "pattern").select("pattern", "kind", (F.col("held") / (among + 1)).alias("confidence"), "n").where(F.col("confidence") >= least_confidence)
        best = write_table(confident.groupBy("pattern").agg(F.max(F.struct("confidence", "kind")).alias("top"), F.first("n").alias("n")), f"pii-scores-{turn}")
        if turn == rounds - 1:
            break
        found = join_hot(open_, best, "pattern", "n", total).where(_may(F.col("top.kind")))
        scores = write_table(found.groupBy("instance").agg(F.max("top").alias("s"), F.count("*").alias("links")), f"pii-found-{turn}")
        most = scores.agg(F.sum("links")).first()[0] or 0
        again = join_hot(open_.select("pattern", "instance"), scores, "instance", "links", most)
        scored = known.unionByName(again.select("pattern", F.col("s.kind").alias("kind"), F.col("s.confidence").alias("score")))
    return best.select("pattern", F.col("top.kind").alias("kind"), F.col("top.confidence").alias("confidence"), "n")


def find(docs: DataFrame, *, rounds: int = ROUNDS, least_support: int = LEAST_SUPPORT, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found, n_spans``.

    Counts and ``base_sha256`` are of the entities of fixed form; ``spans`` has those, secrets and
    the discovered ones as ``kind:start:end``, by kind and start; ``n_found`` counts what the
    method added, ``n_spans`` all. Null text is empty; texts and tokens have any length; every
    row is read for itself, repeated identifiers included, and repeated texts give the same
    spans; an instance counts once a pattern, however often it occurs. Other columns are
    ignored; an empty table gives no rows.
    """
    scanned = write_table(scan(docs), "pii-scan")
    links = scanned.select("row", F.explode("links").alias("x")).select("row", "x.*")
    chosen = write_table(confident_patterns(links, rounds=rounds, least_support=least_support, least_confidence=least_confidence), "pii-chosen")
    total = chosen.agg(F.sum("n")).first()[0] or 0
    hits = join_hot(links.where("kind is null").drop("kind"), chosen, "pattern", "n", total).where(_may(F.col("kind")))
    spans = hits.groupBy("row", "start", "end").agg(F.max(F.struct("confidence", "kind")).alias("top")).select("row", "start", "end", F.col("top.kind").alias("kind"))
    per_row = spans.groupBy("row").agg(F.collect_list(F.concat_ws(":", "kind", "start", "end")).alias("found"))  # of one document
    out = scanned.select("row", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "base", "seeds").join(per_row, "row", "left")
    split = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    more = F.concat(split("seeds"), F.coalesce("found", F.array().cast("array<string>")))
    kind_of = lambda x: F.array_position(F.array(*map(F.lit, FOUND)), F.split_part(x, F.lit(":"), F.lit(1)))
    keyed = F.transform(F.concat(split("base"), more), lambda x: F.struct(kind_of(x).alias("k"), F.split_part(x, F.lit(":"), F.lit(2)).cast("long").alias("a"), x.alias("s")))
    return out.select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.array_join(F.transform(F.array_sort(keyed), lambda x: x.s), ",").alias("spans"),
        F.size(more).cast("long").alias("n_found"), F.size(keyed).cast("long").alias("n_spans"),
    )

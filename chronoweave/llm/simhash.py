"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at ``radius`` 3 or less differ in at most one bit in one of their halves of 32
bits. So every fingerprint emits, for each half, the half itself and all its variants within
half the radius (rounded down: one bit), and a variant that meets another's half is a
candidate, verified on all 64 bits. That is 68 rows a distinct fingerprint; balls of the
whole fingerprint would need two bits on one side, 2,081 rows.

A half that very many different fingerprints share is split again in the same way: what
differs in such a pair leaves at most one bit in one of the two quarters of the other half.
Equal fingerprints are one row throughout, so copies cost nothing.

A radius of 3 in 64 bits reaches only texts that are nearly equal. For any other similarity
:func:`ball_plan` takes several tables of fewer bits. Of every table both texts emit the ball of
``REACH`` bits around their own fingerprint, over the ``UNSURE`` bits whose sums are
nearest to even: those are the ones that differ between similar texts. Two balls
that share a point meet in the middle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, text_or_empty, write_table
from .components import connected_components

SEED = 42
#: Different fingerprints that share a half before it is split by quarters.
SHARED = 2048
#: Shingles whose bits are counted at once.
BLOCK = 1 << 16
#: Radius of the balls of a table, and the bits that they are over.
REACH = 2
UNSURE = 4
#: Share of pairs at the similarity itself that all tables together may miss.
MISSED = 0.001


def fingerprint(text: str, *, shingle: int = 3, seed: int = SEED) -> int:
    """64 bits; a bit is set where over half the shingles' hashes set it. No words: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - shingle + 1].tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle=shingle, seed=seed) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, fp long")


def _part(fp: Column, bits: int, index: Column | int) -> Column:
    """Part ``index`` of ``bits`` bits, lowest first."""
    shift = F.lit(index * bits) if isinstance(index, int) else index * bits
    return F.call_function("shiftrightunsigned", fp, shift.cast("int")).bitwiseAND(F.lit((1 << bits) - 1))


def _parts(fp: Column, bits: int, indexes: list) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("place"), _part(fp, bits, i).alias("value")) for n, i in enumerate(indexes)])


def _balls(fp: Column, bits: int, indexes: list) -> Column:
    """The parts and all their variants at one bit."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b).cast("long") for b in range(bits)])
    return F.flatten(F.transform(_parts(fp, bits, indexes), lambda p: F.transform(flips, lambda f: F.struct(p.place.alias("place"), p.value.bitwiseXOR(f).alias("value")))))


def close_pairs(fps: DataFrame, *, radius: int = 3, shared: int = SHARED) -> DataFrame:
    """``a, b`` with ``a < b``: the different fingerprints of ``fps (fp)`` at ``radius`` bits or fewer.

    Exact for a radius up to 3.
    """
    if not 0 <= radius <= 3:
        raise ValueError("half-balls of one bit reach a radius of 3")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    ordered = F.col("a") < F.col("b")
    centres = fps.select(F.col("fp").alias("b"), F.explode(_parts(F.col("fp"), 32, [0, 1])).alias("k")).select("b", "k.*")
    balls = fps.select(F.col("fp").alias("a"), F.explode(_balls(F.col("fp"), 32, [0, 1])).alias("k")).select("a", "k.*")
    full = write_table(centres.groupBy("place", "value").agg(F.count("*").alias("n")).where(F.col("n") > shared), "simhash-full")
    key = ["place", "value"]
    if full.isEmpty():
        return balls.join(centres, key).where(ordered & close).select("a", "b").distinct()
    found = balls.join(full, key, "left_anti").join(centres, key).where(ordered & close).select("a", "b")
    # In a full half the other half decides: its quarters, numbered after the place of the full one.
    other = [2 - 2 * F.col("place"), 3 - 2 * F.col("place")]
    inner = lambda df, c, make: df.join(full, key, "left_semi").select(c, *key, F.explode(make(F.col(c), 16, other)).alias("q")).select(c, *key, F.col("q.place").alias("quarter"), F.col("q.value").alias("inner"))
    split = inner(balls, "a", _balls).join(inner(centres, "b", _parts), [*key, "quarter", "inner"]).where(ordered & close).select("a", "b")
    return found.unionByName(split).distinct()


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3, seed: int = SEED) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id reachable over links of ``radius`` bits or fewer.
    Null text is empty; texts without words have fingerprint 0 and link like any other. A
    group without any identifier has a null component. Rows are read one by one, also those
    that repeat; other columns are ignored; an empty table gives no rows.
    """
    hashed = write_table(fingerprints(docs, shingle=shingle, seed=seed), "simhash-rows")
    groups = write_table(hashed.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    links = write_table(close_pairs(groups.select("fp"), radius=radius), "simhash-links")
    roots = write_table(connected_components(links), "simhash-roots")
    linked = groups.join(roots, F.col("fp") == F.col("node"))
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("size"))
    members = join_hot(linked.select("fp", "n", "root"), lows, "root", "size", roots.count()).select("fp", "n", "component_id")
    alone = groups.join(roots, F.col("fp") == F.col("node"), "left_anti").select("fp", "n", F.col("low").alias("component_id"))
    named = write_table(members.unionByName(alone), "simhash-named")
    return join_hot(hashed, named, "fp", "n", total).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ---- tables of fingerprints for a given similarity -----------------------------------


@dataclass(frozen=True)
class BallPlan:
    """``tables`` fingerprints of ``bits`` bits, and 64 bits more that only verify."""

    tables: int
    bits: int
    #: Chance that a bit differs between two texts at the similarity.
    differs: float

    @property
    def words(self) -> int:
        return 1 + -(-self.tables * self.bits // 64)

    def most(self, bits: int, deviations: float) -> int:
        """Differing bits, of ``bits``, that similar texts have at most but for so many standard deviations."""
        return math.floor(bits * self.differs + deviations * math.sqrt(bits * self.differs * (1 - self.differs)))


@lru_cache(maxsize=64)
def ball_plan(texts: int, least: float) -> BallPlan:
    """Tables that miss ``MISSED`` of the pairs whose sets of shingles have Jaccard ``least``.

    The bits of a table grow with the logarithm of the number of texts, so that a text meets a bounded
    number of strangers in a table. The cosine of two sets is at least ``2 * least / (1 + least)``; how
    often balls meet at it is drawn, with a seed, from the normal sums that it gives.
    """
    bits = min(48, max(12, texts.bit_length() + 2))
    cosine = min(1.0, 2 * least / (1 + least))
    draw = np.random.default_rng(SEED)
    a, other = draw.standard_normal((2, 20_000, bits))
    b = cosine * a + math.sqrt(1 - cosine * cosine) * other
    apart = (a > 0) != (b > 0)
    in_a, in_b = (np.argsort(np.argsort(np.abs(x), 1), 1) < UNSURE for x in (a, b))
    only_a, only_b = ((apart & x & ~y).sum(1) for x, y in ((in_a, in_b), (in_b, in_a)))
    meet = ~(apart & ~in_a & ~in_b).any(1) & (only_a <= REACH) & (only_b <= REACH) & (apart.sum(1) <= 2 * REACH)
    tables = max(1, math.ceil(math.log(MISSED) / math.log(max(1e-9, 1 - meet.mean()))))
    return BallPlan(tables, bits, math.acos(cosine) / math.pi)


def signature(hashes: np.ndarray, plan: BallPlan) -> tuple[np.ndarray, np.ndarray, int]:
    """``codes, unsure, check`` of a set of 64-bit hashes.

    Of each table its bits, and the places of its ``UNSURE`` least certain ones, six bits each; then the bits that only verify.
    """
    salts = (np.arange(plan.words, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(64 * plan.words, np.int64)
    for at in range(0, len(hashes), 4080):
        x = hashes[at : at + 4080, None] + salts
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        set_ = np.unpackbits((x ^ (x >> np.uint64(31))).view(np.uint8), axis=1, bitorder="little")
        for low in range(0, len(set_), 255):  # no more than a byte counts
            counts += set_[low : low + 255].sum(0, dtype=np.uint8)
    sums = 2 * counts - len(hashes)
    check = int.from_bytes(np.packbits(sums[:64] > 0, bitorder="little").tobytes(), "little", signed=True)
    own = sums[64 : 64 + plan.tables * plan.bits].reshape(plan.tables, plan.bits)
    codes = ((own > 0) << np.arange(plan.bits, dtype=np.int64)).sum(1)
    near = np.argsort(np.abs(own), axis=1, kind="stable")[:, :UNSURE]
    return codes, (near << (6 * np.arange(UNSURE, dtype=np.int64))).sum(1), check


def ball_keys(code: Column, unsure: Column, table: Column, plan: BallPlan) -> Column:
    """The points of a table's ball, an array of numbers that no other table has."""
    flips = [F.call_function("shiftleft", F.lit(1).cast("long"), F.call_function("shiftright", unsure, F.lit(6 * i)).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(UNSURE)]
    centre = F.call_function("shiftleft", table.cast("long"), F.lit(plan.bits)).bitwiseOR(code)
    points = []
    for n in range(REACH + 1):
        for chosen in combinations(flips, n):
            point = centre
            for flip in chosen:
                point = point.bitwiseXOR(flip)
            points.append(point)
    return F.array(*points)

"""Near copies at Jaccard 0.8 against brute force, and rows without an identifier or with a repeated one."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronoweave.llm import near_copies, simhash

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in rows], DDL).repartition(3)


def plain(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def similar(a, b):
    return len(plain(a) & plain(b)) / len(plain(a) | plain(b))


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, words, least):
    """A copy with words replaced until one more would fall below the similarity."""
    out, base = words.copy(), " ".join(words)
    for at in rng.sample(range(len(words)), len(words)):
        held, out[at] = out[at], f"z{rng.randrange(10**9)}"
        if similar(base, " ".join(out)) < least:
            out[at] = held
            break
    return out


def test_shingles_are_exact():
    rng = random.Random(1)
    for n in (0, 1, 4, 5, 6, 300):
        a = prose(rng, n)
        b = edited(rng, a, 0.7) if n else a
        got = near_copies.jaccard(near_copies.shingles(" ".join(a)), near_copies.shingles(" ".join(b)))
        assert got == pytest.approx(similar(" ".join(a), " ".join(b)))


def test_near_copies_at_the_bound_go(spark):
    """Isolated pairs just above 0.8 and 0.9: at least 98 of 100 are found, whatever their length."""
    rng = random.Random(2)
    rows, cells = [], {}
    for words in (100, 300, 1000):
        for least in (0.8, 0.9):
            for _ in range(50):
                a = prose(rng, words)
                b = edited(rng, a, least)
                cells.setdefault((words, least), []).append(len(rows) + 1)
                rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    kept = {r.doc_id for r in corpus_pipeline.near(spark, frame(spark, rows), "").collect()}
    assert {i for i, _ in rows if i % 2 == 0} <= kept
    found = {c: np.mean([i not in kept for i in ids]) for c, ids in cells.items()}
    assert min(found.values()) >= 0.98, found


def test_texts_of_one_shingle_repeated_stay(spark):
    """Equal fingerprints, as one shingle outnumbers the others, but far from similar."""
    rng = random.Random(3)
    rows = [(i, " ".join(["again"] * 400 + prose(rng, 60))) for i in range(12)]
    assert {r.doc_id for r in corpus_pipeline.near(spark, frame(spark, rows), "").collect()} == set(range(12))


@pytest.mark.parametrize("shared", [2, 32])
def test_crowded_buckets(spark, shared):
    """A large group around one text, and texts under 0.8 that share a passage."""
    rng = random.Random(4)
    base, passage = prose(rng, 200), prose(rng, 150)
    rows = [(500, " ".join(base))] + [(501 + i, " ".join(edited(rng, base, 0.85))) for i in range(60)]
    rows += [(i, " ".join(passage + prose(rng, 60))) for i in range(60)]
    rows += [(900 + i, " ".join(edited(rng, rows[61 + i][1].split(), 0.8))) for i in range(10)]
    got = near_copies.without_near_copies(frame(spark, rows), shared=shared)
    assert sorted(r.doc_id for r in got.collect()) == [*range(60), 500]


def test_rows_without_or_with_repeated_identifiers(spark):
    rng = random.Random(5)
    text = lambda: prose(rng, 120)
    a, b, c, d = text(), text(), text(), text()
    copy = lambda w: " ".join(edited(rng, w, 0.9))
    own = [" ".join(text()) for _ in range(4)]
    # A null near an identified text, unique texts without identifier and under a repeated one.
    rows = [(1, " ".join(a)), (None, copy(a)), (None, own[0]), (None, own[1])]
    rows += [(2, " ".join(b)), (9, copy(b)), (9, own[2]), (9, own[3])]
    # Near copies that all share an identifier, or have none; rows that repeat.
    rows += [(4, " ".join(c)), (4, copy(c)), (4, copy(c)), (None, " ".join(d)), (None, copy(d)), (1, " ".join(a)), (None, own[0])]
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near(spark, frame(spark, rows), "").collect()), key=repr)
    fours = {t for i, t in rows if i == 4}
    nulls = {" ".join(d), rows[12][1]}
    assert [t for i, t in got if i == 4 and t in fours] and sum(t in fours for _, t in got) == 1
    assert sum(t in nulls for _, t in got) == 1
    rest = [(i, t) for i, t in got if t not in fours | nulls]
    assert rest == sorted([(1, " ".join(a)), (2, " ".join(b)), (None, own[0]), (None, own[1]), (9, own[2]), (9, own[3])], key=repr)
    assert corpus_pipeline.near(spark, frame(spark, rows[:0]), "").count() == 0


def ball(code, unsure):
    """All points at up to two of the four bits, one by one."""
    bits = [int(unsure) >> 6 * i & 63 for i in range(4)]
    return {int(code) ^ sum(1 << b for b in some) for n in range(3) for some in itertools.combinations(bits, n)}


def test_ball_points_by_brute_force(spark):
    plan = simhash.ball_plan(240_000, 0.8)
    rng = np.random.default_rng(1)
    codes, unsure, _ = simhash.signature(np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64)), plan)
    frame = spark.createDataFrame([(i, int(c), int(u)) for i, (c, u) in enumerate(zip(codes, unsure))], "table int, code long, unsure long")
    for r in frame.select("*", simhash.ball_keys(F.col("code"), F.col("unsure"), F.col("table"), plan).alias("points")).collect():
        assert len(r.points) == 11 and {p - (r.table << plan.bits) for p in r.points} == ball(r.code, r.unsure)


@pytest.mark.parametrize("words", [8, 12, 30, 100, 300])
def test_balls_meet_at_the_bound(words):
    """At the size of a large table: nearly all pairs just above 0.8 share a point and pass both comparisons of bits."""
    rng, plan = random.Random(words), simhash.ball_plan(240_000, 0.8)
    found = total = 0
    for _ in range(200):
        a = prose(rng, words)
        b = [*a, "one"] if words < 12 else edited(rng, a, 0.8)
        sets = [near_copies.shingles(" ".join(x), 5) for x in (a, b)]
        (codes, unsure, check), (codes2, unsure2, check2) = (simhash.signature(x, plan) for x in sets)
        small = set(near_copies.small_points(sets[0], 0.8)) & set(near_copies.small_points(sets[1], 0.8))
        meet = small or any(ball(*x) & ball(*y) for x, y in zip(zip(codes, unsure), zip(codes2, unsure2)))
        differ = sum((int(x) ^ int(y)).bit_count() for x, y in zip(codes, codes2))
        alike = ((check ^ check2) & (1 << 64) - 1).bit_count() <= plan.most(64, 4.5) and differ <= plan.most(plan.tables * plan.bits, 6)
        found, total = found + bool(meet and alike), total + 1
    assert found >= 0.985 * total


def test_the_stage_goes_through_the_balls(spark, monkeypatch):
    """Without common points there are no links: nothing beside the fingerprints' balls proposes pairs."""
    rng = random.Random(6)
    rows = [(i + j, " ".join(t)) for i in range(0, 40, 2) for a in [prose(rng, 100)] for j, t in enumerate((a, edited(rng, a, 0.9)))]
    assert corpus_pipeline.near(spark, frame(spark, rows), "").count() == 20
    monkeypatch.setattr(near_copies, "ball_keys", lambda code, unsure, table, plan: F.array(F.monotonically_increasing_id()))
    assert corpus_pipeline.near(spark, frame(spark, rows), "").count() == 40


def test_short_texts_with_one_word_more_go(spark):
    rng = random.Random(7)
    rows = [(i + j, t) for i in range(0, 400, 2) for a in [" ".join(prose(rng, 8 + i % 3))] for j, t in enumerate((a, a + " one"))]
    rows += [(1000 + i, " ".join(prose(rng, 1 + i % 5))) for i in range(100)]
    kept = sorted(r.doc_id for r in corpus_pipeline.near(spark, frame(spark, rows), "").collect())
    assert kept == [*range(0, 400, 2), *range(1000, 1100)]

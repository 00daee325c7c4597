"""Windows, merging, speakers, coverage and guards: cases by hand and against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronoweave.functions import fixed, schema
from chronoweave.operators import control, coverage, detecting, islands, merging, planning, rangejoin, speakers

SR = {"window": 30_000, "overlap": 20_000, "least_overlap": 5_000, "tolerance": 3_000}


def words(spark, rows):
    """``(text, start, end, window, centre2)``"""
    data = [(1, "m", i, t, a, b, w, c) for i, (t, a, b, w, c) in enumerate(rows)]
    return spark.createDataFrame(data, schema.WORDS)


def turns(spark, rows):
    return spark.createDataFrame([(1, i, a, b, s) for i, (a, b, s) in enumerate(rows)], schema.TURNS)


def segments(spark, rows):
    return spark.createDataFrame([(1, "m", i, a, b, s, t) for i, (a, b, s, t) in enumerate(rows)], schema.SEGMENTS)


def keyed(spark, ms):
    return spark.createDataFrame([(1, "m", ms)], "recording_id long, model string, duration_ms long")


# ---- windows -------------------------------------------------------------------------


def test_plan_reaches_the_end():
    found = planning.plan_one(90_000, [], **SR)
    assert found[0] == (0, 30_000) and found[-1][1] == 90_000
    assert all(b[0] < a[1] for a, b in zip(found, found[1:], strict=False))


def test_plan_snaps_to_silence():
    assert planning.plan_one(90_000, [28_500], **SR)[0] == (0, 28_500)
    assert planning.plan_one(90_000, [26_000], **SR)[0] == (0, 30_000)
    assert planning.plan_one(90_000, [29_000, 31_000], **SR)[0] == (0, 29_000)


def test_tiny_recordings():
    assert planning.plan_one(1, [], **SR) == []
    assert planning.plan_one(0, [], **SR) == []
    assert planning.plan_one(300, [], **SR) == [(0, 300)]


def test_plan_by_brute_force(spark):
    rng = random.Random(5)

    def slow(n, mids):
        snap = lambda t: min(sorted(m for m in mids if abs(m - t) <= 3000) or [t], key=lambda m: abs(m - t))
        out, pos = [], 0
        while pos < n and len(out) < 10_000:
            end = n if pos + 30_000 >= n else snap(pos + 30_000)
            out.append((pos, end))
            if end >= n:
                break
            nxt = min(snap(end - 20_000), end - 5_000)
            pos = nxt if nxt > pos else pos + 5_000
        while out and out[-1][1] - out[-1][0] < 300:
            out.pop()
        return out

    recs, quiet, want = [], [], {}
    for r in range(30):
        n = rng.randint(1, 300_000)
        spans = sorted((s, s + rng.randint(100, 3000)) for s in rng.sample(range(300_000), rng.randint(0, 40)))
        recs.append((r, n))
        quiet += [(r, a, b) for a, b in spans]
        want[r] = slow(n, [(a + b) // 2 for a, b in spans])
    got = planning.window_plan(spark.createDataFrame(recs, schema.RECORDINGS), spark.createDataFrame(quiet, schema.SILENCES), **SR).collect()
    for r, n in recs:
        assert [(x.start_ms, x.end_ms) for x in sorted((g for g in got if g.recording_id == r), key=lambda g: g.window_idx)] == want[r], n


def test_grid_equals_plan_without_silences(spark):
    lengths = [(i, n) for i, n in enumerate([0, 1, 299, 300, 29_999, 30_000, 30_001, 40_000, 40_001, 123_456, 200_000_000])]
    got = planning.window_grid(spark.createDataFrame(lengths, schema.RECORDINGS), window=30_000, step=10_000).collect()
    for i, n in lengths:
        assert sorted((g.start_ms, g.end_ms) for g in got if g.recording_id == i) == planning.plan_one(n, [], **SR)


def test_silences(spark):
    loud = [1, 0, 0, 0, 0, 1, 0, 1, 0, 0, 0, 0]
    frames = spark.createDataFrame([(1, i, x) for i, x in enumerate(loud)], "recording_id long, frame_idx long, amp int")
    find = lambda **k: sorted((r.start_ms, r.end_ms) for r in planning.silences(frames, loud=F.col("amp") > 0, frame_ms=50, least_ms=200, **k).collect())
    assert find() == [(50, 250), (400, 600)]
    assert find(lengths=spark.createDataFrame([(1, 630)], schema.RECORDINGS)) == [(50, 250), (400, 630)]


def test_batches(spark):
    grid = planning.window_grid(spark.createDataFrame([(1, 200_000)], schema.RECORDINGS), window=30_000, step=10_000)
    got = planning.in_batches(grid, 16).groupBy("batch_idx").count().collect()
    assert sorted(map(tuple, got)) == [(0, 16), (1, 2)]


# ---- merging -------------------------------------------------------------------------


def kept(df):
    return [(r.text, r.window_idx) for r in merging.merge_overlaps(df).orderBy("start_ms", "seq").collect()]


def test_owner_wins(spark):
    base = [("a", 1_000, 1_200, 0, 30_000), ("b", 40_000, 40_200, 1, 60_000)]
    assert kept(words(spark, [*base, ("hello", 25_100, 25_500, 0, 30_000), ("hello", 25_100, 25_500, 1, 60_000)])) == [("a", 0), ("hello", 1), ("b", 1)]
    assert ("did not", 1) in kept(words(spark, [*base, ("didn't", 25_100, 25_500, 0, 30_000), ("did not", 25_100, 25_500, 1, 60_000)]))


def test_three_windows_and_empty_one(spark):
    three = [("x", 27_000, 27_100, w, c) for w, c in ((0, 30_000), (1, 50_000), (2, 70_000))]
    assert kept(words(spark, three)) == [("x", 1)]
    assert kept(words(spark, [three[0], three[2]])) == [("x", 2)]  # the window between gave nothing


def test_merge_edges(spark):
    assert kept(words(spark, [])) == []
    assert kept(words(spark, [("a", 5, 6, 0, 30), ("b", 3, 4, 0, 30)])) == [("b", 0), ("a", 0)]
    same = [("a", 10, 12, 0, 30), ("b", 10, 12, 1, 30)]  # equal centres: the first owns nothing below it
    assert kept(words(spark, same)) == [("a", 0)]
    on_edge = [("a", 25, 26, 0, 40), ("a", 25, 26, 1, 60), ("z", 90, 91, 1, 60)]
    assert kept(words(spark, on_edge)) == [("a", 1), ("z", 1)]


def test_merge_by_brute_force(spark):
    rng = random.Random(3)
    rows = [("w", s, s + 5, w, 2 * (w * 100 + 150)) for s in range(0, 1000, 7) for w in range(10) if w * 100 <= s < w * 100 + 300 and rng.random() < 0.7]
    centres = sorted({r[4] for r in rows})
    want = set()
    for _, s, _, w, c in rows:
        i = centres.index(c)
        low = (centres[i - 1] + c) / 4 if i else float("-inf")
        high = (centres[i + 1] + c) / 4 if i + 1 < len(centres) else float("inf")
        if low <= s < high:
            want.add((s, w))
    assert {(r.start_ms, r.window_idx) for r in merging.merge_overlaps(words(spark, rows)).collect()} == want


def test_flatten_hypotheses(spark):
    kind = f"recording_id long, model string, window_idx int, start double, end double, hypothesis struct<{schema.HYPOTHESIS.replace(' struct', ': struct', 1)}>"
    data = [(1, "m", 0, 10.0, 40.0, (([(" a ", 1.0, None), ("", 2.0, 3.0), ("b", None, None)],),)), (1, "m", 1, 20.0, 50.0, None)]
    got = merging.flatten_hypotheses(spark.createDataFrame(data, kind)).orderBy("pos").collect()
    assert [(r.text, r.abs_start, r.abs_end, r.window_center) for r in got] == [("a", 11.0, 11.0, 25.0), ("b", 10.0, 10.0, 25.0)]


# ---- speakers ------------------------------------------------------------------------


def who(spark, word_rows, turn_rows, **k):
    w = words(spark, [("w", a, b, 0, 0) for a, b in word_rows])
    return [r.speaker for r in speakers.assign_speakers(w, turns(spark, turn_rows), **k).orderBy("seq").collect()]


def test_speakers(spark):
    assert who(spark, [(30_000, 30_300)], [(0, 30_600, "SPEAKER_00"), (30_600, 60_000, "SPEAKER_01")]) == ["SPEAKER_00"]
    assert who(spark, [(100_000, 100_200)], [(0, 60_000, "A")]) == [fixed.UNKNOWN_SPEAKER]
    assert who(spark, [(5_000, 5_000)], [(4_000, 5_000, "B"), (5_000, 6_000, "A")]) == ["B"]  # a tie goes to the earlier turn
    assert who(spark, [(5_000, 5_000)], [(5_000, 5_000, "A")]) == [fixed.UNKNOWN_SPEAKER]
    assert who(spark, [(5_000, 5_200)], [(0, 9_000, "A")], smoothing_ms=0) == [fixed.UNKNOWN_SPEAKER]
    assert who(spark, [], [(0, 9_000, "A")]) == []


def test_speakers_by_brute_force(spark):
    rng = random.Random(9)
    ws = [(s, s + rng.randint(0, 800)) for s in (rng.randint(0, 120_000) for _ in range(300))]
    ts = [(s, s + rng.randint(0, 40_000), rng.choice("ABC")) for s in (rng.randint(0, 110_000) for _ in range(40))]
    want = []
    by_start = sorted(enumerate(ts), key=lambda t: (t[1][0], t[0]))
    for a, b in ws:
        held: dict[str, float] = {}
        for _, (s, e, who_) in by_start:
            part = min((a + b) / 2 + 1000, e) - max((a + b) / 2 - 1000, s)
            if part > 0:
                held[who_] = held.get(who_, 0) + part
        want.append(max(held, key=held.get) if held else fixed.UNKNOWN_SPEAKER)
    assert who(spark, ws, ts) == want


def test_segments(spark):
    rows = [(i, "A" if i in (0, 1, 3) else "BC"[i > 3], f"t{i}") for i in range(5)]
    df = spark.createDataFrame([(1, "m", i, t, i * 1000, i * 1000 + (900 if i else 5000), s) for i, s, t in rows], "recording_id long, model string, seq long, text string, start_ms long, end_ms long, speaker string")
    got = speakers.build_segments(df).orderBy("seg_seq").collect()
    assert [(r.speaker, r.text, r.start_ms, r.end_ms) for r in got] == [("A", "t0 t1", 0, 1900), ("B", "t2", 2000, 2900), ("A", "t3", 3000, 3900), ("C", "t4", 4000, 4900)]
    assert speakers.build_segments(df, max_gap_ms=50).count() == 4 + 0
    assert speakers.build_segments(df.limit(0)).count() == 0


def test_speaker_summary(spark):
    segs = segments(spark, [(0, 5, "SPEAKER_00", " "), (5, 9, "SPEAKER_00", "hi there"), (9, 10, "X", "x")])
    got = {r.speaker_raw: r for r in speakers.speaker_summary(segs, turns(spark, [(0, 8, "SPEAKER_00"), (8, 9, "SPEAKER_07")])).collect()}
    assert {k: (v.speaker, v.diarized_ms, v.transcript_word_count, v.first_sample_text) for k, v in got.items()} == {
        "SPEAKER_00": ("Speaker 1", 8, 2, "hi there"), "SPEAKER_07": ("Speaker 8", 1, 0, ""), "X": ("X", 0, 1, "x")}
    shares = {r.speaker: r.share_pct for r in speakers.speaker_shares(turns(spark, [(0, 3, "A"), (3, 4, "B")])).collect()}
    assert shares == {"A": 75.0, "B": 25.0}
    assert speakers.speaker_shares(turns(spark, [(3, 3, "A")])).first().share_pct == 0.0


# ---- coverage ------------------------------------------------------------------------


def audited(spark, turn_rows, seg_rows, **k):
    summary, gaps = coverage.audit(turns(spark, turn_rows), segments(spark, [(a, b, "x", "") for a, b in seg_rows]), keyed(spark, 100_000), **k)
    s = summary.first()
    return s.covered_ms, s.coverage_pct, sorted((g.start_ms, g.end_ms) for g in gaps.collect())


def test_coverage(spark):
    assert audited(spark, [], [(0, 5)]) == (0, 100.0, [])
    assert audited(spark, [(0, 10_000, "A")], [(0, 5_000)]) == (5_000, 50.0, [(5_000, 10_000)])
    assert audited(spark, [(0, 10_000, "A")], []) == (0, 0.0, [(0, 10_000)])
    assert audited(spark, [(0, 10_000, "A")], [(0, 9_500)])[2] == []
    assert audited(spark, [(0, 10_000, "A")], [(0, 9_000)]) == (9_000, 90.0, [])
    assert audited(spark, [(0, 10_000, "A")], [(0, 6_000), (4_000, 10_000)]) == (10_000, 100.0, [])
    assert audited(spark, [(0, 10_000, "A"), (5_000, 15_000, "B")], [(5_000, 10_000)]) == (10_000, 50.0, [(0, 5_000), (10_000, 15_000)])
    # An empty segment splits the gap that it lies in.
    assert audited(spark, [(0, 3_000, "A")], [(1_500, 1_500)]) == (0, 0.0, [])


def test_coverage_by_brute_force(spark):
    rng = random.Random(4)
    ts = [(s, s + rng.randint(1, 50), "A") for s in (rng.randint(0, 400) for _ in range(15))]
    ss = [(s, s + rng.randint(1, 20)) for s in (rng.randint(0, 400) for _ in range(30))]
    covered, gaps = 0, []
    for a, b, _ in ts:
        mask = [any(s <= x < e for s, e in ss) for x in range(a, b)]
        covered += sum(mask)
        x = a
        while x < b:
            if mask[x - a]:
                x += 1
                continue
            y = x
            while y < b and not mask[y - a]:
                y += 1
            if y - x > 3 and y - x >= 5:
                gaps.append((x, y))
            x = y
    got = audited(spark, ts, ss, grace_ms=3, least_ms=5)
    assert (got[0], got[2]) == (covered, sorted(gaps))


def test_tail_and_warnings(spark):
    tail = lambda last: coverage.tail_gaps(keyed(spark, 6_917_000), segments(spark, last)).first()
    assert (tail([(0, 6_892_000, "A", "x")]).gap_ms, tail([(0, 6_892_000, "A", "x")]).ok) == (25_000, True)
    assert (tail([(0, 6_575_000, "A", "x"), (9, 10, "A", "y")]).gap_ms, tail([(0, 6_575_000, "A", "x")]).ok) == (342_000, False)
    assert (tail([]).gap_ms, tail([]).ok) == (6_917_000, False)
    summary, _ = coverage.audit(turns(spark, [(0, 10, "A")]), segments(spark, []), keyed(spark, 50_000))
    found = coverage.warnings(summary, coverage.tail_gaps(keyed(spark, 50_000), segments(spark, []))).orderBy("place").collect()
    assert [(w.severity, w.kind) for w in found] == [("high", "coverage_below_threshold"), ("critical", "trailing_gap")]


def test_frame_mask(spark):
    frames = spark.createDataFrame([(1, i, i not in (3, 4)) for i in range(12)], "recording_id long, frame_idx long, s boolean")
    segs = spark.createDataFrame([(1, 0, 61)], "recording_id long, start_ms long, end_ms long")
    mask = coverage.frame_cover(frames, segs, frame_ms=30, speech=F.col("s"))
    assert coverage.frame_summary(mask, frame_ms=30).first()[1:] == (360, 300, 90, 30.0)
    assert [(r.start_ms, r.end_ms) for r in coverage.frame_gaps(mask, frame_ms=30, least_ms=100).collect()] == [(150, 360)]


# ---- detectors -----------------------------------------------------------------------


def test_inversions(spark):
    a = lambda t, text: segments(spark, [(t, t + 10, "SPEAKER_00", text)])
    found = detecting.inversions(a(10_000, "this Hypertonic thing"), a(13_000, "this hypotonic thing")).collect()
    assert [(r.time_ms, r.speaker, r.first_word, r.second_word) for r in found] == [(10_000, "Speaker 1", "Hypertonic", "hypotonic")]
    assert detecting.inversions(a(10_000, "hyper"), a(13_001, "hypo")).count() == 0
    assert detecting.inversions(a(10_000, "hyper"), a(10_000, "hyperhypo")).count() == 0
    assert detecting.inversions(a(0, "hyper"), segments(spark, [])).count() == 0
    assert detecting.inversions(a(0, "hyper"), segments(spark, [(2, 3, "A", "hypob hypoa"), (1, 2, "A", "hypoz")])).first().second_word == "hypoz"


def test_unsaid_after_corrections(spark):
    segs = segments(spark, [(0, 1, "A", "Thanks for watching [music]"), (1, 2, "A", "Spring came")])
    assert [r.matched_text for r in detecting.unsaid(detecting.correct_segments(segs)).collect()] == ["Thanks for watching"]
    assert detecting.correct_segments(segs).where("text = 'Spiering came'").count() == 1


# ---- joins and islands ---------------------------------------------------------------


def test_range_joins_by_brute_force(spark):
    rng = random.Random(1)
    left = [(i % 3, i, s, s + rng.randint(0, 90)) for i, s in enumerate(rng.randint(-200, 900) for _ in range(80))]
    right = [(i % 3, i, s, s + rng.randint(0, 400)) for i, s in enumerate(rng.randint(-200, 900) for _ in range(60))]
    a = spark.createDataFrame(left, "k int, i int, l_start long, l_end long")
    b = spark.createDataFrame(right, "k int, j int, r_start long, r_end long")
    want = sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and min(x[3], y[3]) - max(x[2], y[2]) > 0)
    got = sorted((r.i, r.j) for r in rangejoin.interval_join(a, b, ["k"], width=50).collect())
    assert got == want
    near = sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and abs(x[2] - y[2]) <= 30)
    assert sorted((r.i, r.j) for r in rangejoin.band_join(a, b, ["k"], "l_start", "r_start", 30).collect()) == near


def test_range_join_has_no_nested_loop(spark):
    a = spark.range(10).selectExpr("id k", "id l_start", "id + 5 l_end")
    b = spark.range(10).selectExpr("id k", "id r_start", "id + 5 r_end")
    plan = rangejoin.interval_join(a, b, ["k"], width=3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_union_and_gaps(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 5, 7), (1, 9, 9), (1, 1, 2)], "k int, start_ms long, end_ms long")
    runs = islands.interval_union(df, ["k"])
    assert sorted((r.start_ms, r.end_ms) for r in runs.collect()) == [(0, 7), (9, 9)]
    span = spark.createDataFrame([(1, -2, 12), (2, 0, 3)], "k int, start_ms long, end_ms long")
    assert sorted((r.k, r.start_ms, r.end_ms) for r in islands.interval_gaps(span, runs, ["k"]).collect()) == [(1, -2, 0), (1, 7, 9), (1, 9, 12), (2, 0, 3)]


# ---- control -------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("rows", "best"),
    [
        ([(1, False, 0.99, 900.0, 0.2), (2, True, 0.9, 100.0, 0.9)], 2),  # a data centre before all
        ([(1, True, 0.9, 900.0, 0.2), (2, True, 0.99, 900.0, 0.9)], 2),  # then the floor
        ([(1, True, 0.9, 900.0, 0.2), (2, True, None, None, 0.1)], 2),  # none passes: the cheapest
        ([(1, True, 0.99, 900.0, None), (2, True, 0.99, 900.0, 5.0), (3, True, 0.99, 900.0, 5.0)], 2),
    ],
)
def test_offers(spark, rows, best):
    df = spark.createDataFrame([(i, n, dc, r, d, p) for n, (i, dc, r, d, p) in enumerate(rows)], schema.OFFERS)
    assert control.pick_offers(df).first().id == best
    assert control.pick_offers(df.withColumn("g", F.lit(1)), ["g"]).first().id == best
    with pytest.raises(PySparkException, match="no offers"):
        control.pick_offers(df.limit(0)).collect()


def test_missing_outputs(spark):
    bases = spark.createDataFrame([("a",)], "base string")
    assert control.expected_outputs(bases).count() == 18
    there = control.expected_outputs(bases).where("file <> 'a.canary.srt'")
    assert [r.file for r in control.missing_outputs(bases, there).collect()] == ["a.canary.srt"]


def test_segments_are_made_where_their_words_lie(spark, tmp_path):
    """Words are dealt by recording alone, never by window, bucket or word (F8 to F23)."""
    import re

    from chronoweave.plans import adapters, catalogue

    spark.range(60).selectExpr("id div 6 as conv_id", "id % 6 as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "repeat('a b ', 90) as text").write.parquet(str(tmp_path / "conversations.parquet"))
    inputs, name = catalogue._Inputs(spark, str(tmp_path)), "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        plan = speakers.build_segments(inputs.labelled())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert dealt and all(re.fullmatch(r"recording_id#\d+L(, turn_seq#\d+L)?", x) for x in dealt), dealt
    assert inputs.segments().count() > 0 and spark.conf.get(name) == before
    by_word = adapters.words(spark, str(tmp_path))
    assert sorted(map(tuple, adapters.turns(by_word).collect())) == sorted(map(tuple, inputs.turns.collect()))
    assert sorted(map(tuple, adapters.recordings(by_word).collect())) == sorted(map(tuple, inputs.recordings.collect()))


def test_union_of_equal_intervals(spark):
    """Equal rows stay with what follows them, not with the run before (F3: the SQL leaves their order open)."""
    rows = [(1, 30, 40), (1, 0, 10), (1, 30, 40), (1, 35, 50), (1, 0, 10), (1, 10, 12)]
    got = islands.interval_union(spark.createDataFrame(rows * 20, "k long, start_ms long, end_ms long").repartition(4), ["k"])
    assert sorted(map(tuple, got.collect())) == [(1, 0, 12), (1, 30, 50)]


def test_words_that_are_alike_or_without_times_keep_their_rows(spark):
    rows = [(1, "m", 0, "a", 0, 350), (1, "m", 0, "b", 0, 350), (1, "m", 1, "c", None, None)]
    said = spark.createDataFrame(rows, "recording_id long, model string, seq long, text string, start_ms long, end_ms long")
    spoken = spark.createDataFrame([(1, 0, 0, 30_000, "A"), (1, 1, 0, 10, "B"), (1, 2, 20, 30, "B")], schema.TURNS)
    got = speakers.assign_speakers(said, spoken).collect()
    assert sorted((r.text, r.speaker) for r in got) == [("a", "A"), ("b", "A"), ("c", "SPEAKER_UNKNOWN")]

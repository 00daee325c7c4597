"""Readers, writers and the stream watch."""

from __future__ import annotations

import io
import json
import tempfile
import wave

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chronoweave.functions import schema
from chronoweave.functions.fixed import Settings
from chronoweave.operators import control, coverage, merging, planning, speakers
from chronoweave.sources import readers, sinks
from chronoweave.streaming import watch


def wav(parts, rate=16000, channels=1):
    data = np.concatenate([np.sin(2 * np.pi * 440 * np.arange(int(s * rate)) / rate) * a for s, a in parts] or [np.zeros(0)])
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.repeat((data * 32767).astype("<i2")[:, None], channels, axis=1).tobytes())
    return out.getvalue()


def audio(spark, **files):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "recording string, content binary")


def test_frames_to_silences(spark, tmp_path):
    (tmp_path / "call.wav").write_bytes(wav([(1, 0.5), (0.5, 0.0), (1, 0.5), (0.1, 0.0), (0.5, 0.5), (0.4, 0.0)]))
    files = readers.files(spark, str(tmp_path / "*.wav"))
    frames = readers.frames(files).withColumnRenamed("recording", "recording_id")
    threshold = 10 ** (-45 / 20)
    got = planning.silences(frames, loud=F.col("rms") >= threshold, frame_ms=50, least_ms=200).collect()
    assert sorted((r.recording_id, r.start_ms, r.end_ms) for r in got) == [("call", 1000, 1500), ("call", 3100, 3500)]
    assert readers.durations(files).first().duration_ms == 3500


def test_audio_shapes(spark):
    both = audio(spark, stereo=wav([(1, 0.5)], channels=2), slow=wav([(1, 0.5)], rate=8000), none=wav([]))
    assert {r.recording: (r.duration_ms, r.rate, r.channels) for r in readers.durations(both).collect()} == {"stereo": (1000, 16000, 2), "slow": (1000, 8000, 1), "none": (0, 16000, 1)}
    with pytest.raises(PySparkException, match="sample rate 8000"):
        readers.frames(both.where("recording = 'slow'")).collect()
    assert readers.frames(both.where("recording = 'stereo'")).count() == 20
    with pytest.raises(PySparkException, match="not mono"):
        readers.checked_speech_audio(both.where("recording = 'stereo'")).collect()
    assert readers.durations(readers.resampled(both)).where("rate = 16000 and channels = 1 and duration_ms in (0, 1000)").count() == 3


def test_recogniser_end_to_end(spark):
    def load():
        def hear(batch):
            if any(w[1] == 5 for w in batch):
                raise ValueError("no memory")
            return [[(f"w{w[1]}", 1.0, 1.5), (" ", 2.0, 2.0)] for w in batch]

        return hear

    readers.register_recogniser("fake", load)
    grid = planning.window_grid(spark.createDataFrame([(1, 90_000)], schema.RECORDINGS), window=30_000, step=10_000).coalesce(1)
    heard = readers.recognise(grid, "fake", batch_size=2)
    assert heard.where("error like 'ValueError%'").count() == 2 - 0 if grid.count() % 2 == 0 else 1
    flat = merging.flatten_hypotheses(heard)
    assert flat.where("text = 'w0' and abs_start = 1.0").count() == 1 and flat.where("window_idx = 5").count() == 0
    readers.register_diariser("fake", lambda: lambda rec: [(0, 10, "SPEAKER_00")] if rec == 1 else [])
    assert readers.diarise(spark.createDataFrame([(1,), (2,)], "recording_id long"), "fake").count() == 1


def test_text_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"abs_start": 1.5, "abs_end": 2.0, "text": "é", "window_idx": 0, "window_center": 15.0}]))
    assert readers.checkpoint_words(spark, str(tmp_path / "a.json")).first().text == "é"
    (tmp_path / "p.log").write_text("# head\n1\t2\t3\t0.5\t0.5\t1.0\t7\nFAIL\t2\t3\tx\ty\n")
    assert sorted(r.failed for r in readers.progress_log(spark, str(tmp_path / "p.log")).collect()) == [False, True]
    got = readers.settings("# all\nwindow_seconds: 20  # short\nsilence_min_duration_ms: 300\nnum_speakers: null\nother: 3\n")
    assert got == Settings(window_seconds=20.0, silence_min_duration_ms=300)


def test_config(spark, tmp_path):
    text = """# head
window_seconds: 25   # note
models:
  - name: x
vocab_corrections:
  # people
  "Sp\\"ar": Pf au
  plain: "B's"
hallucination_patterns:
  - "(?i)amara\\\\.org"
  - 'it''s'
other: 1
"""
    (tmp_path / "c.yaml").write_text(text)
    got = readers.read_config(spark, str(tmp_path / "c.yaml"))
    assert got.settings.window_seconds == 25 and got.corrections == {'Sp"ar': "Pf au", "plain": "B's"}
    assert got.patterns == [r"(?i)amara\.org", "it's"]


def test_progress_log_and_batches(spark, tmp_path):
    from chronoweave.streaming import progress

    src, lines = str(tmp_path / "in"), []
    spark.createDataFrame([(1, "m", 0, "a")], "recording_id long, model string, seq long, text string").write.json(src)
    log = progress.ProgressLog(lines.append, total=2)
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema("recording_id long, model string, seq long, text string").json(src)
        query = progress.append_batches(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.processAllAvailable()
        query.stop()
        for _ in range(100):
            if any('"done"' in x for x in lines):
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    rows = [json.loads(x) for x in lines]
    assert any(r.get("chunks_done") == 1 and r["eta_sec"] is not None for r in rows)


def test_batches_add_a_file_a_task(spark, tmp_path):
    """However many keys come, and the rows are all there (F1)."""
    from chronoweave.streaming import progress

    src, out = str(tmp_path / "in"), tmp_path / "out"
    spark.range(300).selectExpr("id as recording_id", "'m' as model", "id as seq", "'a' as text").coalesce(1).write.json(src)
    stream = spark.readStream.schema("recording_id long, model string, seq long, text string").json(src)
    progress.append_batches(stream, str(out), str(tmp_path / "cp"), available=True).awaitTermination()
    got = spark.read.parquet(str(out))
    assert len(list(out.rglob("*.parquet"))) <= 4 and got.distinct().count() == 300 and dict(got.dtypes)["recording_id"] == "bigint"


def test_checkpoints_have_a_file_a_task(spark, tmp_path):
    """However many keys there are, and the rows are all there with their types (F4)."""
    words = spark.range(300).selectExpr("id % 100 as recording_id", "'m' as model", "id as seq", "'a' as text").repartition(3)
    sinks.write_checkpoint(words, str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "cp"))
    assert len(list((tmp_path / "cp").rglob("*.parquet"))) <= 3 and got.dtypes == words.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, words.collect()))


def test_packed_lines(spark, tmp_path):
    """Transcripts of many keys go to few files and come back whole: odd line ends, blank and null lines too (F5)."""
    rows = [(i, "m", n, f"{i} {n}\r\u2028 é" if n % 3 else None if n % 2 else "") for i in range(100) for n in range(i % 12, 0, -1)]
    lines = spark.createDataFrame(rows, "recording_id long, model string, place long, line string").repartition(3)
    sinks.write_packed(lines, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) <= 4
    got = readers.packed_lines(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, got.collect())) == sorted((i, m, line or "") for i, m, _, line in rows)
    whole = {r.recording_id: bytes(r.content).decode() for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert all(text == "".join((line or "") + "\n" for j, _, _, line in sorted(rows, key=lambda r: r[:3]) if j == i) for i, text in whole.items())
    with pytest.raises(PySparkException):
        sinks.write_packed(lines, str(tmp_path / "t"))


def test_transcripts_go_to_few_files(spark):
    """Not to a file for each of 400 keys (F5)."""
    assert files_of(spark, "transcript_files") <= 12


def test_word_checkpoints_go_to_few_files(spark):
    """Not to a file for each of 200 recordings (F6)."""
    assert files_of(spark, "checkpoint_words") <= 12


def test_packed_words(spark, tmp_path):
    """Negative identifiers too, which the folder's name hid; an array that breaks off is an error (F6)."""
    line = json.dumps([{"abs_start": 1.5, "abs_end": 2.0, "text": "é\n", "window_idx": 0, "window_center": 15.0}])
    pack = lambda name, line: sinks.write_packed(spark.createDataFrame([(-1, 0, line), (2, 0, "[]")], "recording_id long, place int, line string"), str(tmp_path / name), keys=["recording_id"])
    pack("w", line)
    assert [(r.recording_id, r.text, r.abs_start) for r in readers.packed_words(spark, str(tmp_path / "w")).collect()] == [(-1, "é\n", 1.5)]
    pack("broken", line[:-9])
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.packed_words(spark, str(tmp_path / "broken")).collect()


def test_audio_goes_to_few_files(spark):
    """Not to a file for each of 200 conversations (F7)."""
    assert files_of(spark, "audio_files") <= 12


def test_packed_files_are_read_as_those_of_a_folder(spark, tmp_path):
    lines = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), ("b", 0, None)], "k string, place int, line string")
    sinks.write_packed(lines, str(tmp_path / "p"), keys=["k"])
    sinks.write_lines(lines, str(tmp_path / "f"), keys=["k"])
    whole = lambda df: sorted(bytes(r.content) for r in df.collect())
    got = readers.packed(spark, str(tmp_path / "p"), "k")
    assert whole(got) == whole(readers.files(spark, str(tmp_path / "f/*/*"))) == [b"\n", b"y\nx\n"]
    assert sorted(r.recording for r in got.collect()) == ["a", "b"]


@pytest.mark.parametrize("zone", ["UTC", "Europe/London", "Asia/Kolkata"])
@pytest.mark.parametrize("name", ["event_hops", "late_hosts"])
def test_event_times_are_the_same_in_every_session_zone(spark, zone, name):
    """Over summer time, half hours and missing times (F2)."""
    import duckdb

    import __spark_entry__ as entry

    with tempfile.TemporaryDirectory() as d:
        duckdb.sql(f"""COPY (SELECT k AS event_id, CASE WHEN k % 50 <> 9 OR '{name}' = 'late_hosts' THEN TIMESTAMP '2024-01-01' + k * INTERVAL 97 MINUTE + INTERVAL 123456 MICROSECOND END AS ts,
            k % 5 AS user_id, 'view' AS event_type, 1.0::DOUBLE AS value, '' AS props FROM range(5000) t(k)) TO '{d}/events.parquet'""")
        con = duckdb.connect()
        con.sql(f"CREATE VIEW events AS SELECT * FROM '{d}/events.parquet'")
        want = con.sql(entry.oracle_sql()[name])
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = entry.queries()[name](spark, d).select(*want.columns).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


def files_of(spark, name):
    """Files in the fullest folder that the query made; 200 conversations of two turns."""
    import os

    import __spark_entry__ as entry
    from chronoweave.sources import staging

    before = staging.made(spark)
    with tempfile.TemporaryDirectory() as d:
        spark.range(400).selectExpr("id div 2 as conv_id", "id % 2 as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "'a b' as text").write.parquet(f"{d}/conversations.parquet")
        assert entry.queries()[name](spark, d).count() > 0
        made = [path for _, path in staging._made[spark.sparkContext.applicationId][before:]]
        return max(sum(f.startswith("part-") for _, _, fs in os.walk(path.removeprefix("file:")) for f in fs) for path in made)


def test_writers(spark, tmp_path):
    rows = [(1, "m", 0, 5_000, 6_000, "SPEAKER_01", " late "), (1, "m", 1, 1_000, 2_500, None, "early é"), (1, "m", 2, 3_000, 3_000, "A", "  ")]
    segs = spark.createDataFrame(rows, schema.SEGMENTS)
    assert [r.line for r in sinks.transcript_lines(segs).orderBy("place").collect()] == ["[00:00:01] Speaker ?: early é", "[00:00:05] Speaker 2: late"]
    assert [(r.cue, r.times) for r in sinks.subtitle_cues(segs).orderBy("cue").collect()] == [(1, "00:00:01,000 --> 00:00:02,500"), (2, "00:00:05,000 --> 00:00:06,000")]
    assert json.loads(sinks.jsonl_lines(segs).orderBy("place").first().line) == {"start": 1.0, "end": 2.5, "speaker": "Speaker ?", "text": "early é"}
    owners = spark.createDataFrame([(1, "m"), (2, "m")], "recording_id long, model string")
    docs = {r.recording_id: json.loads(r.json) for r in sinks.segments_json(owners, segs).collect()}
    assert [d["text"] for d in docs[1]] == ["early é", "", "late"] and docs[1][0]["speaker_raw"] is None and docs[2] == []
    older = {r.recording_id: json.loads(r.json) for r in sinks.segments_json(owners, segs, keep_empty=False).collect()}
    assert [d["text"] for d in older[1]] == ["late", "early é"]
    sinks.write_subtitles(segs, str(tmp_path / "srt"))
    text = "".join(p.read_text() for p in (tmp_path / "srt").rglob("*.txt"))
    assert text == "1\n00:00:01,000 --> 00:00:02,500\nSpeaker ?: early é\n\n2\n00:00:05,000 --> 00:00:06,000\nSpeaker 2: late\n\n"
    with pytest.raises(PySparkException):
        sinks.write_new(segs, str(tmp_path / "srt"))
    sinks.write_checkpoint(segs, str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "cp")).count() == 3


def test_audit_documents(spark):
    turns = spark.createDataFrame([(1, 0, 0, 10_000, "SPEAKER_00")], schema.TURNS)
    segs = spark.createDataFrame([(1, "m", 0, 0, 5_000, "SPEAKER_00", "x")], schema.SEGMENTS)
    keyed = spark.createDataFrame([(1, "m", 12_000)], "recording_id long, model string, duration_ms long")
    summary, gaps = coverage.audit(turns, segs, keyed)
    got = json.loads(sinks.coverage_json(keyed, turns, summary, gaps, metadata={"source": "t"}).first().json)
    assert got["duration_seconds"] == 12.0 and got["pyannote_speech_seconds"] == 10.0 and got["source"] == "t"
    assert got["models"]["m"]["coverage_pct"] == 50.0 and got["models"]["m"]["gaps"] == [{"start": 5.0, "end": 10.0, "duration": 5.0, "speaker": "SPEAKER_00"}]
    warned = coverage.warnings(summary, coverage.tail_gaps(keyed, segs))
    owners = keyed.select("recording_id", "model")
    assert json.loads(sinks.flags_json(owners, warned, order=["place"]).first().json)[0]["kind"] == "coverage_below_threshold"
    assert json.loads(sinks.flags_json(owners, warned.limit(0), order=["place"]).first().json) == []
    people = json.loads(sinks.speakers_json(owners, speakers.speaker_summary(segs, turns)).first().json)
    assert people[0]["diarized_seconds"] == 10.0
    assert json.loads(sinks.turns_json(keyed, turns).first().json)[0]["speaker"] == "SPEAKER_00"


RETRY = "pulling\nRetrying in 1 second"


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("loading", RETRY)] * 5, [(4, "stuck")]),
        ([("loading", RETRY)] * 4 + [("loading", "step")] + [("loading", RETRY)] * 4, []),
        ([("loading", RETRY)] * 3 + ["failed"] + [("loading", RETRY)] * 2, [(5, "stuck")]),
        ([("loading", RETRY)] * 3 + [(None, None)] + [("loading", RETRY)] * 2, []),
        ([(None, RETRY)] * 5, [(4, "stuck")]),
        ([("loading", "same")] * 9, []),
        ([("loading", "x"), ("offline", "x"), ("offline", "x")], [(1, "offline")]),
        ([("loading", f"retrying {i}") for i in range(9)], []),
    ],
)
def test_watch_rule(rows, want):
    state, got = ("", 0, False), []
    for i, row in enumerate(rows):
        status, msg = (None, None) if row == "failed" else row
        state, verdict = watch.step(state, {"actual_status": status, "status_msg": msg, "ssh_host": None, "ssh_port": None, "error": row if row == "failed" else None}, 4)
        if verdict:
            got.append((i, verdict))
    assert got == want


def test_watch_stream(spark, tmp_path):
    polls = [(1, i, "loading", RETRY, None, None, None) for i in range(5)] + [(2, 0, "running", None, "h", 22, None), (3, 0, "offline", None, None, None, None), (4, 0, "loading", "x", None, None, None)]
    src = str(tmp_path / "in")
    for half in (polls[:3], polls[3:]):
        spark.createDataFrame(half, schema.POLLS).coalesce(1).write.mode("append").json(src)
    query = (
        watch.watch(readers.polls(spark, src, stream=True)).writeStream.format("memory").queryName("verdicts").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    assert sorted((r.instance_id, r.verdict) for r in spark.sql("select * from verdicts").collect()) == [(1, "stuck"), (2, "ready"), (3, "offline")]


def test_watch_of_a_table_and_of_a_stream_agree(spark):
    """The table's verdicts against the stream's rule, poll by poll, on random polls."""
    import random

    rng = random.Random(6)
    polls = [
        (i, n, rng.choice([None, "loading", "loading", "loading", "running", "offline"][: rng.choice([4, 6])]), rng.choice([None, "", RETRY, RETRY, RETRY, "x"]), rng.choice([None, "", "h"]), rng.choice([None, 22]), rng.choice([None] * 5 + ["failed"]))
        for i in range(300) for n in range(rng.randint(1, 14))
    ]
    want = {}
    for i in range(300):
        state = ("", 0, False)
        for row in (p for p in polls if p[0] == i):
            state, verdict = watch.step(state, dict(zip(("i", "seq", "actual_status", "status_msg", "ssh_host", "ssh_port", "error"), row, strict=True)), 2)
            if verdict:
                want[i] = (row[1], verdict)
    got = control.verdicts(spark.createDataFrame(polls, schema.POLLS).repartition(4), repeats=2).collect()
    assert {r.instance_id: (r.seq, r.verdict) for r in got} == want
    assert set(v for _, v in want.values()) == {"offline", "ready", "stuck"}


def test_an_instance_that_keeps_answering_is_late(spark, tmp_path):
    import time

    src, end = str(tmp_path / "in"), time.time() + 60
    spark.createDataFrame([(1, 0, "loading", "step 0", None, None, None)], schema.POLLS).coalesce(1).write.mode("append").json(src)
    query = (
        watch.watch(readers.polls(spark, src, stream=True), deadline_ms=4000).writeStream.format("memory").queryName("late").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp"))
    )
    query, n = query.start(), 1
    try:
        while time.time() < end and not spark.sql("select * from late").count():
            spark.createDataFrame([(1, n, "loading", f"step {n}", None, None, None)], schema.POLLS).coalesce(1).write.mode("append").json(src)
            n += 1
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(r.instance_id, r.verdict) for r in spark.sql("select * from late").collect()] == [(1, "late")] and n > 2


def test_headers_wherever_they_lie(spark):
    plain = wav([(1, 0.5)])
    late = plain[:12] + b"LIST" + (100_000).to_bytes(4, "little") + bytes(100_000) + plain[12:]
    assert [r.duration_ms for r in readers.durations(audio(spark, late=late)).collect()] == [1000]
    with pytest.raises(PySparkException, match="no data chunk"):
        readers.durations(audio(spark, none=plain[:30])).collect()


def test_plans_that_reach_their_number_of_windows_are_told(spark):
    recs = spark.createDataFrame([(1, 100_000), (2, 5_000), (3, 0)], "recording_id long, duration_ms long")
    silent = spark.createDataFrame([], "recording_id long, start_ms long, end_ms long")
    plan = planning.window_plan(recs, silent, window=3000, overlap=2000, least_overlap=500, tolerance=300, most=10)
    assert plan.where("recording_id = 1").count() == 10
    assert [(r.recording_id, r.planned_ms) for r in planning.unplanned(recs, plan).collect()] == [(1, 12_000)]


def test_attempts(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 4, True)], "job string, attempt int, ok boolean")
    assert [tuple(r) for r in watch.first_good_attempt(df, retries=2).collect()] == [("a", 2)]

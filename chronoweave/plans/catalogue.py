"""The registered timeline queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed, scalar
from ..operators import control, coverage, detecting, islands, merging, planning, rangejoin, speakers
from ..sources.staging import stage
from . import adapters as ad
from . import timeline

KEYS = timeline.KEYS
#: The tables' recordings are short, so the tail guard is set to four seconds here.
TAIL_MS = 4000
#: Rules that occur in the tables' texts, in their order.
RULES = {"the": "THE", "en la": "$1", "que": "qu\\e", "der die": "x.y", "x": "z"}
SEEN = [r"(?i)und[ ,.]", r"(?i)la [a-z]", "tion", r"(?i)the[ ,.]"]
POLLS = {"overlap": 2000, "window": 3000, "least_overlap": 500, "tolerance": 300, "least_tail": 100}


class _Inputs:
    """The input tables of one query.

    The spans of turns are staged, a small table. Words are not: they are dealt by recording once, as
    text, and all that becomes of them up to the segments is made where they lie.
    """

    def __init__(self, spark: SparkSession, d: str):
        spans = stage(ad.spans(spark, d), "spans")
        self.words, self.emitted = ad.words(spark, d), ad.model_words(ad.heard(spark, d))
        self.turns, self.recordings = ad.turns(spans), spans.groupBy("recording_id").agg(F.max("duration_ms").alias("duration_ms"))

    def keyed(self) -> DataFrame:
        return ad.keyed(self.recordings)

    def merged(self) -> DataFrame:
        return merging.merge_overlaps(self.emitted, keys=KEYS)

    def labelled(self) -> DataFrame:
        return speakers.assign_speakers(self.merged(), self.turns, keys=KEYS)

    def segments(self) -> DataFrame:
        """Staged too: most queries read them more than once."""
        return stage(speakers.build_segments(self.labelled(), keys=KEYS), "segments", together=True)

    def tuned(self) -> timeline.Tuned:
        return timeline.tune(self.emitted, self.turns, self.keyed(), most_tail_ms=TAIL_MS)


def _quiet(spark: SparkSession, d: str) -> DataFrame:
    return planning.silences(ad.frames(spark, d), loud=F.col("amp") >= ad.LOUD, frame_ms=ad.FRAME_MS, least_ms=100)


def _spans(spark: SparkSession, d: str) -> DataFrame:
    return ad.frames(spark, d).groupBy("recording_id").agg((F.count("*") * ad.FRAME_MS).alias("duration_ms"))


def _marks(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).select("recording_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("duration_ms"), F.lit(1000).cast("long"))).alias("target_ms"))


def _mask(spark: SparkSession, d: str) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("duration_ms") / 500).cast("long")))
    segs = _spans(spark, d).select("recording_id", k.alias("k")).select("recording_id", (F.col("k") * 500).alias("start_ms"), (F.col("k") * 500 + 240).alias("end_ms"))
    return coverage.frame_cover(ad.frames(spark, d), segs, frame_ms=ad.FRAME_MS, speech=F.col("amp") >= ad.LOUD)


def adapter_words(spark, d):
    return ad.words(spark, d)


def adapter_turns(spark, d):
    return ad.turns(ad.words(spark, d))


def window_grid(spark, d):
    return planning.window_grid(ad.recordings(ad.words(spark, d)), window=ad.WINDOW, step=ad.STEP, least_tail=0)


def window_plan_snapped(spark, d):
    return planning.window_plan(_spans(spark, d), _quiet(spark, d), **POLLS)


def window_batches(spark, d):
    held = planning.in_batches(window_grid(spark, d), 16)
    return held.groupBy("recording_id", "batch_idx").agg(F.count("*").alias("windows"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


def silence_islands(spark, d):
    return _quiet(spark, d)


def nearest_silence_snap(spark, d):
    mids = _quiet(spark, d).select("recording_id", F.floor((F.col("start_ms") + F.col("end_ms")) / 2).cast("long").alias("mid"))
    found = rangejoin.nearest(_marks(spark, d), mids, ["recording_id"], ["target_ms"], "target_ms", "mid", 300)
    out = _marks(spark, d).join(found, ["recording_id", "target_ms"], "left")
    return out.select("recording_id", "target_ms", F.coalesce("mid", "target_ms").alias("snapped_ms"))


def overlap_merge(spark, d):
    return stage(_Inputs(spark, d).merged().select(*KEYS, "seq", "text", "start_ms", "window_idx"), "merged", together=True)


def overlap_drop_counts(spark, d):
    inputs = _Inputs(spark, d)
    before = inputs.emitted.groupBy(*KEYS).agg(F.count("*").alias("emitted"))
    after = stage(inputs.merged().groupBy(*KEYS).agg(F.count("*").alias("kept")), "kept", together=True)
    return before.join(after, KEYS).withColumn("dropped", F.col("emitted") - F.col("kept"))


def merge_with_failed_window(spark, d):
    """Every word is there; those of windows that failed come as one empty hypothesis each, which gives no word."""
    emitted = _Inputs(spark, d).emitted
    failed = (F.col("window_idx") % 4 == 2) & (F.col("model") == "canary")
    heard = emitted.withColumn("text", F.when(failed, "").otherwise(F.col("text"))).where("text <> ''")
    return stage(merging.merge_overlaps(heard, keys=KEYS).select(*KEYS, "seq", "window_idx"), "merged", together=True)


def speaker_assign(spark, d):
    return stage(_Inputs(spark, d).labelled().select(*KEYS, "seq", "speaker"), "labelled", together=True)


def speaker_assign_ties(spark, d):
    """Words between two equally long, equally near turns: the earlier turn's speaker has them."""
    words = _Inputs(spark, d).words.select("recording_id", F.lit("m").alias("model"), "seq", "text", (5 * F.col("start_ms")).alias("start_ms"), (5 * F.col("end_ms")).alias("end_ms"))
    mid = F.floor((F.col("start_ms") + F.col("end_ms")) / 2).cast("long")
    name = F.when(F.col("seq") % 2 == 0, "Z").otherwise("Y")
    both = F.explode(F.array(F.struct((mid - 300).alias("a"), mid.alias("b"), name.alias("s"), (F.col("seq") * 2).alias("t")), F.struct(mid.alias("a"), (mid + 300).alias("b"), F.lit("A").alias("s"), (F.col("seq") * 2 + 1).alias("t"))))
    near = words.select("recording_id", both.alias("x")).select("recording_id", F.col("x.t").alias("turn_seq"), F.col("x.a").alias("start_ms"), F.col("x.b").alias("end_ms"), F.col("x.s").alias("speaker"))
    return speakers.assign_speakers(words, near, keys=KEYS).select("recording_id", "seq", "speaker")


def speaker_unknown(spark, d):
    """Turns are there in their first two seconds only, so words after that have no speaker."""
    inputs = _Inputs(spark, d)
    short = inputs.turns.withColumn("end_ms", F.least("end_ms", F.col("start_ms") + 2000))
    named = speakers.assign_speakers(inputs.merged(), short, keys=KEYS)
    return stage(named.groupBy(*KEYS).agg(F.count("*").alias("words"), F.count_if(F.col("speaker") == fixed.UNKNOWN_SPEAKER).alias("unknown")), "named", together=True)


def build_segments(spark, d):
    return _Inputs(spark, d).segments()


def segment_sort(spark, d):
    w = Window.partitionBy(*KEYS).orderBy("start_ms", "end_ms", "seg_seq")
    return build_segments(spark, d).select(*KEYS, F.row_number().over(w).alias("place"), scalar.clock("start_ms").alias("clock"), "speaker", F.length("text").alias("chars"))


def srt_cues(spark, d):
    from ..sources import sinks

    return sinks.subtitle_cues(build_segments(spark, d), keys=KEYS).select(*KEYS, "cue", "times", "line")


def speaker_label_map(spark, d):
    ids = ad.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.expr(
        "case s_suppkey % 7 when 0 then null when 1 then '' when 2 then 'SPEAKER_UNKNOWN' when 3 then concat('SPEAKER_', lpad(cast(s_suppkey as string), 2, '0'))"
        " when 4 then concat('A_0', cast(s_suppkey as string), '_x') when 5 then 'WEIRD' else 'SPEAKER_x' end").alias("speaker_raw"))  # fmt: skip
    return ids.withColumn("speaker", scalar.speaker_label("speaker_raw"))


def text_normalize(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", F.md5(scalar.letters_and_digits("text")).alias("normal_md5"))


def word_counts(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", scalar.word_count("text").alias("words"), F.length(scalar.strip("text")).alias("stripped_chars"))


def vocab_corrections(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", F.md5(scalar.correct("text", RULES)).alias("corrected_md5"))


def pattern_first_match(spark, d):
    found = ad.table(spark, d, "documents").select("doc_id", scalar.first_match("text", SEEN).alias("m")).where("m is not null")
    return found.select("doc_id", "m.pattern", F.col("m.matched").alias("matched_text"))


def unsaid_segments(spark, d):
    """Conversations with planted phrases that no one said."""
    said = ad.table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.col("text"), F.expr("case turn % 4 when 1 then ' Thank you for Watching' when 2 then ' [MUSIC] please subscribe' else '' end")).alias("text"))
    found = said.withColumn("m", scalar.first_match("text", fixed.PATTERNS)).where("m is not null")
    return found.select("conv_id", "turn", "m.pattern", F.col("m.matched").alias("matched_text"))


def semantic_inversions(spark, d):
    segs = _Inputs(spark, d).segments()
    return detecting.inversions(segs.where("model = 'parakeet'"), segs.where("model = 'canary'"))


def tail_gap(spark, d):
    inputs = _Inputs(spark, d)
    return coverage.tail_gaps(inputs.keyed(), inputs.segments(), most_ms=TAIL_MS)


def coverage_summary(spark, d):
    inputs = _Inputs(spark, d)
    return coverage.audit(inputs.turns, inputs.segments(), inputs.keyed())[0]


def coverage_gaps(spark, d):
    inputs = _Inputs(spark, d)
    parts = speakers.build_segments(inputs.merged().withColumn("speaker", F.lit("x")), keys=KEYS, max_gap_ms=1000)
    return coverage.audit(inputs.turns, stage(parts, "parts", together=True), inputs.keyed())[1]


def interval_union(spark, d):
    spans = ad.table(spark, d, "lineitem").select("l_partkey", F.expr("unix_date(cast(l_shipdate as date))").cast("long").alias("start_ms"))
    spans = spans.withColumn("end_ms", F.col("start_ms") + F.col("l_partkey") % 40)
    return islands.interval_union(spans, ["l_partkey"])


def mask_coverage(spark, d):
    return coverage.frame_summary(_mask(spark, d), frame_ms=ad.FRAME_MS)


def mask_gaps(spark, d):
    return coverage.frame_gaps(_mask(spark, d), frame_ms=ad.FRAME_MS, least_ms=100)


def speaker_summary(spark, d):
    inputs = _Inputs(spark, d)
    return speakers.speaker_summary(inputs.segments(), inputs.turns, keys=KEYS)


def speaker_share(spark, d):
    return speakers.speaker_shares(ad.turns(ad.words(spark, d)))


def segment_distribution(spark, d):
    return speakers.segment_distribution(build_segments(spark, d), keys=KEYS)


def warnings(spark, d):
    return _Inputs(spark, d).tuned().warnings


def offer_pick(spark, d):
    return control.pick_offers(ad.offers(spark, d), ["region_id"]).select("region_id", "id", "is_dc", "dph_total")


def stuck_runs(spark, d):
    return control.runs_of(ad.polls(spark, d), "actual_status").where("polls >= 3")


def stuck_hosts(spark, d):
    return control.stuck(ad.polls(spark, d), repeats=2)


def status_changes(spark, d):
    return control.changes(ad.polls(spark, d), "actual_status", keys=["instance_id"], order=["seq"]).select("instance_id", "seq", "actual_status")


def artifact_manifest(spark, d):
    bases = ad.recordings(ad.words(spark, d)).select(F.concat(F.lit("rec"), F.col("recording_id").cast("string")).alias("base"))
    there = control.expected_outputs(bases).where(F.length("file") % 3 != 0)
    return control.missing_outputs(bases, there)


def eta_progress(spark, d):
    held = planning.in_batches(window_grid(spark, d), 4)
    w = Window.partitionBy("recording_id").orderBy("batch_idx")
    per = held.groupBy("recording_id", "batch_idx").agg(F.count("*").alias("n"))
    done = per.withColumn("done", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy("recording_id")))
    return done.select("recording_id", "batch_idx", "done", "total", scalar.eta((F.col("batch_idx") + 1) * F.lit(2.0), F.col("done"), F.col("total")).alias("eta_sec"))


def last_log_rows(spark, d):
    kept = control.latest(ad.polls(spark, d), 3, keys=["instance_id"], order=[F.col("seq").desc()])
    return kept.select("instance_id", "seq", "actual_status", "place")


def tune_pipeline(spark, d):
    return timeline.report(_Inputs(spark, d).tuned())


_NAMES = """adapter_words adapter_turns window_grid window_plan_snapped window_batches silence_islands nearest_silence_snap
overlap_merge overlap_drop_counts merge_with_failed_window speaker_assign speaker_assign_ties speaker_unknown build_segments
segment_sort srt_cues speaker_label_map text_normalize word_counts vocab_corrections pattern_first_match unsaid_segments
semantic_inversions tail_gap coverage_summary coverage_gaps interval_union mask_coverage mask_gaps speaker_summary
speaker_share segment_distribution warnings offer_pick stuck_runs stuck_hosts status_changes artifact_manifest eta_progress
last_log_rows tune_pipeline""".split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: globals()[n] for n in _NAMES}


_COUNT = r"len(list_filter(string_split_regex({}, '\s+'), lambda x: x <> ''))"
_CLOCK = "printf('%02d:%02d:%02d', {0} // 3600000, {0} // 60000 % 60, {0} // 1000 % 60)"
_LABEL = "CASE WHEN {0} IS NULL OR {0} = '' OR {0} = 'SPEAKER_UNKNOWN' THEN 'Speaker ?' WHEN try_cast(split_part({0}, '_', 2) AS INTEGER) IS NOT NULL THEN 'Speaker ' || (try_cast(split_part({0}, '_', 2) AS INTEGER) + 1) ELSE {0} END"
_MASK = """, cover AS (SELECT DISTINCT recording_id, f AS frame_idx FROM spans, unnest(range(0, duration_ms // 500 + 1)) AS t(k), unnest(range(k * 10, (k * 500 + 240) // 50 + 1)) AS u(f)),
mask AS (SELECT f.recording_id, f.frame_idx, f.amp >= 2000 AS speech, c.frame_idx IS NOT NULL AS covered FROM frames f LEFT JOIN cover c ON f.recording_id = c.recording_id AND f.frame_idx = c.frame_idx)
"""

SQL: dict[str, str] = {
    "adapter_words": ad.sql("SELECT * FROM words", "words"),
    "adapter_turns": ad.sql("SELECT * FROM turns", "turns"),
    "window_grid": ad.sql("SELECT * FROM windows", "windows"),
    "window_batches": ad.sql("SELECT recording_id, CAST(window_idx // 16 AS INTEGER) AS batch_idx, count(*) AS windows, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM windows GROUP BY ALL", "windows"),
    "silence_islands": ad.sql("SELECT * FROM quiet", "quiet"),
    "nearest_silence_snap": ad.sql(
        """SELECT recording_id, target_ms, coalesce((SELECT mid FROM mids m WHERE m.recording_id = t.recording_id AND abs(mid - target_ms) <= 300 ORDER BY abs(mid - target_ms), mid LIMIT 1), target_ms) AS snapped_ms
        FROM (SELECT recording_id, k AS target_ms FROM spans, unnest(range(0, duration_ms + 1, 1000)) AS u(k)) t""", "mids", "spans"),
    "overlap_merge": ad.sql("SELECT recording_id, model, seq, text, start_ms, window_idx FROM merged", "merged"),
    "overlap_drop_counts": ad.sql("""SELECT e.*, m.kept, e.emitted - m.kept AS dropped FROM (SELECT recording_id, model, count(*) AS emitted FROM emitted GROUP BY ALL) e
        JOIN (SELECT recording_id, model, count(*) AS kept FROM merged GROUP BY ALL) m USING (recording_id, model)""", "emitted", "merged"),
    "merge_with_failed_window": ad.sql("""SELECT recording_id, model, seq, window_idx FROM (
        SELECT e.*, low4, high4 FROM emitted e JOIN (SELECT *, lag(c2) OVER o + c2 AS low4, c2 + lead(c2) OVER o AS high4 FROM centres
        WHERE NOT (model = 'canary' AND window_idx % 4 = 2) WINDOW o AS (PARTITION BY model, recording_id ORDER BY c2, first_seq)) USING (model, recording_id, window_idx))
        WHERE (low4 IS NULL OR low4 <= 4 * start_ms) AND (high4 IS NULL OR 4 * start_ms < high4)""", "emitted", "centres"),
    "speaker_assign": ad.sql("SELECT recording_id, model, seq, speaker FROM labelled", "labelled"),
    "speaker_assign_ties": ad.sql("""SELECT recording_id, seq, speaker FROM (
        SELECT *, row_number() OVER (PARTITION BY recording_id, seq ORDER BY held DESC, rank) AS place FROM (
        SELECT w.recording_id, w.seq, t.speaker, min(t.rank) AS rank, sum(least(w.start_ms + w.end_ms + 2000, 2 * t.b) - greatest(w.start_ms + w.end_ms - 2000, 2 * t.a)) AS held
        FROM slow w JOIN (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY a, t) AS rank FROM (
            SELECT recording_id, (start_ms + end_ms) // 2 - 300 AS a, (start_ms + end_ms) // 2 AS b, CASE seq % 2 WHEN 0 THEN 'Z' ELSE 'Y' END AS speaker, seq * 2 AS t FROM slow
            UNION ALL SELECT recording_id, (start_ms + end_ms) // 2, (start_ms + end_ms) // 2 + 300, 'A', seq * 2 + 1 FROM slow)) t
        ON w.recording_id = t.recording_id AND 2 * t.a < w.start_ms + w.end_ms + 2000 AND 2 * t.b > w.start_ms + w.end_ms - 2000
        GROUP BY w.recording_id, w.seq, t.speaker)) WHERE place = 1""", "words").replace("\nSELECT recording_id, seq, speaker FROM", ",\nslow AS (SELECT recording_id, seq, 5 * start_ms AS start_ms, 5 * end_ms AS end_ms FROM words)\nSELECT recording_id, seq, speaker FROM", 1),
    "speaker_unknown": ad.sql("""SELECT recording_id, model, count(*) AS words, count(*) FILTER (WHERE NOT known) AS unknown FROM (
        SELECT m.*, EXISTS (SELECT 1 FROM turns t WHERE t.recording_id = m.recording_id
        AND 2 * t.start_ms < m.start_ms + m.end_ms + 2000 AND 2 * least(t.end_ms, t.start_ms + 2000) > m.start_ms + m.end_ms - 2000) AS known FROM merged m) GROUP BY ALL""", "merged", "turns"),
    "build_segments": ad.sql("SELECT * FROM segments", "segments"),
    "segment_sort": ad.sql(f"SELECT recording_id, model, row_number() OVER (PARTITION BY recording_id, model ORDER BY start_ms, end_ms, seg_seq) AS place, {_CLOCK.format('start_ms')} AS clock, speaker, length(text) AS chars FROM segments", "segments"),
    "srt_cues": ad.sql(f"""SELECT recording_id, model, row_number() OVER (PARTITION BY recording_id, model ORDER BY start_ms, end_ms, seg_seq) AS cue,
        {_CLOCK.format('start_ms')} || ',' || lpad((start_ms % 1000)::VARCHAR, 3, '0') || ' --> ' || {_CLOCK.format('end_ms')} || ',' || lpad((end_ms % 1000)::VARCHAR, 3, '0') AS times,
        {_LABEL.format('speaker')} || ': ' || text AS line FROM segments WHERE text <> ''""", "segments"),
    "speaker_label_map": f"""WITH ids AS (SELECT s_suppkey AS id, CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'SPEAKER_UNKNOWN'
        WHEN 3 THEN 'SPEAKER_' || (CASE WHEN s_suppkey < 10 THEN '0' || s_suppkey ELSE left(s_suppkey::VARCHAR, 2) END) WHEN 4 THEN 'A_0' || s_suppkey || '_x' WHEN 5 THEN 'WEIRD' ELSE 'SPEAKER_x' END AS speaker_raw FROM supplier)
        SELECT id, speaker_raw, {_LABEL.format('speaker_raw')} AS speaker FROM ids""",
    "text_normalize": "SELECT doc_id, md5(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')) AS normal_md5 FROM documents",
    "word_counts": f"SELECT doc_id, {_COUNT.format('text')} AS words, length(trim(text, ' \n\t\r')) AS stripped_chars FROM documents",
    "pattern_first_match": r"""SELECT doc_id, pattern, regexp_extract(text, pattern) AS matched_text FROM (
        SELECT doc_id, text, CASE WHEN regexp_matches(text, '(?i)und[ ,.]') THEN '(?i)und[ ,.]' WHEN regexp_matches(text, '(?i)la [a-z]') THEN '(?i)la [a-z]'
        WHEN contains(text, 'tion') THEN 'tion' WHEN regexp_matches(text, '(?i)the[ ,.]') THEN '(?i)the[ ,.]' END AS pattern FROM documents) WHERE pattern IS NOT NULL""",
    "unsaid_segments": """SELECT conv_id, turn, CASE turn % 4 WHEN 1 THEN '(?i)thank you for watching' ELSE '(?i)\\[music\\]' END AS pattern,
        CASE turn % 4 WHEN 1 THEN 'Thank you for Watching' ELSE '[MUSIC]' END AS matched_text FROM conversations WHERE turn % 4 IN (1, 2)""".replace("\\\\", "\\"),
    "tail_gap": ad.sql("SELECT * FROM tails", "tails"),
    "coverage_summary": ad.sql("SELECT * FROM summary", "summary"),
    "interval_union": """SELECT l_partkey, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY l_partkey ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS run FROM (
        SELECT *, CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY l_partkey ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM (
        SELECT l_partkey, datediff('day', DATE '1970-01-01', l_shipdate::DATE) AS start_ms, datediff('day', DATE '1970-01-01', l_shipdate::DATE) + l_partkey % 40 AS end_ms FROM lineitem)))
        GROUP BY l_partkey, run""",
    "mask_coverage": ad.sql("""SELECT recording_id, count(*) * 50 AS total_ms, count(*) FILTER (WHERE speech) * 50 AS speech_ms, count(*) FILTER (WHERE speech AND covered) * 50 AS covered_ms,
        CASE WHEN count(*) FILTER (WHERE speech) = 0 THEN 100.0::DOUBLE ELSE (count(*) FILTER (WHERE speech AND covered))::DOUBLE * 100.0::DOUBLE / (count(*) FILTER (WHERE speech))::DOUBLE END AS coverage_pct FROM mask GROUP BY recording_id""", "frames", "spans"),
    "mask_gaps": ad.sql("""SELECT recording_id, min(frame_idx) * 50 AS start_ms, (max(frame_idx) + 1) * 50 AS end_ms, count(*) * 50 AS duration_ms FROM (
        SELECT *, frame_idx - row_number() OVER (PARTITION BY recording_id ORDER BY frame_idx) AS grp FROM mask WHERE speech AND NOT covered)
        GROUP BY recording_id, grp HAVING count(*) >= 2""", "frames", "spans"),
    "speaker_summary": ad.sql(f"""SELECT k.recording_id, k.model, k.speaker AS speaker_raw, {_LABEL.format('k.speaker')} AS speaker, CAST(coalesce(t.ms, 0) AS BIGINT) AS diarized_ms,
        CAST(coalesce(s.words, 0) AS BIGINT) AS transcript_word_count, coalesce(s.first, '') AS first_sample_text FROM (
        SELECT d.recording_id, d.model, t.speaker FROM (SELECT DISTINCT recording_id, model FROM segments) d JOIN turns t USING (recording_id) UNION SELECT recording_id, model, speaker FROM segments) k
        LEFT JOIN (SELECT recording_id, speaker, sum(end_ms - start_ms) AS ms FROM turns GROUP BY ALL) t USING (recording_id, speaker)
        LEFT JOIN (SELECT recording_id, model, speaker, sum({_COUNT.format('text')}) AS words, left(arg_min(text, start_ms), 400) AS first FROM segments GROUP BY ALL) s USING (recording_id, model, speaker)""", "segments", "turns"),
    "speaker_share": ad.sql("""SELECT *, CASE WHEN sum(speech_ms) OVER p = 0 THEN 0.0 ELSE speech_ms::DOUBLE * 100.0::DOUBLE / (sum(speech_ms) OVER p)::DOUBLE END AS share_pct FROM (
        SELECT recording_id, speaker, CAST(sum(end_ms - start_ms) AS BIGINT) AS speech_ms FROM turns GROUP BY ALL) WINDOW p AS (PARTITION BY recording_id)""", "turns"),
    "segment_distribution": ad.sql(f"SELECT recording_id, model, speaker, count(*) AS segments, CAST(sum({_COUNT.format('text')}) AS BIGINT) AS words, CAST(sum(end_ms - start_ms) AS BIGINT) AS span_ms FROM segments GROUP BY ALL", "segments"),
    "warnings": ad.sql("""SELECT recording_id, model, 0 AS place, 'high' AS severity, 'coverage_below_threshold' AS kind, coverage_pct, 95.0::DOUBLE AS threshold_pct,
        NULL::BIGINT AS duration_ms, NULL::BIGINT AS last_end_ms, NULL::BIGINT AS trailing_gap_ms FROM summary WHERE coverage_pct < 95.0
        UNION ALL SELECT recording_id, model, 1, 'critical', 'trailing_gap', NULL, NULL, duration_ms, duration_ms - gap_ms, gap_ms FROM tails WHERE NOT ok""", "summary", "tails"),
    "offer_pick": """SELECT s_nationkey AS region_id, id, is_dc, dph_total FROM (
        SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY is_dc DESC, passes DESC, coalesce(dph_total, 999), id) AS place FROM (
        SELECT s_nationkey, s_suppkey AS id, s_suppkey % 3 = 0 AS is_dc, CASE WHEN s_suppkey % 11 <> 0 THEN s_acctbal END AS dph_total,
        coalesce(CASE WHEN s_suppkey % 7 <> 0 THEN (970 + 5 * (s_suppkey % 5))::DOUBLE / 1000.0::DOUBLE END, 0) >= 0.985::DOUBLE AND (s_suppkey * 37) % 1600 >= 800 AS passes FROM supplier)) WHERE place = 1""",
    "stuck_runs": ad.sql("""SELECT instance_id, run, min(actual_status) AS actual_status, min(seq) AS first_seq, count(*) AS polls FROM (
        SELECT *, CAST(sum(c) OVER (PARTITION BY instance_id ORDER BY seq) AS BIGINT) AS run FROM (
        SELECT *, CASE WHEN seq = 1 OR lag(actual_status) OVER (PARTITION BY instance_id ORDER BY seq) IS NOT DISTINCT FROM actual_status THEN 0 ELSE 1 END AS c FROM polls))
        GROUP BY instance_id, run HAVING count(*) >= 3""", "polls"),
    "stuck_hosts": ad.sql("""SELECT instance_id, min(seq) AS seq, min(msg) AS msg FROM (SELECT *, lag(msg, 1) OVER o AS m1, lag(msg, 2) OVER o AS m2 FROM polls WINDOW o AS (PARTITION BY instance_id ORDER BY seq))
        WHERE contains(msg, 'retrying') AND msg = m1 AND msg = m2 GROUP BY instance_id""", "polls"),
    "status_changes": ad.sql("SELECT instance_id, seq, actual_status FROM (SELECT *, lag(actual_status) OVER (PARTITION BY instance_id ORDER BY seq) AS p FROM polls) WHERE seq = 1 OR p IS DISTINCT FROM actual_status", "polls"),
    "artifact_manifest": ad.sql("""SELECT base, base || suffix AS file FROM (SELECT 'rec' || recording_id AS base FROM recs), (
        SELECT unnest(['.diarization.json', '.coverage.json', '.warnings.json', '.semantic_inversions.json']) AS suffix
        UNION ALL SELECT '.' || m || s FROM (SELECT unnest(['canary', 'parakeet']) AS m), (SELECT unnest(['.transcript.txt', '.srt', '.segments.json', '.hallucinations.json', '.final.txt', '.final.jsonl', '.speakers.json']) AS s))
        WHERE length(base || suffix) % 3 = 0""", "recs"),
    "eta_progress": ad.sql("""SELECT recording_id, batch_idx, CAST(done AS BIGINT) AS done, CAST(total AS BIGINT) AS total, ((batch_idx + 1) * 2.0::DOUBLE) / done::DOUBLE * (total - done)::DOUBLE AS eta_sec FROM (
        SELECT *, sum(n) OVER (PARTITION BY recording_id ORDER BY batch_idx) AS done, sum(n) OVER (PARTITION BY recording_id) AS total FROM (
        SELECT recording_id, CAST(window_idx // 4 AS INTEGER) AS batch_idx, count(*) AS n FROM windows GROUP BY ALL))""", "windows"),
    "last_log_rows": ad.sql("SELECT instance_id, seq, actual_status, place FROM (SELECT *, row_number() OVER (PARTITION BY instance_id ORDER BY seq DESC) AS place FROM polls) WHERE place <= 3", "polls"),
    "tune_pipeline": ad.sql("""SELECT s.recording_id, s.model, coalesce(n.segments, 0) AS segments, s.speech_ms, s.covered_ms, s.coverage_pct, coalesce(g.gaps, 0) AS gaps, t.gap_ms, t.ok,
        CASE WHEN s.coverage_pct < 95.0 THEN 1 ELSE 0 END + CASE WHEN t.ok THEN 0 ELSE 1 END AS warnings
        FROM summary s JOIN tails t USING (model, recording_id) LEFT JOIN (SELECT model, recording_id, count(*) AS segments FROM segments GROUP BY ALL) n USING (model, recording_id)
        LEFT JOIN (SELECT model, recording_id, count(*) AS gaps FROM gaps GROUP BY ALL) g USING (model, recording_id)""", "summary", "tails", "segments", "gaps"),
}

for _n in ("mask_coverage", "mask_gaps"):
    _head, _, _body = SQL[_n].rpartition("\nSELECT recording_id,")
    SQL[_n] = _head + _MASK + "SELECT recording_id," + _body

_SNAP = "coalesce((SELECT mid FROM mids m WHERE m.recording_id = {r} AND abs(mid - {t}) <= 300 ORDER BY abs(mid - {t}), mid LIMIT 1), {t})"
SQL["window_plan_snapped"] = ad.sql("", "mids", "spans").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
plan AS (
  SELECT recording_id, duration_ms, 0 AS window_idx, 0::BIGINT AS start_ms, CASE WHEN 3000 >= duration_ms THEN duration_ms ELSE {_SNAP.format(r='spans.recording_id', t='3000')} END AS end_ms FROM spans
  UNION ALL
  SELECT recording_id, duration_ms, window_idx + 1, pos, CASE WHEN pos + 3000 >= duration_ms THEN duration_ms ELSE {_SNAP.format(r='q.recording_id', t='(pos + 3000)')} END FROM (
    SELECT recording_id, duration_ms, window_idx, CASE WHEN nxt <= start_ms THEN start_ms + 500 ELSE nxt END AS pos FROM (
      SELECT p.*, least({_SNAP.format(r='p.recording_id', t='(p.end_ms - 2000)')}, p.end_ms - 500) AS nxt FROM plan p WHERE p.end_ms < p.duration_ms)) q
  WHERE pos < duration_ms AND window_idx < 9999)
SELECT recording_id, window_idx, start_ms, end_ms FROM plan p WHERE end_ms - start_ms >= 100
   OR EXISTS (SELECT 1 FROM plan q WHERE q.recording_id = p.recording_id AND q.window_idx > p.window_idx AND q.end_ms - q.start_ms >= 100)"""

SQL["semantic_inversions"] = ad.sql(f"""SELECT recording_id, seg_seq, pos, time_ms, {_LABEL.format('speaker')} AS speaker, prefix, first_word, second_word FROM (
    SELECT *, row_number() OVER (PARTITION BY recording_id, seg_seq, pos, prefix ORDER BY b_at, second_word) AS place FROM (
    SELECT a.recording_id, a.seg_seq, a.pos, a.time_ms, a.speaker, p.prefix, a.word AS first_word, b.b_at, b.word AS second_word FROM (
      SELECT recording_id, seg_seq, start_ms AS time_ms, speaker, i - 1 AS pos, ws[i] AS word FROM (SELECT *, list_filter(string_split(text, ' '), lambda x: x <> '') AS ws FROM segments WHERE model = 'parakeet'), unnest(range(1, len(ws) + 1)) AS t(i)) a
    JOIN (SELECT 'hyper' AS prefix, 'hypo' AS opposite UNION ALL SELECT 'hypo', 'hyper') p ON contains(lower(a.word), p.prefix)
    JOIN (SELECT recording_id, start_ms AS b_at, unnest(list_filter(string_split(lower(text), ' '), lambda x: x <> '')) AS word FROM segments WHERE model = 'canary') b
      ON a.recording_id = b.recording_id AND abs(a.time_ms - b.b_at) <= 3000 AND contains(b.word, p.opposite) AND NOT contains(b.word, p.prefix))) WHERE place = 1""", "segments")

SQL["coverage_gaps"] = ad.sql("SELECT model, recording_id, turn_seq, start_ms, end_ms, duration_ms, speaker FROM gaps", "gaps").replace(
    ad.CTES["flagged"], """SELECT *, CASE WHEN row_number() OVER o = 1 OR start_ms - lag(end_ms) OVER o <= 1000 THEN 0 ELSE 1 END AS changed
        FROM labelled WINDOW o AS (PARTITION BY model, recording_id ORDER BY start_ms, seq)""")  # fmt: skip



def _edged(text: str) -> str:
    """Every character outside words between two marks, so that neighbouring words share none."""
    return "".join(c if c.isalnum() or c == "_" else f"\x01{c}\x01" for c in text)


_done = "regexp_replace(text, '([^\\pL\\pN_])', '\x01\\1\x01', 'g')"
for _heard, _meant in RULES.items():
    _done = rf"regexp_replace({_done}, '(?i)(^|{chr(1)}){_edged(_heard)}($|{chr(1)})', '\1{_edged(_meant).replace(chr(92), chr(92) * 2)}\2', 'g')"
SQL["vocab_corrections"] = f"SELECT doc_id, md5(replace({_done}, '\x01', '')) AS corrected_md5 FROM documents"

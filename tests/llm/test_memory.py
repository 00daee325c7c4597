"""What a worker holds at once is bounded in bytes, however long the rows are; staged texts are small."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline
from chronoweave.llm import substring_dedup
from chronoweave.llm.common import BATCH_BYTES
from chronoweave.llm.passages import with_windows


def test_blocks_come_in_bounded_batches(spark):
    """48 blocks of a megabyte that does not compress: no task gets all of its own at once."""
    rng = random.Random(1)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    word = lambda: "".join(map(chr, rng.choices(range(0x100, 0x800), k=2000)))
    rows = [(i, " ".join(word() for _ in range(280))) for i in range(48)]
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        blocks = with_windows(docs, substring_dedup.task()).select("body")

        def sizes(batches):
            for batch in batches:
                each = [len(x.as_py()) for x in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array([sum(each)]), pa.array([max(each, default=0)]), pa.array([len(each)])], names=["total", "longest", "n"])

        got = blocks.mapInArrow(sizes, "total long, longest long, n long").collect()
        assert sum(r.n for r in got) >= 24
        assert all(r.total <= BATCH_BYTES + r.longest for r in got), got
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("stage", [corpus_pipeline.exact, corpus_pipeline.near, corpus_pipeline.mix])
def test_staged_texts_are_small(spark, stage):
    """What a stage keeps of the whole texts takes at most three quarters of the input on disk; nothing of them is lost."""
    rng = random.Random(2)
    letters = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    words = [letters[i : i + 2 + i % 7] for i in range(0, 20_000, 5)]
    rows = [(i, " ".join(rng.choices(words, k=400)), "xx", "s", 1) for i in range(600)]
    docs = corpus_pipeline.write_table(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2), "memory")
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(folder.iterdir())
    size = lambda d: sum(f.stat().st_size for f in d.rglob("*.parquet"))
    given = size(Path(docs.inputFiles()[0].removeprefix("file://")).parent)
    got = stage(spark, docs, "")
    assert set(r.text for r in got.collect()) == {r[1] for r in rows}
    made = {d.name.rsplit("-", 1)[0]: size(d) for d in set(folder.iterdir()) - before}
    staged = {k: v for k, v in made.items() if k in ("exact-rows", "near-staged", "mix-rows")}
    assert len(staged) == 1 and max(staged.values()) <= 0.75 * given, (given, staged)

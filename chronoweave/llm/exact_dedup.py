"""Exact dedup as a tree-merge of sorted digest runs, in DataFrame operations only.

Every input partition is a run: its different digests with the retained row and the number of
copies, folded where they were read. The runs are dealt by digest once and sorted, and are
merged there in rounds: in each, ``fan_in`` runs with neighbouring numbers become one, keeping the
retained row of each digest, until one run is left. As all rounds follow one order, each
is a merge of sorted input that holds one row at a time, and only the first moves rows. A
digest with very many copies is one row a run from the start. Texts never move: one scan leaves
60 bytes a row; rows get their verdict by joins that leave those of hot digests in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, numbered, text_or_empty, write_table

#: SHA-256 decides; the length and an unrelated 64-bit hash verify it at every level.
KEY = ["digest", "bytes", "check"]
#: Digests with more than this part of all rows have their rows stay where they are.
SHARE = 1000


def signed_rows(body: Column) -> list[Column]:
    """The columns of ``KEY`` for a text."""
    return [F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), F.octet_length(body).alias("bytes"), F.xxhash64(body).alias("check")]


def _row(id_col: str, keep: str, *more: str) -> Column:
    """A row as what is retained: a struct in whose order rows without an identifier come last.

    Structs are aggregated in sorted order, never by hash: each run is sorted where it was read.
    """
    flag = F.col(id_col).isNull() if keep == "smallest" else F.col(id_col).isNotNull()
    return F.struct(flag.alias("flag"), F.col(id_col).alias("id"), *more).alias("row")


def merged_runs(signed: DataFrame, pick: Callable[[str], Column], *, fan_in: int = 16) -> DataFrame:
    """``digest, bytes, check, kept_row, group_size`` of the digests with more than one row.

    ``signed`` has ``KEY``, ``run``, and ``row``, of which ``pick`` (the least or the largest) is retained.
    """
    last = signed.agg(F.max("run")).first()[0] or 0
    levels = 0
    while last >= fan_in**levels:
        levels += 1
    runs = signed.groupBy("run", *KEY).agg(pick("row").alias("kept_row"), F.count("*").alias("group_size"))
    places = [f"__run{j}" for j in range(levels, 0, -1)]  # the number of the merged run, by round, last round first
    tree = runs.withColumns({f"__run{j}": F.expr(f"run div {fan_in**j}") for j in range(1, levels + 1)}).repartition("digest")
    for n in range(len(places), -1, -1):  # all in one order, of which a round needs a shorter prefix than the one before
        tree = tree.groupBy(*KEY, *places[:n]).agg(pick("kept_row").alias("kept_row"), F.sum("group_size").alias("group_size"))
    return write_table(tree.where("group_size > 1"), "exact-merged")


def judged(signed: DataFrame, merged: DataFrame) -> DataFrame:
    """``signed`` with ``kept_row, group_size`` of its digest, null where the row is alone."""
    bound = max(1, signed.count() // SHARE)
    hot, cold = F.broadcast(merged.where(F.col("group_size") > bound)), merged.where(F.col("group_size") <= bound)
    names = F.broadcast(merged.where(F.col("group_size") > bound).select(*KEY))  # fewer than SHARE
    return signed.join(hot, KEY).unionByName(signed.join(names, KEY, "left_anti").join(cold, KEY, "left"))


def _pick(keep: str) -> Callable[[str], Column]:
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    return F.max if keep == "largest" else F.min


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; null counts as empty; a text of any length is hashed whole.
    ``keep`` names the identifier of a group that stays, ``largest`` or ``smallest``. Rows without
    an identifier never give ``keep_id`` while another row of the group has one. Rows that repeat
    the kept identifier and text are all ``kept``. Other columns are ignored; an empty table
    gives no rows.
    """
    pick = _pick(keep)
    signed = write_table(docs.select(_row(id_col, keep), *signed_rows(text_or_empty(text_col)), F.spark_partition_id().alias("run")), "exact-signed")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("row.id")).otherwise(F.col("kept_row.id"))
    return judged(signed, merged_runs(signed, pick, fan_in=fan_in)).select(
        F.col("row.id").alias("doc_id"),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("row.id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """The rows of ``docs``, one of each text: that with the ``largest`` (or ``smallest``) identifier.

    Of rows that share identifier and text one stays, whatever else they hold; a row without
    identifier stays only where no row of its text has one. Null text is empty. All columns
    come through; texts are written once, and only verdicts move.
    """
    pick, rows = _pick(keep), numbered(docs, "exact-rows", compression="zstd")
    signed = write_table(rows.select(_row(id_col, keep, "__part", "__slot"), *signed_rows(text_or_empty(text_col)), F.col("__part").alias("run")), "exact-signed")
    gone = judged(signed, merged_runs(signed, pick, fan_in=fan_in)).where("group_size is not null and row <> kept_row")
    facts = gone.select("row.__part", "row.__slot", F.lit(True).alias("__gone"))
    return attach(rows, facts, "__gone").where("__gone is null").select(*docs.columns)


SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

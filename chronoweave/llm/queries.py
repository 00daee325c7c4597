"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, gif, langid, mixing, packing, pii, simhash, substring_dedup, suffix_dedup, warc
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def vocabulary() -> str:
    """The tokenizer file of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary()).drop("ids")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.store_texts(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(spark, table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("whole", "part")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_gif": op5_gif,
    "op6_language_id": op6_language_id,
    "op7_simhash": op7_simhash,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
}

SQL: dict[str, str] = {
    "op1_exact_dedup": exact_dedup.SQL,
    "op2_substring_dedup": substring_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_mixing": mixing.SQL,
    "op10_suffix_dedup": suffix_dedup.SQL,
}

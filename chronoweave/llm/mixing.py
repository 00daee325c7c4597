"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

DataFrame operations only. The targets come from one small row per source. The repetitions
need a running total of each source in a seeded order; a source may hold a third of all
rows, so it is cut by the leading digits of the seeded key: one sum per piece, a running
total over the pieces, and a running total inside each piece. Rows that share an identifier, or
have none, are ordered by their text instead, and equal rows of that kind are one entry of the
order, so none of them piles up either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, attach, join_hot, numbered, text_or_empty, write_table

SEED = "mix-7"
#: Rows of a source that one piece of its order holds, about.
PIECE_ROWS = 20_000


def water_fill(sources: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """``sources (source, source_size)`` with ``target`` added.

    Sources in code-point order, null last, take ``weights`` in turn and share ``share`` of
    all sizes by weight. A target stops at ``max_epochs`` times its source's size and the
    excess is shared again. Clamping in the order of the level at which a source is full
    makes each round a prefix: the fixed point is the first prefix whose remaining sources
    all stay below their cap. One row per source passes the unpartitioned windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    everything = Window.partitionBy()
    placed = sources.withColumn("place", F.row_number().over(by_name))
    ring = F.array(*map(F.lit, weights))
    levels = (
        placed.withColumn("weight", F.element_at(ring, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("open", (F.col("budget") - F.col("cap_before")) * F.col("weight") <= F.col("cap") * F.col("weight_left"))
    )
    first = F.min(F.when(F.col("open"), F.struct("cap_before", "weight_left"))).over(everything)
    rest = levels.withColumn("first", first)
    shared = (F.col("budget") - F.col("first.cap_before")) * F.col("weight") / F.col("first.weight_left")
    return rest.select("source", "source_size", F.when(F.col("open"), shared).otherwise(F.col("cap").cast("double")).alias("target"))


def _piece_digits(rows: int) -> int:
    digits = 2  # 256 pieces at least, so that those of a hot source spread evenly over the tasks
    while rows > PIECE_ROWS * 16**digits and digits < 8:
        digits += 1
    return digits


def _place(column: str) -> Column:
    """A key for a value that may be missing; a missing one is the last."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def _sized(rows: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """What the decision needs of each row of a numbered table."""
    return write_table(
        rows.select(
            "__part", "__slot", F.col(id_col).alias("doc_id"), _place(id_col).alias("named"), F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"), F.md5(text_or_empty(text_col)).alias("digest"),
        ),
        "mix-sized",
    )


def _repeated(rows: DataFrame) -> DataFrame:
    """``__part, __slot, name, key, size, nth, rows`` of rows whose identifier is missing or repeated.

    The key comes of identifier and text. Rows of equal source, key and size are one entry of
    ``rows`` rows, and ``nth`` counts them: over parts, of which there are few, then within one.
    """
    entry = ["name", "key", "size"]
    per_part = rows.groupBy(*entry, "__part").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*entry).orderBy("__part")
    based = write_table(per_part.withColumn("base", F.sum("n").over(w) - F.col("n")).withColumn("rows", F.sum("n").over(Window.partitionBy(*entry))), "mix-parts")
    inside = Window.partitionBy("__part", *entry).orderBy("__slot")
    ranked = rows.withColumn("place", F.row_number().over(inside) - 1)
    return ranked.join(based.drop("n"), ["__part", *entry]).withColumn("nth", F.col("base") + F.col("place"))


def decide(sized: DataFrame, *, weights: tuple[int, ...], share: float, max_epochs: int, seed: str) -> DataFrame:
    """``sized`` with ``source_size, target, whole, part`` for each row."""
    per_source = write_table(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "mix-sources")
    most, total = per_source.agg(F.max("rows"), F.sum("rows")).first()
    digits = _piece_digits(most or 0)
    targets = water_fill(per_source.drop("rows"), weights=weights, share=share, max_epochs=max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("extra", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5).cast("long"))
    targets = targets.withColumn("name", _place("source")).drop("source")

    plain = sized.withColumn("name", _place("source"))
    ident = F.when(F.col("doc_id").isNull(), F.lit("null")).otherwise(F.col("doc_id").cast("string"))
    alone = F.md5(F.concat(F.lit(f"{seed}:"), ident))
    by_text = F.md5(F.concat(F.lit(f"{seed}:"), ident, F.lit(":"), F.col("digest")))
    again = write_table(plain.groupBy("named").agg(F.count("*").alias("again")).where("again > 1 or named = 'null'"), "mix-again")
    columns = ["__part", "__slot", "doc_id", "name", "size", "key"]
    if again.isEmpty():
        single, many, entries = plain.withColumn("key", alone).select(*columns), None, None
    else:
        names = again.select("named")
        single = plain.join(names, "named", "left_anti").withColumn("key", alone).select(*columns)
        held = join_hot(plain, again, "named", "again", total or 0).withColumn("key", by_text).select(*columns)
        many = write_table(_repeated(held), "mix-repeated")
        entries = many.groupBy("name", "key", "size").agg(F.first("rows").alias("rows"))

    one = F.lit(1).cast("long")
    order = single.select("name", "key", "size", "doc_id", "__part", "__slot", one.alias("rows"))
    if entries is not None:
        order = order.unionByName(entries, allowMissingColumns=True)
    order = order.withColumn("piece", F.substring("key", 1, digits)).withColumn("words", F.col("size") * F.col("rows"))
    starts = (
        order.groupBy("name", "piece")
        .agg(F.sum("words").alias("sum"))
        .withColumn("start", F.sum("sum").over(Window.partitionBy("name").orderBy("piece")) - F.col("sum"))
        .drop("sum")
        .join(targets, "name")
    )
    inside = Window.partitionBy("name", "piece").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = order.withColumn("ahead", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    placed = ahead.join(starts, ["name", "piece"]).withColumn("ahead", F.col("start") + F.col("ahead"))
    facts = ["source_size", "target", "whole", "extra", "ahead"]
    if many is not None:
        placed = write_table(placed.select("name", "key", "size", "doc_id", "__part", "__slot", "rows", *facts), "mix-placed")
        spots = placed.where("__part is null").select("name", "key", "size", "rows", *facts).withColumn("entry", F.concat_ws(":", "key", "size", "name"))
        rows = many.withColumn("entry", F.concat_ws(":", "key", "size", "name")).select("__part", "__slot", "doc_id", "entry", "nth")
        met = join_hot(rows, spots.drop("name", "key"), "entry", "rows", total or 0).withColumn("ahead", F.col("ahead") + F.col("nth") * F.col("size"))
        placed = placed.where("__part is not null").select("__part", "__slot", "doc_id", "size", *facts).unionByName(met.select("__part", "__slot", "doc_id", "size", *facts))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - F.col("ahead")))
    return placed.select("__part", "__slot", "doc_id", "size", "source_size", "target", "whole", part.alias("part"))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, taken, whole, part``.

    ``size`` counts words (null text: none) and ``taken = whole * size + part`` the words that
    the mix takes: every document of a source ``whole`` times, then, in an order seeded by the
    identifier, once more until the source's target is met; the last of these gives the
    first ``part`` words only. A source's taken words are its target rounded, no document
    exceeds ``max_epochs`` times its size, and a rerun takes the same. Rows without an identifier,
    or with a repeated one, have their place by identifier and text; equal ones are
    interchangeable. Null is a source. Texts of any length are counted whole; other columns are
    ignored; an empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    placed = plain.withColumns({"__part": F.spark_partition_id(), "__slot": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")})
    decided = decide(_sized(placed, "doc_id", "text", "source"), weights=weights, share=share, max_epochs=max_epochs, seed=seed)
    return decided.select("doc_id", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"), "whole", "part")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, spacing unchanged."""
    spaced = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(spaced, F.lit(1), n.cast("int")), "")


def materialise(docs: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2, seed: str = SEED) -> DataFrame:
    """The rows of the mix, with the columns of ``docs``: each row as often as :func:`mix` takes it.

    A row taken for ``part`` of its words ends after them; one that is taken for nothing
    goes. ``n_chars``, where there is one, follows the text. Decisions are by row, also for repeated and
    missing identifiers; all other columns come through, whatever their names. Texts are
    written once, and only decisions move.
    """
    rows = numbered(docs, "mix-rows", compression="zstd")
    decided = decide(_sized(rows, "doc_id", "text", "source"), weights=weights, share=share, max_epochs=max_epochs, seed=seed)
    once_more = F.when(F.col("part") == F.col("size"), 1).otherwise(0)
    full = F.when(F.col("size") > 0, F.col("whole") + once_more).otherwise(0).cast("int")
    rest = F.when((F.col("part") > 0) & (F.col("part") < F.col("size")), F.col("part")).otherwise(0).cast("int")
    held = attach(rows, decided.select("__part", "__slot", F.struct(full.alias("full"), rest.alias("rest")).alias("__choice")), "__choice")
    copies = F.concat(
        F.array_repeat(F.col("text"), F.col("__choice.full")),
        F.when(F.col("__choice.rest") > 0, F.array(first_words(F.col("text"), F.col("__choice.rest")))).otherwise(F.array().cast("array<string>")),
    )
    out = held.withColumn("__text", F.explode(copies))
    shown = {"text": F.col("__text"), "n_chars": F.char_length("__text").cast("long")}
    return out.select(*[shown.get(c, F.col(c)).alias(c) for c in docs.columns])


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix-7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM per_source),
weighed AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         source_size * 2 AS cap, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget
  FROM placed),
levels AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS cap_before,
         (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weight_left
  FROM weighed),
opened AS (
  SELECT *, (budget - cap_before) * weight <= cap * weight_left AS is_open FROM levels),
targets AS (
  SELECT o.source, o.source_size,
         CASE WHEN is_open THEN (budget - f.cap_before) * weight / f.weight_left ELSE cap::DOUBLE END AS target
  FROM opened o LEFT JOIN (
    SELECT cap_before, weight_left FROM opened WHERE is_open ORDER BY cap_before, weight_left LIMIT 1) f ON true),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
extras AS (
  SELECT *, CAST(floor(target - whole * source_size + 0.5) AS BIGINT) AS extra FROM epochs),
ordered AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM sized)
SELECT d.doc_id, d.size, e.source_size, e.target,
       e.whole * d.size + greatest(0, least(d.size, e.extra - d.ahead)) AS taken
FROM ordered d JOIN extras e ON d.source IS NOT DISTINCT FROM e.source
"""

"""What the corpus operators share: work tables, rows that stay where they are, hot-key joins, table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import last_path, made, new_path, new_table, release, shared_folder, stage

__all__ = ["WORD", "attach", "bounded_bytes", "buckets", "join_hot", "last_path", "made", "new_path", "new_table", "numbered", "release", "shared_folder", "spread", "table", "text_or_empty", "write_bucketed", "write_table"]

#: One word of a text: a run of anything but space and the ASCII controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch of long rows; a batch is held by the JVM and by Python, on its way there and back.
BATCH_BYTES = 4 << 20
#: Buckets of a table at most.
MOST_BUCKETS = 50_000

write_table = stage


def bounded_bytes(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Arrow batches of the session take ``most`` bytes or one row; they stay so, as results are read after the return."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = str(spark.conf.get(name)).strip().lower().removesuffix("b")
    if not text.isdigit() or not 0 < int(text) <= most:
        spark.conf.set(name, str(most))


def spread(df: DataFrame) -> DataFrame:
    """A scan of few row groups, dealt over the cores before heavy work on each row.

    A scan with two partitions a core or more stays as it is, and so does any other plan.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString() or df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores)


def buckets(spark: SparkSession) -> int:
    """Buckets of a work table: one a shuffle partition, as a bucket is a task even where it is empty."""
    return min(MOST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_bucketed(df: DataFrame, label: str, column: str, *, compression: str | None = None) -> DataFrame:
    """``df`` as a table bucketed by ``column``; each task writes its own rows, so none is shuffled."""
    spark = df.sparkSession
    name, out = new_table(spark, "rows"), df.write.format("parquet").option("path", new_path(spark, label))
    out = out.option("compression", compression) if compression else out
    out.bucketBy(buckets(spark), column).saveAsTable(name)
    return spark.table(name)


def numbered(df: DataFrame, label: str, *, compression: str | None = None) -> DataFrame:
    """``df``, written with ``__part``, the task that wrote a row, and ``__slot``, its place there.

    The table is bucketed by ``__part``: what :func:`attach` adds comes to the rows. It stays as long as
    the result is read, so whole texts may be worth a stronger ``compression``.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("int")
    return write_bucketed(df.withColumns({"__part": F.spark_partition_id(), "__slot": place}), label, "__part", compression=compression)


def attach(rows: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """The rows of a :func:`numbered` table with ``value`` of ``facts (__part, __slot, value)``, null where there is none.

    The values of a part are gathered into an array in the order of the slots and meet the
    part's bucket there. Only they are shuffled, never ``rows``; their number in an array is that
    of the rows that one task has read. ``facts`` has one row for a row at most.
    """
    kind = facts.schema[value].dataType
    own = facts.select("__part", "__slot", F.col(value).alias("v"))
    every = rows.select("__part", "__slot", F.lit(None).cast(kind).alias("v")).unionByName(own)
    # Of a slot with a value there are two entries, and the one with the value comes last.
    per = every.groupBy(F.col("__part").alias("__of")).agg(F.array_sort(F.collect_list(F.struct("__slot", "v"))).alias("__all"))
    last = F.filter("__all", lambda x, i: ~F.get("__all", i + 1)["__slot"].eqNullSafe(x["__slot"]))
    per = per.select("__of", F.transform(last, lambda x: x["v"]).alias("__values"))
    met = rows.join(per.hint("shuffle_hash"), F.col("__part") == F.col("__of"))
    return met.withColumn(value, F.get("__values", F.col("__slot"))).drop("__part", "__slot", "__of", "__values")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def join_hot(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int, share: int = 1000) -> DataFrame:
    """Inner-join ``rows`` to ``facts`` (one row a key) where few keys may hold most rows.

    ``weight`` is the column of ``facts`` that counts the rows of its key and ``total`` the
    number of rows. Keys above ``total / share`` rows number fewer than ``share``, whatever
    the data: only these are broadcast, so their rows stay where they are. The others are
    shuffled, and none of them can fill more than a ``share``-th of the rows.
    """
    bound = max(1, total // share)
    hot = F.broadcast(facts.where(F.col(weight) > bound))
    cold = facts.where(F.col(weight) <= bound)
    names = F.broadcast(facts.where(F.col(weight) > bound).select(key))
    return rows.join(hot, key).unionByName(rows.join(names, key, "left_anti").join(cold, key))

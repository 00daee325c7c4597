"""Tables written between the stages of a plan, for what several later stages read.

A plan that uses one result in several places computes it in each. What is costly and
used often is written once as Parquet to the folder that all executors share, which also
survives a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
#: By application: the folders and the catalogue's tables that it has made, in order.
_made: dict[str, list[tuple[str, str]]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    A folder of this machine serves only where that is unset and the driver is the only
    machine there is; on a cluster an unset folder is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="chronoweave-")
    return _fallback[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A folder that nothing uses yet, remembered for :func:`release`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(("path", path))
    return path


def new_table(spark: SparkSession, label: str) -> str:
    """The name of a table of the catalogue that nothing uses yet, remembered for :func:`release`."""
    name = f"chronoweave_{label}_{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(("table", name))
    return name


def stage(df: DataFrame, label: str, *, together: bool = False) -> DataFrame:
    """``df``, written and read again under the schema that it has; an empty table reads back as well.

    With ``together`` rows that were dealt by a part of a join's keys (a recording) are joined where they
    lie; by Spark's default a join deals both its sides anew by all of its keys.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    try:
        if together:
            spark.conf.set(name, "false")
        df.write.parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def made(spark: SparkSession) -> int:
    """How many folders and tables this application has made and not released."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def last_path(spark: SparkSession) -> str:
    """The folder that this application made last."""
    return [name for kind, name in _made[spark.sparkContext.applicationId] if kind == "path"][-1]


def release(spark: SparkSession, *, since: int = 0, keep: Collection[str] = ()) -> int:
    """Delete what this application staged, once nothing reads it any more; the number of tables and folders.

    With ``since`` only what came after the first so many; ``keep`` names folders that stay.
    """
    mine = _made.get(spark.sparkContext.applicationId, [])
    gone = [x for x in mine[since:] if x[1] not in keep]
    mine[since:] = [x for x in mine[since:] if x[1] in keep]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for kind, name in gone:
        if kind == "table":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        else:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
    return len(gone)

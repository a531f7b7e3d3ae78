"""Where a job may put intermediate tables, checkpoints and streaming state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Scratch paths handed out and not discarded, by application.
_made: dict[str, list[str]] = {}
_local: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the session names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the session
    runs in local mode; on a cluster executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="squadbook-"))
        base = _local[0]
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    scratch_made(spark).append(path)
    return path


def scratch_made(spark: SparkSession) -> list[str]:
    """The scratch paths of this application that are not discarded, in order."""
    return _made.setdefault(spark.sparkContext.applicationId, [])


def discard(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Delete scratch paths, by default all of this application.

    Results are read from scratch tables when they are consumed; discard them after that.
    """
    made = scratch_made(spark)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for text in list(made if paths is None else paths):
        path = jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)
        if text in made:
            made.remove(text)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of jobs that are done.

    It does so when the driver's garbage is collected, which may be long after the next jobs.
    """
    spark._jvm.System.gc()


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in scratch space, for results several jobs read again."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

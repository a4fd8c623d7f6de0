"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders this process has written, each with its label.
_written: list[tuple[str, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this machine gets a folder of its own where it names none; on a
    cluster, a folder of one machine would hold a part of each result, so that is an error.
    """
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if there:
        return there
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    made = tempfile.mkdtemp(prefix="docloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, to be deleted by ``clear``."""
    path = f"{shared_dir(spark).rstrip('/')}/docloom/{label}-{uuid.uuid4().hex}"
    _written.append((label, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, label: str | None = None) -> int:
    """Delete what this process has written, or only what has the ``label``; the number of results deleted.

    Frames read from them end with it. What other processes of the same folder have written is left alone.
    """
    jvm = spark.sparkContext._jvm
    chosen = [x for x in _written if label is None or x[0] == label]
    deleted = 0
    for entry in chosen:
        path = jvm.org.apache.hadoop.fs.Path(entry[1])
        deleted += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
        _written.remove(entry)
    return deleted

"""Shared-folder handling: where multi-pass operators put their intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without that setting gets a
    folder of its own; anywhere else a machine-local folder would be lost with its executor, so that is an
    error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="duelframe-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    path = f"{shared_dir(spark).rstrip('/')}/duelframe/{name}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def drop_stages(spark: SparkSession) -> int:
    """Delete the intermediate tables this process wrote; call it when their results have been stored."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        dropped += path.getFileSystem(conf).delete(path, True)
    return dropped


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a plan reads its input several times: the lineage is cut, lost executors cost nothing, and
    each later read prunes columns.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``stage`` that nothing reads any more."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if df.staged_path in _STAGED:
            _STAGED.remove(df.staged_path)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

"""What every operator asks of the running session: a shared folder for written intermediate tables, and the task count to aim at."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_paths: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir, which all executors reach. Only where the session names none (local tests) one of our own is made, and removed at exit."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _own:
        _own[key] = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _own[key], ignore_errors=True)
    return "file://" + _own[key]


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows once and reads them back: cuts the lineage, survives the loss of executors, and later reads prune columns. The files go when discard() is called, or at the end of the driver."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if not _paths:
        atexit.register(release, spark)
    _paths.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a written() frame that nothing will read any more."""
    if (path := getattr(df, "_written_path", None)) in _paths:
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Deletes every table written so far. Frames that still read them can't be used any more."""
    for path in list(_paths):
        with contextlib.suppress(Exception):  # at exit the JVM may be gone
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
    _paths.discard(path)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

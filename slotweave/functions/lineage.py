"""Tables that several parts of a plan read, written once in the folder that the cluster names for checkpoints."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[int, str] = {}
_written: list[tuple[int, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own if all runs on this machine, as in tests; else an
    error, as each executor would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/series"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: tables that are read again need a folder that all executors share")
    key = id(spark.sparkContext)
    if key not in _own:
        _own[key] = "file://" + tempfile.mkdtemp(prefix="slotweave-series-")
    return _own[key]


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table that is read back: what follows prunes its columns, starts from its files when an
    executor is lost, and knows its size when it chooses joins. Removed at exit."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A path of the shared folder for files that are wanted in this session only; removed at exit."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written.append((id(spark.sparkContext), path))
    return path


@atexit.register
def _clear() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for context, path in _written:
        if context == id(spark.sparkContext):
            try:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)
            except Exception:  # noqa: BLE001 - the session may be gone already
                return

"""Plumbing shared by the operators: tables in the shared folder, word hashing, ranks, components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but ASCII white space. bytes.split() cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

_own_dirs: dict[int, str] = {}
_written: set[tuple[str, int]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of our own if all
    run on this machine (as in tests), else an error: executors would write each to its own disk."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/") + "/slotweave"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
    key = id(spark.sparkContext)
    if key not in _own_dirs:
        _own_dirs[key] = "file://" + tempfile.mkdtemp(prefix="slotweave-")
    return _own_dirs[key]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: the lineage ends there, and a lost
    executor costs nothing that was written. The table goes at exit, or earlier by ``release``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.add((path, id(spark.sparkContext)))
    out = spark.read.schema(df.schema).parquet(path)
    out._slotweave_path = path
    return out


def release(*dfs: DataFrame) -> None:
    """Remove tables made by ``materialize`` that nothing reads any more."""
    for df in dfs:
        path = getattr(df, "_slotweave_path", None)
        if path:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _written.discard((path, id(spark.sparkContext)))


@atexit.register
def _remove_all() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for path, context in list(_written):
        if context == id(spark.sparkContext):
            try:
                _remove(spark, path)
            except Exception:  # noqa: BLE001 - the session may be gone already
                return


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this package where they start in another folder than the driver found it in. (On a
    cluster that doesn't have it at the same place it is shipped as any package, by --py-files.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    told = spark.sparkContext.environment
    if root not in (paths := told.get("PYTHONPATH", "").split(os.pathsep)):
        told["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def trimmed(rows):
    """``rows``, a function of batches, that gives what it has freed back to the machine when a task ends: a Python worker
    goes on with tasks of other stages, and would keep the most that any of them took."""

    def run(batches):
        try:
            yield from rows(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library: it keeps what it has
                pass

    return run


#: Stands for a null id, which comes after all others.
NO_ID = 2**63 - 1


def id_of(key: Column) -> Column:
    return F.coalesce(key.cast("long"), F.lit(NO_ID))


def shown_id(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def normalized(text: Column | str) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


# --- hashing in numpy -----------------------------------------------------------------------------------------------
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64: a bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive word hashes (of all of them, if there are fewer; none for no words)."""
    n = len(w)
    if n == 0:
        return w
    k = min(k, n)
    h = w[: n - k + 1] + np.uint64(k)
    for j in range(1, k):
        h = h * _BASE + w[j : n - k + 1 + j]
    return mix64(h)


# --- distributed ranks ----------------------------------------------------------------------------------------------
def with_rank(df: DataFrame, by: list[str], tie: list[str], name: str = "rank") -> DataFrame:
    """A 0-based rank of each row among the rows of equal ``by``, in an unspecified but repeatable order. A key with any
    share of the rows is dealt out by a hash of ``tie`` (a key of the table): ranks are numbered within (key, bucket)
    and shifted by the sizes of the buckets before."""
    n = partitions(df.sparkSession)
    from pyspark.sql import Window

    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*tie), F.lit(n)).cast("int"))
    sizes = df.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*by, "_bucket", before.alias("_before"))
    local = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*tie)) - 1
    return df.withColumn("_local", local).join(sizes, [*by, "_bucket"]).withColumn(name, F.col("_local") + F.col("_before")).drop("_bucket", "_local", "_before")


# --- connected components -------------------------------------------------------------------------------------------
def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(id, component): for every node of ``edges`` the smallest node that it reaches. Large-star / small-star rounds:
    each points a node's neighbours to the smallest one around it, until the edges stay the same. Minima are aggregates
    (combined before the shuffle) and each is written before it is joined, so that adaptive execution can split the
    partition of a node with very many neighbours. Only a count and a checksum come to the driver."""
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct()
    e = materialize(e, "cc-edges")

    def state(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-low")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialize(large, "cc-large")
        low2 = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = large.join(low2, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low2.select("a", F.col("m").alias("b")))
        new = materialize(small.where("a <> b").distinct(), "cc-edges")
        now = state(new)
        release(e, low, large, low2)
        e = new
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

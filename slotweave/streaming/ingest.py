"""Records as a stream: each micro-batch is folded into the per-load table, which later loads add to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.columns import slot_start
from ..operators.slots import COUNT, LOAD, local_records, slots_of
from ..settings import DEFAULT, KEYS, Settings


def slot_sums(records: DataFrame, late: str = "7 days") -> DataFrame:
    """Tumbling slot totals by direction: a slot is final once the watermark of its time has passed."""
    timed = records.withColumn("time", slot_start(F.col("date"), F.col("slot")).cast("timestamp")).withWatermark("time", late)
    return timed.groupBy(*KEYS, F.window("time", "15 minutes").alias("w")).agg(F.sum(COUNT).alias("raw"), F.count("*").alias("records")).select(*KEYS, F.col("w.start").alias("time"), "raw", "records")


def ingest(spark: SparkSession, records: DataFrame, path: str, checkpoint: str, counters: DataFrame | None = None, settings: Settings = DEFAULT) -> StreamingQuery:
    """Appends each batch's per-load sums under its own folder. A batch that is run again replaces its folder, so that
    every record counts once; ``stored`` merges the folders. With the counters, those of vendors on UTC are moved to local
    time first."""

    def fold(batch: DataFrame, number: int) -> None:
        local = batch if counters is None else local_records(batch, counters, settings)
        per_load = local.groupBy(*KEYS, "date", "slot", F.col(LOAD).alias("load")).agg(F.sum(F.col(COUNT).cast("long")).alias("n"), F.count("*").alias("records"))
        per_load.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return records.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The slot table of all batches so far."""
    loads = spark.read.parquet(path).groupBy(*KEYS, "date", "slot", "load").agg(F.sum("n").alias("n"), F.sum("records").alias("records"))
    return slots_of(loads).drop("latest")

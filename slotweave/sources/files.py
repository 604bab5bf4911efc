"""Files: published counts, dimensions, events, weather, and the cleaned tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import date_from_sk, slot_from_label
from ..functions.lineage import cut
from ..operators.slots import LOAD, local_records

#: The columns of published counts.
RAW_SCHEMA = T.StructType([
    T.StructField("SITE_SK", T.ShortType()), T.StructField("DIRECTION_SK", T.ShortType()), T.StructField("COUNTER_SK", T.ShortType()),
    T.StructField("MODE_SK", T.ByteType()), T.StructField("date", T.DateType()), T.StructField("slot", T.ShortType()), T.StructField("ID", T.LongType()),
    T.StructField("TOTAL_15MIN_COUNT", T.IntegerType()), T.StructField("SPEED_15MIN_MEDIAN", T.FloatType()), T.StructField("SPEED_15MIN_85P", T.FloatType()),
    T.StructField("Status", T.ByteType()), T.StructField("Status description", T.StringType()), T.StructField(LOAD, T.DateType()),
])
WEATHER_SCHEMA = "date date, rain_mm_to_9am double, max_temp_c double"
EVENTS_SCHEMA = "date date, end_date date, name string, kind string, sites string, effect string, source string"


def typed_counts(rows: DataFrame) -> DataFrame:
    """Rows as the source has them (DATE_SK, 15MIN_TIME_SLOT, ...) with the columns and types of RAW_SCHEMA."""
    named = rows.withColumns({"date": date_from_sk(F.col("DATE_SK")), "slot": slot_from_label(F.col("15MIN_TIME_SLOT")), LOAD: F.substring(F.col(LOAD).cast("string"), 1, 10)})
    return named.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in RAW_SCHEMA))


def write_counts(counts: DataFrame, path: str) -> None:
    """One folder a site and year, each in the order in which slots are read. Only folders with new rows are replaced,
    and the commit protocol leaves no half of one."""
    years = counts.withColumn("year", F.year("date"))
    dealt = years.repartition("SITE_SK", "year").sortWithinPartitions("SITE_SK", "year", "DIRECTION_SK", "date", "slot", "ID")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("SITE_SK", "year").parquet(path)


def read_counts(spark: SparkSession, path: str, sites: list[int] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Published counts; sites and years are cut to the folders that can hold them, dates to the row groups."""
    df = spark.read.schema(T.StructType([*RAW_SCHEMA.fields, T.StructField("year", T.IntegerType())])).parquet(path)
    if sites is not None:
        df = df.where(F.col("SITE_SK").isin(*sites))
    if start:
        df = df.where((F.col("year") >= int(start[:4])) & (F.col("date") >= F.lit(start).cast("date")))
    if end:
        df = df.where((F.col("year") <= int(end[:4])) & (F.col("date") <= F.lit(end).cast("date")))
    return df.select(*RAW_SCHEMA.names)


def read_local(spark: SparkSession, path: str, counters: DataFrame, sites: list[int] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Counts in local time for a period of local dates: a day more on either side is read, as some are published in UTC."""
    day = lambda d, n: d and str(date.fromisoformat(d) + timedelta(days=n))
    return local_records(read_counts(spark, path, sites, day(start, -1), day(end, 1)), counters, start=start, end=end)


def inventory(rows: DataFrame) -> DataFrame:
    """(SITE_SK, DATE_SK, rows) that the source has."""
    return rows.groupBy("SITE_SK", "DATE_SK").agg(F.count("*").alias("rows"))


def packed(days: DataFrame, most: int) -> DataFrame:
    """(SITE_SK, DATE_SK, rows, chunk) of an inventory: the days of a site, in order, dealt to chunks that hold at most
    ``most`` rows; a larger day stands alone. A site has few days, so they are folded as an array."""
    listed = days.groupBy("SITE_SK").agg(F.sort_array(F.collect_list(F.struct("DATE_SK", F.col("rows").cast("long").alias("rows")))).alias("d"))
    none = F.struct(F.expr("CAST(array() AS ARRAY<INT>)").alias("chunks"), F.lit(-1).alias("chunk"), F.lit(most + 1).cast("long").alias("used"))

    def put(state, day):
        new = state["used"] + day["rows"] > most
        chunk = state["chunk"] + new.cast("int")
        return F.struct(F.concat(state["chunks"], F.array(chunk)).alias("chunks"), chunk.alias("chunk"), (F.when(new, F.lit(0)).otherwise(state["used"]) + day["rows"]).cast("long").alias("used"))

    out = listed.withColumn("c", F.aggregate("d", none, put)["chunks"]).select("SITE_SK", F.explode(F.arrays_zip("d", "c")).alias("x"))
    return out.select("SITE_SK", "x.d.DATE_SK", "x.d.rows", F.col("x.c").alias("chunk"))


def ingest(counts: DataFrame, expected: DataFrame, path: str) -> DataFrame:
    """Brings the stored counts up to an inventory: site-years whose number of rows differs are replaced, each as a whole,
    the others stay. The report: (SITE_SK, year, rows, stored, fetched, complete); what is not complete, because the
    source changed on the way, is fetched by the next run."""
    spark = counts.sparkSession
    have = lambda: read_counts(spark, path) if _exists(spark, path) else counts.where("false")
    stale = cut(stale_site_years(expected, have())).select("SITE_SK", "year")
    sites = [r[0] for r in stale.select("SITE_SK").distinct().collect()]  # as many as sites at most
    if sites:
        wanted = counts.where(F.col("SITE_SK").isin(sites)).withColumn("year", F.year("date")).join(stale, ["SITE_SK", "year"], "left_semi")
        write_counts(wanted.drop("year"), path)
    want = expected.groupBy("SITE_SK", F.substring(F.col("DATE_SK").cast("string"), 1, 4).cast("int").alias("year")).agg(F.sum("rows").alias("rows"))
    stored = have().groupBy("SITE_SK", F.year("date").alias("year")).agg(F.count("*").alias("stored"))
    out = want.join(stored, ["SITE_SK", "year"], "left").join(stale.withColumn("fetched", F.lit(True)), ["SITE_SK", "year"], "left")
    return out.select("SITE_SK", "year", "rows", F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce("fetched", F.lit(False)).alias("fetched"), F.coalesce(F.col("stored") == F.col("rows"), F.lit(False)).alias("complete"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stale_site_years(expected: DataFrame, counts: DataFrame) -> DataFrame:
    """(SITE_SK, year, rows) of an inventory (SITE_SK, DATE_SK, rows) whose stored rows are not as many."""
    want = expected.groupBy("SITE_SK", F.substring(F.col("DATE_SK").cast("string"), 1, 4).cast("int").alias("year")).agg(F.sum("rows").alias("rows"))
    have = counts.groupBy("SITE_SK", F.year("date").alias("year")).agg(F.count("*").alias("rows"))
    return want.join(have, ["SITE_SK", "year", "rows"], "left_anti")


def dimension_rows(dimension: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """The members of a dimension that have facts, with their number."""
    return dimension.join(facts.groupBy(key).agg(F.count("*").alias("fact_rows")), key)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header; every column is a string, to be cast where it is used."""
    return spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').csv(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).option("header", True).csv(path)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WEATHER_SCHEMA).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


#: The columns of cleaned slots, as written and read.
FINAL = "SITE_SK smallint, COUNTER_SK smallint, DIRECTION_SK smallint, date date, time timestamp_ntz, workday boolean, records smallint, raw int, count int, fix string, direction_unreliable boolean, hourly_binned boolean"
SERIES = "SITE_SK smallint, series string, COUNTER_SK smallint, DIRECTION_SK smallint, start date, end date, match_site smallint"


def write_slots(final: DataFrame, path: str) -> None:
    """Cleaned slots, a folder a site; a site's counters are dealt out, each in the order in which it is read."""
    final.repartition("SITE_SK", "COUNTER_SK").sortWithinPartitions("SITE_SK", "COUNTER_SK", "DIRECTION_SK", "time").write.mode("overwrite").partitionBy("SITE_SK").parquet(f"{path}/counts_15min")


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    out = spark.read.schema(FINAL).parquet(f"{path}/counts_15min")
    return out.select(*(c.split()[0] for c in FINAL.split(", ")))


def write_series(parts: DataFrame, weeks: DataFrame, path: str) -> None:
    """The parts of the series as CSV, and their weekly totals."""
    write_csv(parts.orderBy("SITE_SK", "series", "COUNTER_SK", "DIRECTION_SK", "start", "end"), f"{path}/series")
    weeks.orderBy("SITE_SK", "series", "week").write.mode("overwrite").parquet(f"{path}/weekly")


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES).option("header", True).csv(f"{path}/series")


def markdown(df: DataFrame) -> str:
    """A small result as a table of text; null is empty. Rows stream to the driver one partition at a time."""
    line = lambda cells: "| " + " | ".join(cells) + " |"
    rows = [line("" if v is None else str(v) for v in r) for r in df.toLocalIterator()]
    return "\n".join([line(df.columns), line("---" for _ in df.columns), *rows])


def brief(group: str, sites: list[int], meta: dict[str, DataFrame], text: str) -> str:
    """What a reviewer of a group needs to know: its sites, their counters, their directions with the dates that they have
    data, and how to judge them."""
    titles = {"sites": "Sites", "counters": "Counters", "directions": "Directions (dates with data)"}
    return "\n\n".join([f"# Review group {group}", f"The group's sites: `{sites}`", *(f"## {titles[name]}\n\n{markdown(meta[name])}" for name in titles), text])


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A text as a file of lines under ``path``."""
    spark.createDataFrame([(line,) for line in text.split("\n")], "line string").coalesce(1).write.mode("overwrite").text(path)

"""The driver's `events` table as records, and small dimension, decision and series tables to go with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import slot_label

COUNTERS = [(100, "C100", "PIEZO", "MetroCount"), (101, "C101", "TUBE", "MetroCount"), (102, "C102", "CAMERA", "VivaCity")]
DIRECTIONS = [(0, "North", None), (1, "South", None), (10, "North", None), (11, "South", None), (12, "North", None), (20, "North", None), (21, "South", None), (30, "North", None), (40, "North", "IN"), (41, "South", "OUT"), (50, "North", "IN"), (51, "South", "OUT")]
SITES = [(k, f"Site {k}", -33.86 + 0.012 * k, 151.20 + 0.009 * k) for k in range(6)]
HOLIDAYS = {"2024-01-01": "New Year", "2024-01-26": "National day"}
UNLISTED = ("2024-01-15", "2024-01-20")
WEATHER = [(f"2024-01-{d:02d}", float((d * 7) % 11) / 2, 20.0 + d % 9) for d in range(1, 32)]
#: (action, SITE_SK, DIRECTION_SK, start, end, factor, rejected, diagnosis)
DECISIONS = [
    *(("zero_fill", s, None, "2024-01-01", None, None, None, "not published") for s in (1, 2, 3, 4, 5)),
    ("drop_duplicates", 0, None, "2024-01-01", "2024-01-31", None, None, "two loads"),
    ("drop_duplicates", 2, None, "2024-01-01", "2024-01-31", None, None, "two loads"),
    ("subtract_other", 2, 20, "2024-01-08", "2024-01-09", None, None, "counts both ways"),
    ("missing", 0, 1, "2024-01-10 08:00", "2024-01-10 17:45", None, None, "dead"),
    ("missing", 3, None, "2024-01-12 03:15", "2024-01-12", None, None, "whole counter dead"),
    ("missing", 2, 21, "2024-01-16", "2024-01-16", None, None, "dead"),
    ("scale", 2, 21, "2024-01-16", "2024-01-17", 0.5, None, "doubled"),
    ("scale", 3, 31, "2024-01-16", "2024-01-17", 0.5, None, "doubled"),
    ("direction_unreliable", 4, None, "2024-01-18", None, None, None, "labels"),
    ("uncertain", 5, None, "2024-01-01", "2024-01-31", None, None, "odd"),
    ("restore", 5, None, "2024-01-01", "2024-01-31", None, None, "fine"),
    ("scale", 5, None, "2024-01-01", None, 0.5, True, "wrong"),
]
#: What a second reviewer might say of the same records.
OLD_DECISIONS = [
    *(("zero_fill", s, None, "2024-01-01", None, None, None, "not published") for s in (1, 2, 3)),
    ("drop_duplicates", 1, None, "2024-01-01", "2024-01-31", None, None, "two loads"),
    ("scale", 2, 21, "2024-01-10", "2024-01-12", 0.5, None, "doubled"),
    ("scale", 3, 31, "2024-01-16", "2024-01-16", 0.25, None, "doubled"),
    ("missing", 0, 1, "2024-01-10", "2024-01-10", None, None, "dead"),
    ("missing", 4, None, "2024-01-20", "2024-01-28", None, None, "camera dead"),
]
PARTS = [(1, "North joined", 100, 10, None, "2024-01-14"), (1, "North joined", 101, 12, "2024-01-15", None)]
#: (date, end_date, name, kind, sites, effect, source)
EVENTS = [("2024-01-07", "2024-01-07", "Ride to work, \"early\"", "ride", "1; 3;5", "more, by half", "paper"), ("2024-01-19", "2024-01-21", "Road works", "closure", "2", None, "notice")]
GROUP = "G0000"
_DECISION = "action string, SITE_SK smallint, DIRECTION_SK smallint, start string, end string, factor double, rejected boolean, diagnosis string"

RECORDS = """
SELECT CAST(user_id % 6 AS SMALLINT) AS SITE_SK,
       CAST(100 + (user_id % 6) DIV 2 + CASE WHEN user_id % 6 = 1 AND event_id % 10 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS COUNTER_SK,
       CAST((user_id % 6) * 10 + event_id % 2 + CASE WHEN user_id % 6 = 1 AND event_id % 10 = 0 THEN 2 ELSE 0 END AS SMALLINT) AS DIRECTION_SK,
       CAST(ts AS DATE) AS date, CAST(hour(ts) * 4 + minute(ts) DIV 15 AS SMALLINT) AS slot, event_id AS ID,
       CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value / 10) AS INT) END AS TOTAL_15MIN_COUNT,
       CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS TINYINT) AS Status,
       least(date_add(CAST(ts AS DATE), 1 + CAST(event_id % 3 = 0 AS INT)), DATE '2024-01-30') AS ADDED_UPDATED_DATETIME_SYDNEY
FROM {events}
"""


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records as the service has them."""
    r = records(spark, sf_dir)
    sk = F.concat(F.year("date"), F.dayofyear("date")).cast("int")
    day = F.concat(F.col("ADDED_UPDATED_DATETIME_SYDNEY").cast("string"), F.lit("T00:00:00"))
    none = lambda kind: F.lit(None).cast(kind)
    return r.withColumns({"DATE_SK": sk, "15MIN_TIME_SLOT": slot_label(F.col("slot")), "MODE_SK": F.lit(3), "SPEED_15MIN_MEDIAN": none("double"), "SPEED_15MIN_85P": none("double"), "Status description": F.when(F.col("Status") == 1, "warning"), "ADDED_UPDATED_DATETIME_SYDNEY": day}).drop("date", "slot")


def verdict(rows: list[tuple] | None = None) -> dict:
    """A reviewer's document of the decisions and series."""
    names = ("action", "SITE_SK", "DIRECTION_SK", "start", "end", "factor", "rejected", "diagnosis")
    series: dict[tuple, list[dict]] = {}
    for site, name, counter, direction, start, end in PARTS:
        series.setdefault((site, name), []).append({"COUNTER_SK": counter, "DIRECTION_SK": direction, "start": start, "end": end})
    told = [{"SITE_SK": s, "name": n, "parts": p} for (s, n), p in series.items()] + [{"SITE_SK": 4, "name": "wrong", "rejected": True, "parts": [{"COUNTER_SK": 102, "DIRECTION_SK": 40}]}]
    return {"group": GROUP, "decisions": [{k: v for k, v in zip(names, r, strict=True) if v is not None} for r in rows or DECISIONS], "series": told, "proposals": []}


def derived_decisions(daily: DataFrame, turn: int) -> DataFrame:
    """Decisions made by rule from the days that directions have: the same rule is stated in SQL."""
    k = F.col("DIRECTION_SK") + F.dayofmonth("date")
    one = daily.where(k % 4 == turn)
    kinds = F.array(*(F.lit(a) for a in ("missing", "scale", "subtract_other", "drop_duplicates", "direction_unreliable", "uncertain")))
    end = F.when(F.dayofmonth("date") % 5 != 0, F.date_add("date", F.col("DIRECTION_SK") % 3).cast("string"))
    return one.select(F.element_at(kinds, (k % 6 + 1).cast("int")).alias("action"), "SITE_SK", F.when(F.col("DIRECTION_SK") % 4 != 0, F.col("DIRECTION_SK")).alias("DIRECTION_SK"), F.col("date").cast("string").alias("start"), end.alias("end"),
                      F.when(k % 6 == 1, F.when(F.dayofmonth("date") % 2 == 0, 0.5).otherwise(0.25)).alias("factor"), (F.dayofmonth("date") % 9 == 0).alias("rejected"), F.concat(F.lit("Camera day "), F.col("date").cast("string")).alias("diagnosis"))


def derived_parts(span: DataFrame, joined: bool) -> DataFrame:
    """Series by rule from (keys, first, last): each direction alone, or those of every third site as one."""
    one = F.concat(F.lit("D"), F.col("DIRECTION_SK").cast("string"))
    name = F.when((F.col("SITE_SK") % 3 == 0) & F.lit(joined), F.concat(F.lit("S"), F.col("SITE_SK").cast("string"))).otherwise(one)
    end = F.when((F.col("SITE_SK") % 3 == 1) & F.lit(joined), F.date_sub("last", 1)).otherwise(F.col("last"))
    return span.select("SITE_SK", name.alias("series"), "COUNTER_SK", "DIRECTION_SK", F.col("first").alias("start"), end.alias("end"))


def _table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """Literal rows with a size that the optimizer knows, so that it can broadcast them."""
    names, kinds = zip(*((c.rpartition(" ")[0], c.rpartition(" ")[2]) for c in columns.split(", ")), strict=True)
    cell = lambda v: "NULL" if v is None else str(v) if isinstance(v, int | float) else "'" + v.replace("'", "\\'") + "'"
    places = [f"c{i}" for i in range(len(names))]
    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {k}) AS {n}" for n, k in zip(names, kinds, strict=True)) + " WHERE false")
    body = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows)
    picked = ", ".join(f"CAST({p} AS {k}) AS {n}" for p, n, k in zip(places, names, kinds, strict=True))
    return spark.sql(f"SELECT {picked} FROM VALUES {body} AS t({', '.join(places)})")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records, before any shift of time."""
    return spark.sql(RECORDS, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def counters(spark: SparkSession) -> DataFrame:
    return _table(spark, COUNTERS, "COUNTER_SK smallint, `Counter ID` string, Technology string, `Vendor name` string")


def directions(spark: SparkSession) -> DataFrame:
    return _table(spark, DIRECTIONS, "DIRECTION_SK smallint, `Orientation description` string, `Location in/out` string")


def sites(spark: SparkSession) -> DataFrame:
    return _table(spark, SITES, "SITE_SK smallint, `Site name` string, `Site latitude` double, `Site longitude` double")


def dates(spark: SparkSession) -> DataFrame:
    """All strings, as the file has them."""
    d = spark.sql("SELECT explode(sequence(DATE'2023-12-31', DATE'2024-01-31')) AS d").where(~F.col("d").cast("string").isin(*UNLISTED))
    holiday = F.col("d").cast("string").isin(*HOLIDAYS)
    kind = F.when(holiday, "Public holiday").when(F.weekday("d") < 5, "Weekday (excl. PH)").otherwise("Weekend")
    name = F.lit(None).cast("string")
    for day, called in HOLIDAYS.items():
        name = F.when(F.col("d").cast("string") == day, called).otherwise(name)
    return d.select(F.concat(F.col("d").cast("string"), F.lit("T00:00:00")).alias("Date"), kind.alias("Day type"), name.alias("Public holiday"), F.lit(None).cast("string").alias("School holiday"))


def weather(spark: SparkSession) -> DataFrame:
    return _table(spark, WEATHER, "date string, rain_mm_to_9am double, max_temp_c double").withColumn("date", F.col("date").cast("date"))


def events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENTS, "date string, end_date string, name string, kind string, sites string, effect string, source string")


def decisions(spark: SparkSession, rows: list | None = None) -> DataFrame:
    return _table(spark, DECISIONS if rows is None else rows, _DECISION)


def parts(spark: SparkSession) -> DataFrame:
    p = _table(spark, PARTS, "SITE_SK smallint, series string, COUNTER_SK smallint, DIRECTION_SK smallint, start string, end string")
    return p.withColumns({"start": F.col("start").cast("date"), "end": F.col("end").cast("date")})

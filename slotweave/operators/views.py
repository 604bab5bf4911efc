"""Analytic views over published data; nothing in them is cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import between_dates, days, half_even, pearson, planar_km, ratio, slot_label, slot_start
from ..settings import CAMERA, DEFAULT, KEYS, SLOTS_A_DAY, Settings
from .slots import COUNT, LOAD, slot_table, with_hourly, with_workday

Dates = str | None


def slots(records: DataFrame, dates: DataFrame, start: Dates = None, end: Dates = None, settings: Settings = DEFAULT) -> DataFrame:
    """Direction-slots with ``count`` as published. A period is taken before slots are made; give it to ``local_records``
    too, which cuts the scan by the dates as published."""
    s = with_hourly(with_workday(between_dates(slot_table(records), start, end), dates), settings)
    return s.select(*KEYS, "date", "slot", slot_start(F.col("date"), F.col("slot")).alias("time"), "workday", "records", F.col("raw").alias("count"), "hourly_binned")


def meta(records: DataFrame, sites: DataFrame, counters: DataFrame, directions: DataFrame) -> dict[str, DataFrame]:
    """The sites and counters that have data, and the directions with their first and last date."""
    span = slot_table(records).groupBy(*KEYS).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return {
        "sites": sites.join(span.select("SITE_SK"), "SITE_SK", "left_semi"),
        "counters": counters.join(span.select("COUNTER_SK"), "COUNTER_SK", "left_semi"),
        "directions": span.join(directions, "DIRECTION_SK", "left"),
    }


def raw(records: DataFrame, start: Dates = None, end: Dates = None) -> DataFrame:
    """Records as published, with the label of their slot."""
    return between_dates(records, start, end).withColumn("slot_label", slot_label(F.col("slot")))


def daily(s: DataFrame) -> DataFrame:
    """Per direction and day: total, slots, records a slot, odd and non-zero slots, weekday."""
    d = s.groupBy(*KEYS, "date").agg(
        F.sum("count").alias("count"), F.count("*").alias("slots"), half_even(F.avg("records"), 2).alias("records_per_slot"),
        F.count_if(F.col("count") % 2 == 1).alias("odd_slots"), F.count_if(F.col("count") > 0).alias("nonzero_slots"),
    )
    return d.withColumn("weekday", F.date_format("date", "E"))


def daily_wide(s: DataFrame, directions: list[int]) -> DataFrame:
    """A column of daily totals for each of ``directions``; naming them keeps the schema stable and saves a pass."""
    return daily(s).groupBy("date", "weekday").pivot("DIRECTION_SK", directions).agg(F.first("count"))


def weekly(s: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per direction and week: total, complete days, share of the week's slots with data."""
    w = daily(s).groupBy(*KEYS, F.trunc("date", "week").alias("week"))
    return w.agg(F.sum("count").alias("count"), F.count_if(F.col("slots") >= settings.complete_slots).alias("complete_days"), half_even(F.sum("slots") / float(7 * SLOTS_A_DAY), 3).alias("slot_share"))


def weekly_wide(s: DataFrame, directions: list[int]) -> DataFrame:
    return weekly(s).groupBy("week").pivot("DIRECTION_SK", directions).agg(F.first("count"))


def monthly(s: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Mean of the complete days of each direction and month."""
    d = daily(s).where(F.col("slots") >= settings.complete_slots)
    return d.groupBy(*KEYS, F.trunc("date", "month").alias("month")).agg(half_even(F.avg("count")).alias("per_day"), F.count("*").alias("days"))


def overview(s: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    complete = F.col("slots") >= settings.complete_slots
    return daily(s).groupBy(*KEYS, F.trunc("date", "month").alias("month")).agg(
        F.count("*").alias("days"), F.count_if(complete).alias("complete_days"),
        half_even(F.avg(F.when(complete, F.col("count")))).alias("per_day"), half_even(F.avg("records_per_slot"), 2).alias("records_per_slot"),
    )


def hourly(s: DataFrame, workday: bool = True) -> DataFrame:
    """Mean a day for each hour and direction, a column each hour."""
    c = s.where(F.col("workday") == workday)
    n = c.groupBy("DIRECTION_SK").agg(F.count_distinct("date").alias("days"))
    h = c.withColumn("hour", F.hour("time")).groupBy("DIRECTION_SK").pivot("hour", list(range(24))).agg(F.sum("count"))
    return h.join(n, "DIRECTION_SK").select("DIRECTION_SK", *(half_even(F.col(f"`{k}`") / F.col("days"), 1).alias(str(k)) for k in range(24)), "days")


def channels(records: DataFrame, start: Dates = None, end: Dates = None) -> DataFrame:
    """The records behind each slot in the order of their IDs (collected with them: a list keeps no order by itself)."""
    r = raw(records, start, end)
    rows = F.sort_array(F.collect_list(F.struct("ID", F.col(COUNT).alias("n"), "Status")))
    out = r.groupBy("DIRECTION_SK", "date", "slot", "slot_label").agg(rows.alias("r"), F.sort_array(F.collect_set(LOAD)).alias("loaded"))
    return out.select("DIRECTION_SK", "date", "slot", "slot_label", F.col("r.n").alias("records"), F.col("r.Status").alias("status"), F.col("r.ID").alias("ids"), "loaded")


def neighbours(records: DataFrame, sites: DataFrame, counters: DataFrame, site: int, km: float = 3.0, cameras: bool = False) -> DataFrame:
    """Sites within ``km``, with their counters' first and last dates. The distance is rounded before it is compared."""
    at = sites.select(F.col("SITE_SK").cast("smallint").alias("SITE_SK"), "Site name", F.col("Site latitude").cast("double").alias("lat"), F.col("Site longitude").cast("double").alias("lon"))
    me = at.where(F.col("SITE_SK") == site).select(F.col("lat").alias("lat0"), F.col("lon").alias("lon0")).limit(1)
    near = at.where(F.col("SITE_SK") != site).crossJoin(F.broadcast(me)).withColumn("km", planar_km(F.col("lat"), F.col("lon"), F.col("lat0"), F.col("lon0"))).where(F.col("km") <= km)
    span = records.groupBy("SITE_SK", "COUNTER_SK").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    out = near.select("SITE_SK", "Site name", "km").join(span, "SITE_SK").join(counters.select("COUNTER_SK", "Technology"), "COUNTER_SK", "left")
    return out if cameras else out.where(F.col("Technology") != CAMERA)


def compare(s: DataFrame, site: int, others: list[int], by: str = "week", settings: Settings = DEFAULT) -> DataFrame:
    """Bikes of a site and of others, per day (null where any direction's day is incomplete) or per week over the days
    on which all are complete, and the ratio of the site to each other."""
    ids = [site, *others]
    d = daily(s.where(F.col("SITE_SK").isin(*ids)))
    day = d.groupBy("SITE_SK", "date").agg(F.when(F.bool_and(F.col("slots") >= settings.complete_slots), F.sum("count")).alias("bikes"))
    wide = day.groupBy("date").pivot("SITE_SK", ids).agg(F.first("bikes"))
    names = [str(i) for i in ids]
    if by == "week":
        wide = wide.na.drop(subset=names).groupBy(F.trunc("date", "week").alias("week")).agg(*(F.sum(F.col(f"`{n}`")).alias(n) for n in names), F.count("*").alias("days"))
    first = [c for c in wide.columns if c not in names]
    return wide.select(*first, *(F.col(f"`{n}`") for n in names), *(half_even(ratio(F.col(f"`{site}`"), F.col(f"`{o}`")), 3).alias(f"ratio_{o}") for o in names[1:]))


def directions(s: DataFrame, by: str = "week") -> DataFrame:
    """For each pair of directions of a site and each week or day: bikes, ratio, correlation, share of equal slots, and
    how often one counts at least what the other does."""
    side = lambda d, c: s.select("SITE_SK", "date", "time", F.col("DIRECTION_SK").alias(d), F.col("count").alias(c))
    j = side("a", "ca").join(side("b", "cb"), ["SITE_SK", "date", "time"]).where("a < b")
    some, when = (F.col("ca") > 0) | (F.col("cb") > 0), F.trunc("date", "week").alias("week") if by == "week" else F.col("date")
    return j.groupBy("SITE_SK", "a", "b", when).agg(
        F.sum("ca").alias("bikes_a"), F.sum("cb").alias("bikes_b"), half_even(ratio(F.sum("ca"), F.sum("cb")), 3).alias("ratio"),
        half_even(pearson(F.col("ca"), F.col("cb")), 3).alias("corr"),
        half_even(ratio(F.count_if((F.col("ca") == F.col("cb")) & some), F.count_if(some)), 3).alias("equal"),
        half_even(F.avg(F.when(F.col("cb") > 0, (F.col("ca") >= F.col("cb")).cast("int"))), 3).alias("a_covers_b"),
        half_even(F.avg(F.when(F.col("ca") > 0, (F.col("cb") >= F.col("ca")).cast("int"))), 3).alias("b_covers_a"),
    )


WAYS = ("IN", "NA", "NONE", "OUT")


def counter_days(s: DataFrame, directions: DataFrame, ways: tuple[str, ...] = WAYS) -> DataFrame:
    """Per counter and day: directions, slots and bikes, and bikes by the directions' label (NA: without one)."""
    label = directions.select("DIRECTION_SK", F.coalesce("Location in/out", F.lit("NA")).alias("way"))
    j = s.join(label, "DIRECTION_SK", "left")
    sums = [F.sum(F.when(F.col("way") == w, F.col("count"))).alias(w) for w in ways]
    return j.groupBy("COUNTER_SK", "date").agg(F.count_distinct("DIRECTION_SK").alias("directions"), F.count("*").alias("slots"), F.sum("count").alias("bikes"), *sums)


def network(records: DataFrame, start: Dates = None, end: Dates = None) -> DataFrame:
    """Per day over all sites: sites with data, at 0, with a warning, and bikes. Dates are as published."""
    day = between_dates(records, start, end).groupBy("SITE_SK", "date").agg(F.sum(F.col(COUNT).cast("long")).alias("bikes"), F.bool_or(F.col("Status") == 1).alias("warning"))
    return day.groupBy("date").agg(F.count("*").alias("sites"), F.count_if(F.col("bikes") == 0).alias("zero_sites"), F.count_if("warning").alias("warning_sites"), F.sum("bikes").alias("bikes"))


def calendar(dates: DataFrame, start: Dates = None, end: Dates = None) -> DataFrame:
    return between_dates(dates.select(F.substring("Date", 1, 10).cast("date").alias("date"), "Day type", "Public holiday", "School holiday"), start, end)


def weather(daily_weather: DataFrame, start: Dates = None, end: Dates = None) -> DataFrame:
    """Rain of a day is what the next morning reports."""
    rain = daily_weather.select((F.col("date") - days(1)).cast("date").alias("date"), F.col("rain_mm_to_9am").alias("rain_mm"))
    return between_dates(daily_weather.join(rain, "date", "left").select("date", "rain_mm", "max_temp_c"), start, end)


def events(listed: DataFrame) -> DataFrame:
    """The list of events, with its sites as an array too."""
    return listed.withColumn("site_list", F.transform(F.split("sites", ";"), lambda x: F.try_to_number(F.trim(x), F.lit("999999")).cast("int")))


def group_sites(groups: DataFrame, group: str) -> DataFrame:
    return groups.where(F.col("review_group") == group).select("SITE_SK")

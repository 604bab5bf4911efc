"""From published records to direction-slots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.columns import between_dates, days, must, slot_of, slot_start
from ..functions.lineage import cut
from ..settings import DEFAULT, KEYS, WORKDAY_TYPE, Settings

LOAD = "ADDED_UPDATED_DATETIME_SYDNEY"
COUNT = "TOTAL_15MIN_COUNT"
#: The largest sum and number of records of a slot that the results have room for.
MOST_RAW, MOST_RECORDS = 65535, 255


def local_records(raw: DataFrame, counters: DataFrame, settings: Settings = DEFAULT, start: str | None = None, end: str | None = None) -> DataFrame:
    """Records with the slots of vendors that publish UTC moved to local time, date and slot both. Where clocks go back
    two UTC slots fall on one local slot. A period is one of local dates: the scan is cut to it and a day on either side,
    by the dates as published, and the rest after the shift."""
    if start:
        raw = raw.where(F.col("date") >= F.date_sub(F.lit(start).cast("date"), 1))
    if end:
        raw = raw.where(F.col("date") <= F.date_add(F.lit(end).cast("date"), 1))
    utc = counters.where(F.col("Vendor name").isin(*settings.utc_vendors)).select("COUNTER_SK", F.lit(True).alias("_utc")).distinct()
    local = F.convert_timezone(F.lit("UTC"), F.lit(settings.zone), slot_start(F.col("date"), F.col("slot")))
    out = raw.join(utc, "COUNTER_SK", "left").withColumn("_local", F.when(F.col("_utc"), local))
    moved = out.withColumns({"date": F.coalesce(F.to_date("_local"), "date"), "slot": F.coalesce(slot_of(F.col("_local")), "slot")})
    return between_dates(moved.select(*raw.columns), start, end)


def slot_table(records: DataFrame, latest: bool = False) -> DataFrame:
    """A row for each direction-slot: ``raw``, the sum over all loads; ``records`` and ``load`` of the load that counted
    most, the earlier of two alike. ``latest`` adds the slot's last load of any.

    One exchange serves both aggregations, and what follows by direction and day: a direction-day has 96 slots at most,
    so none is hot, and a slot rarely has enough records for a combine before the exchange to pay."""
    dealt = records.select(*KEYS, "date", "slot", F.col(LOAD).alias("load"), F.col(COUNT).cast("long").alias("n")).repartition("DIRECTION_SK", "date")
    per_load = dealt.groupBy(*KEYS, "date", "slot", "load").agg(F.sum("n").alias("n"), F.count("*").alias("records"))
    out = slots_of(per_load)
    return out if latest else out.drop("latest")


def slots_of(per_load: DataFrame) -> DataFrame:
    """Slots from the sums (n) and numbers of records of each load. Sums and numbers that are out of range are an error."""
    main = F.min_by(F.struct("records", "load"), F.struct((-F.col("n")).alias("n"), F.col("load")))
    out = per_load.groupBy(*KEYS, "date", "slot").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw"), main.alias("main"), F.max("load").alias("latest"))
    out = must(out, (F.col("raw") <= MOST_RAW) & (F.col("main.records") <= MOST_RECORDS), F.concat(F.lit("raw count or number of records out of range: "), F.col("raw").cast("string"), F.lit(", "), F.col("main.records").cast("string")))
    return out.select(*KEYS, "date", "slot", F.col("raw").cast("int").alias("raw"), F.col("main.records").cast("smallint").alias("records"), F.col("main.load").alias("load"), "latest")


def usual_records(slots: DataFrame) -> DataFrame:
    """(DIRECTION_SK, month, usual): the most common of the days' most common numbers of records, the smallest of ties."""
    day = slots.groupBy("DIRECTION_SK", "date").agg(F.mode("records", True).alias("m"))
    return day.groupBy("DIRECTION_SK", F.trunc("date", "month").alias("month")).agg(F.mode("m", True).alias("usual"))


def repeated_values(slots: DataFrame, records: DataFrame) -> DataFrame:
    """Slots with more records than usual in their month: the count without the extra records that repeat others
    (``dedup``), what that drops, and whether every extra record repeats one (``matched``). Only the main load counts.

    Equal values pair up, and pairs are dropped from the highest value down until the extra records are used up; how many
    pairs are above a value is a running sum over the few values of a slot."""
    place = ["DIRECTION_SK", "date", "slot"]
    crowded = slots.withColumn("month", F.trunc("date", "month")).join(usual_records(slots), ["DIRECTION_SK", "month"]).where("records > usual")
    loaded = records.select(*place, F.col(LOAD).alias("load"), F.col(COUNT).cast("long").alias("value"))
    # dealt by slot at once, which serves the counts, the running sums and the totals
    extra = loaded.join(crowded.select(*place, "load", "usual"), [*place, "load"]).repartition(*place)
    times = extra.groupBy(*place, "usual", "value").agg(F.count("*").alias("times"))
    of_slot = Window.partitionBy(*place)
    pairs = F.floor(F.col("times") / 2)
    above = F.coalesce(F.sum(pairs).over(of_slot.orderBy(F.col("value").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = times.withColumns({"pairs": pairs, "above": above, "excess": F.sum("times").over(of_slot) - F.col("usual")})
    gone = F.sum(F.greatest(F.least("pairs", F.col("excess") - F.col("above")), F.lit(0)) * F.col("value"))
    kept = F.sum(F.col("value") * F.col("times")) - gone
    return ranked.groupBy(*place).agg(kept.alias("dedup"), gone.alias("dropped"), (F.sum("pairs") >= F.first("excess")).alias("matched"))


def with_hourly(slots: DataFrame, settings: Settings = DEFAULT, slot: str = "slot", raw: str = "raw") -> DataFrame:
    """Adds whether the direction-day has its non-zero slots, enough of them, all on one quarter of the hour."""
    w = Window.partitionBy("DIRECTION_SK", "date")
    some = F.when(F.col(raw) > 0, F.col(slot) % 4)
    enough = F.count(some).over(w) >= settings.hourly_min_nonzero
    return slots.withColumn("hourly_binned", enough & F.coalesce(F.min(some).over(w) == F.max(some).over(w), F.lit(False)))


def with_workday(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Adds ``workday`` from the calendar, or Monday to Friday where it has no row."""
    known = dates.select(F.substring("Date", 1, 10).cast("date").alias("date"), (F.col("Day type") == WORKDAY_TYPE).alias("workday"))
    return df.join(known, "date", "left").withColumn("workday", F.coalesce("workday", F.weekday("date") < 5))


def review_groups(records: DataFrame) -> DataFrame:
    """(SITE_SK, review_group): sites that share counters, directly or through others, named after the lowest site.
    Labels flow from sites to counters and back, then jump to the label of their label, until none changes: a table a
    round, whose writing tells how many changed."""
    pairs = cut(records.select("SITE_SK", "COUNTER_SK").distinct())
    label = pairs.select("SITE_SK", F.col("SITE_SK").alias("low")).distinct()
    while True:
        counter = pairs.join(label, "SITE_SK").groupBy("COUNTER_SK").agg(F.min("low").alias("low"))
        near = pairs.join(counter, "COUNTER_SK").groupBy("SITE_SK").agg(F.min("low").alias("near"))
        jump = near.join(label.select(F.col("SITE_SK").alias("near"), F.col("low").alias("far")), "near", "left")
        new = label.join(jump, "SITE_SK").select("SITE_SK", F.col("low").alias("was"), F.least("low", "near", "far").alias("low"))
        seen = Observation()
        label = cut(new.observe(seen, F.count_if(F.col("low") < F.col("was")).alias("changed"))).drop("was")
        if not seen.get["changed"]:
            return label.select("SITE_SK", F.concat(F.lit("G"), F.lpad(F.col("low").cast("string"), 4, "0")).alias("review_group"))

"""Audits across groups: profiles, rolling levels, outages, replacement steps, feed-wide patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import half_even, minutes, ratio, slot_of, with_run
from ..settings import DEFAULT, KEYS, Settings
from .slots import usual_records, with_workday

QUARTER = 15


def flat_decisions(verdicts: DataFrame) -> DataFrame:
    """Every decision of every verdict with its place in the list and whether it was rejected."""
    d = verdicts.select("group", F.posexplode("decisions").alias("i", "d")).select("group", "i", "d.*")
    return d.withColumn("rejected", F.coalesce("rejected", F.lit(False)))


def direction_days(s: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Profile of each direction-day: bikes, slots, zero, non-zero and odd ones, night (before 05:00), 07-19h, highest;
    with the records also whether any has a warning."""
    n, slot = F.col("count"), F.col("slot")
    days_ = s.groupBy(*KEYS, "date").agg(
        F.sum(n).alias("bikes"), F.count("*").alias("slots"), F.count_if(n == 0).alias("zero_slots"), F.count_if(n > 0).alias("nonzero_slots"), F.count_if(n % 2 == 1).alias("odd_slots"),
        F.sum(F.when(slot < 20, n).otherwise(0)).alias("night"), F.sum(F.when(slot.between(28, 75), n).otherwise(0)).alias("day7_19"), F.max(n).alias("max_slot"),
    )
    if records is None:
        return days_
    warned = records.groupBy(*KEYS, "date").agg(F.coalesce(F.bool_or(F.col("Status") == 1), F.lit(False)).alias("warn"))
    return days_.join(warned, [*KEYS, "date"], "left")


def counter_slots(s: DataFrame, directions: DataFrame) -> DataFrame:
    """Totals of a counter's slots, and those of its directions labelled in and out."""
    j = s.join(directions.select("DIRECTION_SK", F.col("Location in/out").alias("way")), "DIRECTION_SK", "left")
    part = lambda w: F.sum(F.when(F.col("way") == w, F.col("count")).otherwise(0)).alias(f"n_{w.lower()}")
    return j.groupBy("COUNTER_SK", "date", "slot", "time").agg(F.sum("count").alias("bikes"), F.count_distinct("DIRECTION_SK").alias("directions"), part("IN"), part("OUT"))


def rolling_level(s: DataFrame, reach: int = 14, least: int = 10) -> DataFrame:
    """Per counter and every day of its span: bikes (0 where absent), the centred rolling median, and the ratio."""
    day = s.groupBy("COUNTER_SK", "date").agg(F.sum("count").alias("bikes"))
    span = day.groupBy("COUNTER_SK").agg(F.min("date").alias("a"), F.max("date").alias("b")).select("COUNTER_SK", F.explode(F.sequence("a", "b")).alias("date"))
    full = span.join(day, ["COUNTER_SK", "date"], "left").withColumn("bikes", F.coalesce("bikes", F.lit(0)))
    w = Window.partitionBy("COUNTER_SK").orderBy("date").rowsBetween(-reach, reach)
    med = F.when(F.count("*").over(w) >= least, F.percentile(F.col("bikes"), F.lit(0.5)).over(w))
    return full.withColumn("med", med).withColumn("rel", half_even(ratio(F.col("bikes"), F.col("med")), 3))


def outage_runs(s: DataFrame, dates: DataFrame, least: float = 15) -> DataFrame:
    """Runs of absent or zero slots of a counter over its whole span of time, worth ``least`` usual bikes, and the share
    of absent ones."""
    c = s.groupBy("COUNTER_SK", "date", "slot", "time", "workday").agg(F.sum("count").alias("bikes"))
    usual = c.groupBy("COUNTER_SK", "workday", "slot").agg(F.median("bikes").alias("usual"))
    grid = c.groupBy("COUNTER_SK").agg(F.min("time").alias("a"), F.max("time").alias("b")).select("COUNTER_SK", F.explode(F.sequence("a", "b", minutes(QUARTER))).alias("time"))
    g = grid.join(c.select("COUNTER_SK", "time", "bikes"), ["COUNTER_SK", "time"], "left").withColumns({"date": F.to_date("time"), "slot": slot_of(F.col("time"))})
    g = with_workday(g, dates).join(usual, ["COUNTER_SK", "workday", "slot"], "left")
    z = with_run(g.where(F.coalesce("bikes", F.lit(0)) == 0), ["COUNTER_SK"], "time", minutes(QUARTER))
    out = z.groupBy("COUNTER_SK", "run").agg(F.min("time").alias("start"), F.max("time").alias("end"), (F.count("*") / 4).alias("hours"), F.coalesce(F.sum("usual"), F.lit(0.0)).alias("usual_bikes"), half_even(F.avg(F.col("bikes").isNull().cast("int")), 2).alias("absent"))
    return out.where(F.col("usual_bikes") >= least).drop("run")


def period_levels(s: DataFrame, period: str = "month", least: int = 8, settings: Settings = DEFAULT) -> DataFrame:
    """Median of the complete workdays of a counter at a site, for each period with ``least`` of them."""
    day = s.groupBy(*KEYS, "date", "workday").agg(F.sum("count").alias("bikes"), F.count_distinct("slot").alias("slots")).where(F.col("workday") & (F.col("slots") >= settings.complete_slots))
    site = day.groupBy("SITE_SK", "COUNTER_SK", "date").agg(F.sum("bikes").alias("bikes")).where("bikes > 0")
    return site.groupBy("SITE_SK", "COUNTER_SK", F.trunc("date", period).alias("period")).agg(F.median("bikes").alias("v"), F.count("*").alias("n")).where(F.col("n") >= least)


def replacement_step(levels: DataFrame, cases: DataFrame, controls: DataFrame) -> DataFrame:
    """For each case (SITE_SK, old_counter, new_counter, period, before): the ratio of the new unit's level to the old
    one's ``before``, against the geometric mean of the same ratio at the control units (SITE_SK, COUNTER_SK). Periods
    for which a control is missing are left out."""
    lv = levels.select("SITE_SK", "COUNTER_SK", "period", "v")
    new = lv.select("SITE_SK", F.col("COUNTER_SK").alias("new_counter"), "period", F.col("v").alias("a"))
    old = lv.select("SITE_SK", F.col("COUNTER_SK").alias("old_counter"), F.col("period").alias("before"), F.col("v").alias("b"))
    site = cases.join(new, ["SITE_SK", "new_counter", "period"]).join(old, ["SITE_SK", "old_counter", "before"])
    times = cases.select("period", "before").distinct()
    unit = controls.join(lv, ["SITE_SK", "COUNTER_SK"])
    c = times.join(unit.select("SITE_SK", "COUNTER_SK", "period", F.col("v").alias("x")), "period").join(unit.select("SITE_SK", "COUNTER_SK", F.col("period").alias("before"), F.col("v").alias("y")), ["SITE_SK", "COUNTER_SK", "before"])
    c = c.groupBy("period", "before").agg(F.exp(F.avg(F.ln(F.col("x") / F.col("y")))).alias("control"), F.count("*").alias("n")).join(controls.agg(F.count("*").alias("all")), F.col("n") == F.col("all"))
    j = site.join(c, ["period", "before"]).withColumn("r", F.col("a") / F.col("b"))
    return j.groupBy("SITE_SK").agg(
        F.count("*").alias("periods"), half_even(F.median("r"), 3).alias("site_ratio"), half_even(F.median("control"), 3).alias("control_ratio"),
        half_even(F.median(F.col("r") / F.col("control")), 3).alias("step"), half_even(F.min(F.col("r") / F.col("control")), 3).alias("low"), half_even(F.max(F.col("r") / F.col("control")), 3).alias("high"),
    )


def overlap_ratio(s: DataFrame, site: int, old: int, new: int, settings: Settings = DEFAULT) -> DataFrame:
    """New over old unit of a site, over the days that both have in full."""
    day = s.where((F.col("SITE_SK") == site) & F.col("COUNTER_SK").isin(old, new)).groupBy(*KEYS, "date").agg(F.sum("count").alias("bikes"), F.count("*").alias("slots")).where(F.col("slots") >= settings.complete_slots)
    both = day.groupBy("date").agg(F.sum(F.when(F.col("COUNTER_SK") == old, F.col("bikes"))).alias("o"), F.sum(F.when(F.col("COUNTER_SK") == new, F.col("bikes"))).alias("n")).where("o is not null and n is not null")
    return both.agg(F.count("*").alias("days"), F.sum("o").alias("old_bikes"), F.sum("n").alias("new_bikes")).withColumn("ratio", half_even(ratio(F.col("new_bikes"), F.col("old_bikes")), 3))


def feed_days(s: DataFrame, counters: DataFrame, least_nonzero: int = 5) -> DataFrame:
    """Per date and vendor: direction-days, all-even ones, ones at 0, and ones with a quarter more records than usual."""
    usual = usual_records(s)
    d = s.groupBy(*KEYS, "date").agg(F.sum("count").alias("bikes"), F.count_if(F.col("count") > 0).alias("nz"), F.count_if(F.col("count") % 2 == 1).alias("odd"), F.avg("records").alias("records")).withColumn("month", F.trunc("date", "month"))
    d = d.join(usual, ["DIRECTION_SK", "month"]).join(counters.select("COUNTER_SK", F.col("Vendor name").alias("vendor")), "COUNTER_SK", "left")
    return d.groupBy("date", "vendor").agg(
        F.count("*").alias("direction_days"), F.count_if((F.col("odd") == 0) & (F.col("nz") >= least_nonzero)).alias("even_days"),
        F.count_if(F.col("bikes") == 0).alias("zero_days"), F.count_if(F.col("records") >= 1.25 * F.col("usual")).alias("record_days"),
    )


def feed_patterns(s: DataFrame, counters: DataFrame, least_nonzero: int = 12, least_usual: float = 10, least_hours: int = 12) -> DataFrame:
    """Per date, vendor and pattern the number of places that show it: ``even``: direction-days with all counts even and
    enough of them not 0, between a day before and a day after with odd ones; ``zero``: counters without a bike on a day
    of a weekday on which they usually have some; ``covers``: directions that count at least what another of their
    counter and site does in every hour that both have, in enough of them, and not nothing."""
    n = F.col("count")
    w = Window.partitionBy("DIRECTION_SK").orderBy("date")
    day = s.groupBy(*KEYS, "date").agg(F.count_if(n > 0).alias("nz"), F.count_if(n % 2 == 1).alias("odd"))
    near = (F.lag("odd").over(w) > 0) & (F.lead("odd").over(w) > 0) & (F.lag("date").over(w) == F.date_sub("date", 1)) & (F.lead("date").over(w) == F.date_add("date", 1))
    even = day.withColumn("near", near).where((F.col("odd") == 0) & (F.col("nz") >= least_nonzero) & F.col("near")).select("COUNTER_SK", "date", F.lit("even").alias("pattern"))
    whole = s.groupBy("COUNTER_SK", "date").agg(F.sum(n).alias("bikes")).withColumn("weekday", F.weekday("date"))
    usual = whole.groupBy("COUNTER_SK", "weekday").agg(F.median("bikes").alias("usual"))
    zero = whole.where("bikes = 0").join(usual, ["COUNTER_SK", "weekday"]).where(F.col("usual") >= least_usual).select("COUNTER_SK", "date", F.lit("zero").alias("pattern"))
    hour = s.groupBy(*KEYS, "date", F.floor(F.col("slot") / 4).alias("hour")).agg(F.sum(n).alias("n"))
    side = lambda d, x: hour.select("SITE_SK", "COUNTER_SK", "date", "hour", F.col("DIRECTION_SK").alias(d), F.col("n").alias(x))
    both = side("a", "na").join(side("b", "nb"), ["SITE_SK", "COUNTER_SK", "date", "hour"]).where("a <> b").groupBy("SITE_SK", "COUNTER_SK", "date", "a", "b")
    covers = both.agg(F.count("*").alias("hours"), F.bool_and(F.col("na") >= F.col("nb")).alias("all"), F.sum("nb").alias("other")).where(F.col("all") & (F.col("hours") >= least_hours) & (F.col("other") > 0))
    found = even.unionByName(zero).unionByName(covers.select("COUNTER_SK", "date", F.lit("covers").alias("pattern")))
    vendor = counters.select("COUNTER_SK", F.col("Vendor name").alias("vendor"))
    return found.join(vendor, "COUNTER_SK", "left").groupBy("date", "vendor", "pattern").agg(F.count("*").alias("places"))


def am_share(s: DataFrame) -> DataFrame:
    """Weekly share of the workday morning (06-09h) in morning and afternoon (16-19h), and its change on the week before."""
    h = F.hour("time")
    part = lambda a, b: F.sum(F.when(h.between(a, b), F.col("count")).otherwise(0))
    w = s.where("workday").groupBy(*KEYS, F.trunc("date", "week").alias("week")).agg(part(6, 8).alias("am"), part(16, 18).alias("pm")).where("am + pm > 0")
    w = w.withColumn("share", half_even(F.col("am") / F.greatest(F.col("am") + F.col("pm"), F.lit(1)), 3))
    return w.withColumn("change", half_even(F.col("share") - F.lag("share").over(Window.partitionBy(*KEYS).orderBy("week")), 3))


def steps(s: DataFrame, reach: int = 21, least: int = 5) -> DataFrame:
    """Per counter and workday: the median of the workdays within ``reach`` days from it on, over that of those before."""
    day = s.where("workday").groupBy("COUNTER_SK", "date").agg(F.sum("count").alias("bikes")).withColumn("k", F.unix_date("date"))
    w = Window.partitionBy("COUNTER_SK").orderBy("k")
    before, after = w.rangeBetween(-reach, -1), w.rangeBetween(0, reach - 1)
    med = lambda x: F.when(F.count("*").over(x) >= least, F.percentile(F.col("bikes"), F.lit(0.5)).over(x))
    out = day.withColumns({"before": med(before), "after": med(after)}).where("before is not null and after is not null")
    return out.select("COUNTER_SK", "date", "before", "after", half_even(ratio(F.col("after"), F.col("before")), 3).alias("step"))


def uncovered(runs: DataFrame, decisions: DataFrame, action: str = "missing", least: float = 15) -> DataFrame:
    """Detected runs worth ``least`` usual bikes that no decision of the action spans."""
    d = decisions.where(F.col("action") == action).select(F.col("DIRECTION_SK").alias("d_dir"), F.col("SITE_SK").alias("d_site"), F.col("start").alias("d_start"), F.coalesce("end", F.expr("timestamp_ntz'9999-12-31 23:45:00'")).alias("d_end"))
    same = (F.col("SITE_SK") == F.col("d_site")) & (F.col("d_dir").isNull() | (F.col("DIRECTION_SK") == F.col("d_dir")))
    return runs.where(F.col("usual_bikes") >= least).join(d, same & (F.col("d_start") <= F.col("start")) & (F.col("d_end") >= F.col("end")), "left_anti")


def local_lows(s: DataFrame, low: float = 0.35, network: float = 0.6) -> DataFrame:
    """Site-days under ``low`` of the site's median day of its kind while the network is above ``network`` of its own."""
    site = s.groupBy("SITE_SK", "date", "workday").agg(F.sum("count").alias("bikes"))
    rel = lambda d, by: d.join(d.groupBy(*by, "workday").agg(F.median("bikes").alias("usual")), [*by, "workday"])
    one = rel(site, ["SITE_SK"]).withColumn("rel", ratio(F.col("bikes"), F.col("usual")))
    whole = site.groupBy("date", "workday").agg(F.sum("bikes").alias("bikes"))
    usual = whole.groupBy("workday").agg(F.median("bikes").alias("usual"))
    all_ = whole.join(usual, "workday").select("date", ratio(F.col("bikes"), F.col("usual")).alias("network"))
    out = one.join(all_, "date").where((F.col("rel") < low) & (F.col("network") > network))
    return out.select("SITE_SK", "date", "bikes", half_even(F.col("rel"), 3).alias("rel"), half_even(F.col("network"), 3).alias("network"))


def duplicate_days(s: DataFrame, times: float = 1.8, least: int = 3, settings: Settings = DEFAULT) -> DataFrame:
    """Dates on which ``least`` counters have a full direction-day with ``times`` the usual records a slot."""
    d = s.groupBy(*KEYS, "date").agg(F.count("*").alias("slots"), F.avg("records").alias("records")).where(F.col("slots") >= settings.complete_slots).withColumn("month", F.trunc("date", "month"))
    hit = d.join(usual_records(s), ["DIRECTION_SK", "month"]).where(F.col("records") >= times * F.col("usual"))
    return hit.groupBy("date").agg(F.count_distinct("COUNTER_SK").alias("counters")).where(F.col("counters") >= least)


def shapes(s: DataFrame, directions: DataFrame, least_nonzero: int = 40, odd_share: float = 0.05, by: tuple[str, ...] = ("COUNTER_SK",)) -> DataFrame:
    """Per counter (or zone, by other keys) and month: shares of odd slots and of the hours 0-5, in over out, and whether odd slots are so few
    that counts look doubled."""
    j = s.join(directions.select("DIRECTION_SK", F.col("Location in/out").alias("way")), "DIRECTION_SK", "left")
    n = F.col("count")
    m = j.groupBy(*by, F.trunc("date", "month").alias("month")).agg(
        F.count_if(n > 0).alias("nz"), F.count_if(n % 2 == 1).alias("odd"), F.sum(n).alias("bikes"), F.sum(F.when(F.col("slot") < 20, n).otherwise(0)).alias("night"),
        F.sum(F.when(F.col("way") == "IN", n).otherwise(0)).alias("n_in"), F.sum(F.when(F.col("way") == "OUT", n).otherwise(0)).alias("n_out"),
    ).where(F.col("nz") >= least_nonzero)
    return m.select(*by, "month", "nz", half_even(F.col("odd") / F.greatest("nz", F.lit(1)), 3).alias("odd_share"), half_even(ratio(F.col("night"), F.col("bikes")), 3).alias("night_share"), half_even(ratio(F.col("n_in"), F.col("n_out")), 3).alias("in_out"), (F.col("odd") < odd_share * F.col("nz")).alias("looks_doubled"))

"""What a changed set of decisions does to the cleaned data, and flags for known mistakes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import half_even, ratio
from ..settings import CAMERA, DEFAULT, KEYS, NOTES, Settings
from .series import series_parts, weekly_series

# Actions whose disappearance is worth a look; words of a diagnosis that speak of a whole camera; how much of
# a diagnosis is shown.
WATCHED = ("scale", "direction_unreliable", "subtract_other", "drop_duplicates")
CAMERA_WIDE = ("camera", "counter-wide", "every zone", "all zones", "whole counter", "all sites", "every site")
SHOWN, SHOWN_TAIL = 120, 100
_FAR = "9999-12-31"


def live(decisions: DataFrame) -> DataFrame:
    return decisions.where(~F.coalesce(F.col("rejected"), F.lit(False))) if "rejected" in decisions.columns else decisions


def action_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """(version, action, decisions)."""
    one = lambda d, name: live(d).groupBy("action").agg(F.count("*").alias("decisions")).withColumn("version", F.lit(name))
    return one(old, "old").unionByName(one(new, "new")).select("version", "action", "decisions")


def listed(new: DataFrame) -> DataFrame:
    """The decisions that go on, and the scales by something else than a half."""
    d = live(new).withColumn("reason", F.when(F.col("end").isNull(), "ongoing").when((F.col("action") == "scale") & ~F.coalesce(F.col("factor") == 0.5, F.lit(False)), "factor"))
    return d.where("reason is not null").select("reason", "action", "SITE_SK", "DIRECTION_SK", "start", "end", "factor", _shown())


def _shown(most: int = SHOWN):
    return F.substring(F.coalesce("diagnosis", F.lit("")), 1, most).alias("diagnosis")


def sizes(old: DataFrame, new: DataFrame, old_parts: DataFrame, new_parts: DataFrame) -> DataFrame:
    """(version, decisions, series): how many each version has, rejected decisions too."""
    one = lambda d, p, name: d.agg(F.count("*").alias("decisions")).crossJoin(p.agg(F.count_distinct("SITE_SK", "series").alias("series"))).withColumn("version", F.lit(name))
    return one(old, old_parts, "old").unionByName(one(new, new_parts, "new")).select("version", "decisions", "series")


def fix_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(fix, old, new): slots that each action changed."""
    n = lambda f, name: f.where("fix is not null").groupBy("fix").agg(F.count("*").alias(name))
    return n(old, "old").join(n(new, "new"), "fix", "full").select("fix", F.coalesce("old", F.lit(0)).alias("old"), F.coalesce("new", F.lit(0)).alias("new"))


def totals(final: DataFrame, weeks: DataFrame) -> DataFrame:
    """One row: bikes at missing slots, series-weeks, bikes in them, full weeks."""
    a = final.agg(F.coalesce(F.sum(F.when(F.col("count").isNull(), F.col("raw"))), F.lit(0)).alias("missing_raw_bikes"))
    return a.crossJoin(weeks.agg(F.count("*").alias("series_weeks"), F.coalesce(F.sum("bikes"), F.lit(0)).alias("bikes"), F.count_if(F.col("complete_days") == 7).alias("full_weeks")))


def weekly_diff(old: DataFrame, new: DataFrame, directions: DataFrame, counters: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Counter-directions whose number of full weeks changed by 4, or whose weekly mean by 2 %, or that are new or gone."""
    none = new.sparkSession.createDataFrame([], "SITE_SK smallint, series string, COUNTER_SK smallint, DIRECTION_SK smallint, start date, end date")
    parts = series_parts(old, none, directions, counters)

    def full(f: DataFrame, weeks: str, mean: str) -> DataFrame:
        w = weekly_series(f, parts, settings).where("complete_days = 7")
        return w.groupBy("SITE_SK", "series").agg(F.count("*").alias(weeks), half_even(F.avg("bikes")).alias(mean))

    j = full(old, "weeks", "mean").join(full(new, "weeks_new", "mean_new"), ["SITE_SK", "series"], "full")
    j = j.withColumns({"d_weeks": F.coalesce("weeks_new", F.lit(0)) - F.coalesce("weeks", F.lit(0)), "mean_ratio": half_even(ratio(F.col("mean_new"), F.col("mean")), 3)})
    return j.where((F.abs("d_weeks") >= 4) | (F.abs(F.col("mean_ratio") - 1) >= 0.02) | F.col("mean_ratio").isNull())


def series_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(SITE_SK, series, state): series by their whole lists of parts: unchanged, only old or only new; ``joined``: a new
    one of several counter-directions."""
    def whole(p: DataFrame) -> DataFrame:
        part = F.struct("COUNTER_SK", "DIRECTION_SK", "start", "end")
        s = p.groupBy("SITE_SK", "series").agg(F.sort_array(F.collect_list(part)).alias("parts"), (F.count_distinct("COUNTER_SK", "DIRECTION_SK") > 1).alias("several"))
        return s.withColumn("key", F.to_json("parts"))

    o, n = whole(old), whole(new)
    seen = o.join(n, ["SITE_SK", "key"], "left_semi").select("SITE_SK", "series", F.lit("unchanged").alias("state"), F.lit(False).alias("joined"))
    gone = o.join(n, ["SITE_SK", "key"], "left_anti").select("SITE_SK", "series", F.lit("only old").alias("state"), F.lit(False).alias("joined"))
    added = n.join(o, ["SITE_SK", "key"], "left_anti").select("SITE_SK", "series", F.lit("only new").alias("state"), F.col("several").alias("joined"))
    return seen.unionByName(gone).unionByName(added)


def _day(c: str):
    return F.substring(F.coalesce(F.col(c), F.lit(_FAR)), 1, 10)


def flag_dropped(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old decisions of a watched action that no new one of the same action and site overlaps in days."""
    o = live(old).where(F.col("action").isin(*WATCHED)).withColumns({"o_start": _day("start"), "o_end": _day("end")})
    n = live(new).select("action", "SITE_SK", _day("start").alias("n_start"), _day("end").alias("n_end"))
    out = o.join(n, (o["action"] == n["action"]) & (o["SITE_SK"] == n["SITE_SK"]) & (n["n_start"] <= o["o_end"]) & (o["o_start"] <= n["n_end"]), "left_anti")
    return out.select("action", "SITE_SK", "DIRECTION_SK", "start", "end", _shown())


def flag_tail(new: DataFrame, slots: DataFrame, near_days: int = 3) -> DataFrame:
    """Decisions that end within days of the last date: perhaps they go on."""
    last = slots.agg(F.date_sub(F.max("date"), near_days).cast("string").alias("from_day"))
    d = live(new).where(~F.col("action").isin(*NOTES) & F.col("end").isNotNull()).crossJoin(F.broadcast(last))
    return d.where(_day("end") >= F.col("from_day")).select("action", "SITE_SK", "DIRECTION_SK", "start", "end", _shown(SHOWN_TAIL))


def flag_scope(new: DataFrame, slots: DataFrame) -> DataFrame:
    """Spans recorded as missing at some but not all sites of a counter: at several, or with words for a whole camera."""
    sites = slots.select("COUNTER_SK", "SITE_SK").distinct().groupBy("COUNTER_SK").agg(F.sort_array(F.collect_set("SITE_SK")).alias("sites")).where(F.size("sites") > 1)
    text = F.lower(F.concat_ws(" ", F.sort_array(F.collect_list("diagnosis"))))
    wide = live(new).groupBy("start", "end").agg(text.alias("text"), F.collect_set(F.when(F.col("action") == "missing", F.col("SITE_SK"))).alias("at")).where(F.size("at") > 0)
    member = wide.withColumn("SITE_SK", F.explode("at")).join(sites.withColumn("SITE_SK", F.explode("sites")), "SITE_SK")
    hit = member.groupBy("COUNTER_SK", "start", "end", "text", "sites").agg(F.sort_array(F.collect_set("SITE_SK")).alias("at"))
    speaks = F.col("text").rlike("|".join(CAMERA_WIDE))
    return hit.where((F.size("at") < F.size("sites")) & ((F.size("at") > 1) | speaks)).select("COUNTER_SK", "start", "end", F.concat_ws(",", "at").alias("at"), F.concat_ws(",", "sites").alias("sites"))


def flag_swap(slots: DataFrame, counters: DataFrame, min_total: int = 200, jump: float = 0.25) -> DataFrame:
    """Quarters in which the share of the workday morning peak in the first of a counter's two directions at a site
    crosses a half by more than ``jump`` against the last quarter with enough bikes. Cameras are left out."""
    cameras = counters.where(F.col("Technology") == CAMERA).select("COUNTER_SK")
    am = slots.where(F.col("workday") & F.hour("time").between(7, 8)).join(cameras, "COUNTER_SK", "left_anti")
    q = am.groupBy(*KEYS, F.trunc("date", "quarter").alias("q")).agg(F.sum("count").alias("am"))
    two = q.groupBy("SITE_SK", "COUNTER_SK").agg(F.count_distinct("DIRECTION_SK").alias("n"), F.min("DIRECTION_SK").alias("a")).where("n = 2").drop("n")
    w = q.join(two, ["SITE_SK", "COUNTER_SK"]).groupBy("SITE_SK", "COUNTER_SK", "a", "q").agg(F.sum(F.when(F.col("DIRECTION_SK") == F.col("a"), F.col("am"))).alias("x"), F.sum(F.when(F.col("DIRECTION_SK") != F.col("a"), F.col("am"))).alias("y"))
    w = w.where("x is not null and y is not null").where(F.col("x") + F.col("y") >= min_total).withColumn("share", F.col("x") / F.greatest(F.col("x") + F.col("y"), F.lit(1)))
    before = F.lag("share").over(Window.partitionBy("SITE_SK", "COUNTER_SK").orderBy("q"))
    w = w.withColumn("before", before).where("(before - 0.5) * (share - 0.5) < 0").where(F.abs(F.col("share") - F.col("before")) > jump)
    return w.select("SITE_SK", "COUNTER_SK", F.col("a").alias("DIRECTION_SK"), "q", half_even(F.col("before"), 2).alias("before"), half_even(F.col("share"), 2).alias("share"))


def swap_series(flips: DataFrame, parts: DataFrame) -> DataFrame:
    """For each place that ``flag_swap`` shows, all parts of the new series that use its counter; a row of nulls where none
    does, and each labelled direction is a series of its own."""
    use = parts.select(F.col("COUNTER_SK"), F.col("SITE_SK").alias("series_site"), "series").distinct()
    whole = parts.select(F.col("SITE_SK").alias("series_site"), "series", F.col("COUNTER_SK").alias("part_counter"), F.col("DIRECTION_SK").alias("part_direction"), "start", "end")
    return flips.select("SITE_SK", "COUNTER_SK").distinct().join(use, "COUNTER_SK", "left").join(whole, ["series_site", "series"], "left")


def zero_weeks(weeks: DataFrame, busy: float = 50) -> DataFrame:
    """Series with full weeks at 0 though the median full week is busy."""
    z = weeks.where("complete_days = 7").groupBy("SITE_SK", "series").agg(F.median("bikes").alias("median"), F.count_if(F.col("bikes") == 0).alias("zero_weeks"))
    return z.where((F.col("median") >= busy) & (F.col("zero_weeks") > 0))

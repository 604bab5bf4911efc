"""Decisions: interval-scoped edits of direction-slots, applied in a fixed order of actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import half_even, must, slot_start
from ..functions.lineage import cut
from ..settings import ACTIONS, KEYS, NOTES, SLOTS_A_DAY
from .slots import repeated_values


def decision_table(decisions: DataFrame) -> DataFrame:
    """The decisions that change data, with start and end as times: a date alone runs from its first slot, or to its
    last; an end that is null stays so. A row marked rejected is left out. An unknown action, or a scale without a
    positive factor, raises an error when rows are read."""
    d = decisions
    if "rejected" in d.columns:
        d = d.where(~F.coalesce(F.col("rejected"), F.lit(False)))
    known = F.col("action").isin(*ACTIONS, *NOTES)
    scaled = (F.col("action") != "scale") | F.coalesce(F.col("factor") > 0, F.lit(False))
    action = F.when(~F.coalesce(known, F.lit(False)), F.raise_error(F.concat(F.lit("unknown action: "), F.coalesce("action", F.lit("null"))))).when(~scaled, F.raise_error(F.lit("a scale decision has no positive factor"))).otherwise(F.col("action"))
    at = lambda c, clock: F.to_timestamp_ntz(F.when(F.char_length(c) == 10, F.concat(F.col(c), F.lit(clock))).otherwise(F.col(c)), F.lit("yyyy-MM-dd HH:mm"))
    out = d.select(F.col("SITE_SK").cast("smallint").alias("SITE_SK"), F.col("DIRECTION_SK").cast("smallint").alias("DIRECTION_SK"), at("start", " 00:00").alias("start"), at("end", " 23:45").alias("end"), action.alias("action"), F.col("factor").cast("double").alias("factor"))
    return out.where(F.col("action").isin(*ACTIONS))


def scoped(decisions: DataFrame, slots: DataFrame) -> DataFrame:
    """Decisions by counter and direction. One with a direction applies to it under any site but keeps its own; one
    without applies to every direction of its site. An open end is the far future: only slots of days on which the
    counter published can be met."""
    keys = slots.select(*KEYS).distinct()
    named = decisions.where("DIRECTION_SK is not null").join(keys.select("COUNTER_SK", "DIRECTION_SK").distinct(), "DIRECTION_SK")
    whole = decisions.where("DIRECTION_SK is null").drop("DIRECTION_SK").join(keys, "SITE_SK")
    return named.unionByName(whole).withColumn("end", F.coalesce("end", F.expr("timestamp_ntz'9999-12-31 23:45:00'")))


def filled_slots(scope: DataFrame, slots: DataFrame) -> DataFrame:
    """zero_fill: the absent slots in scope on days on which the counter published anything, with 0 and no records."""
    days = slots.select("COUNTER_SK", "date").distinct()
    fill = scope.where("action = 'zero_fill'").join(days, "COUNTER_SK").where((F.col("date") >= F.to_date("start")) & (F.col("date") <= F.to_date("end")))
    fill = fill.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS_A_DAY - 1)).cast("array<smallint>")))
    time = slot_start(F.col("date"), F.col("slot"))
    fill = fill.where((time >= F.col("start")) & (time <= F.col("end"))).select(*KEYS, "date", "slot").distinct()
    absent = fill.join(slots, ["DIRECTION_SK", "date", "slot"], "left_anti")
    return absent.select(*KEYS, "date", "slot", F.lit(0).alias("raw"), F.lit(0).cast("smallint").alias("records"), F.lit(None).cast("date").alias("load"))


def by_month(scope: DataFrame, slots: DataFrame) -> DataFrame:
    """Decisions with a row for each month that they touch, within the span of the slots."""
    span = F.broadcast(slots.agg(F.min("date").alias("first"), F.max("date").alias("last")))
    from_, to = F.trunc(F.greatest(F.to_date("start"), "first"), "month"), F.trunc(F.least(F.to_date("end"), "last"), "month")
    met = scope.crossJoin(span).where(from_ <= to)
    return met.withColumn("month", F.explode(F.sequence(from_, to, F.expr("interval 1 month")))).drop("first", "last")


def flags(months: DataFrame, slots: DataFrame) -> DataFrame:
    """(DIRECTION_SK, date, slot) with a flag for each action in force, and the factor. Two factors at one time are an error.
    Slots meet the decisions of their direction and month (see ``by_month``), and of these those whose interval they are
    in."""
    d = months.select("DIRECTION_SK", "month", "start", "end", "action", "factor")
    at = slots.select("DIRECTION_SK", "date", "slot", "time").distinct().withColumn("month", F.trunc("date", "month"))
    on = at.join(d, ["DIRECTION_SK", "month"]).where("time between start and end").groupBy("DIRECTION_SK", "date", "slot")
    on = on.agg(*(F.bool_or(F.col("action") == a).alias(f"_{a}") for a in ACTIONS[1:]), F.min("factor").alias("_factor"), F.max("factor").alias("_high"))
    clash = F.concat(F.lit("overlapping decisions disagree on the factor of direction "), F.col("DIRECTION_SK").cast("string"), F.lit(" on "), F.col("date").cast("string"))
    return must(on, F.col("_factor").eqNullSafe(F.col("_high")), clash).drop("_high")


def mark(slots: DataFrame, where: Column, fix: str, value: Column | None = None) -> DataFrame:
    """Where ``where`` holds and there is still a count: the count becomes ``value`` (missing by default), and the row
    notes why. Both columns are set from the state before."""
    hit = F.coalesce(where, F.lit(False)) & F.col("count").isNotNull()
    value = (F.lit(None) if value is None else value).cast("int")
    return slots.withColumns({"count": F.when(hit, value).otherwise(F.col("count")), "fix": F.when(hit, F.lit(fix)).otherwise(F.col("fix"))})


def apply(slots: DataFrame, decisions: DataFrame, records: DataFrame) -> DataFrame:
    """``slots`` with the decisions applied: adds ``time``, ``count`` (null: missing), ``fix`` and
    ``direction_unreliable``. Later actions overwrite the mark of earlier ones; what is missing stays missing.

    The filled table is written once: the flags, the usual numbers of records and the slots themselves read it. So are the
    flags, a row for each slot that a decision meets, with what its records repeat: writing them checks them, whatever is
    read of the result, and tells their size. What only some decisions need is made for these: repeated values for the
    months of directions with drop_duplicates, sums over a counter's directions for counters with subtract_other. Give
    ``slots`` as a table too (``lineage.cut``), as the scope of decisions and the filling read it several times."""
    place = ["DIRECTION_SK", "date", "slot"]
    scope = scoped(decisions, slots)
    months = cut(by_month(scope.where("action <> 'zero_fill'"), slots))
    slots = cut(slots.unionByName(filled_slots(scope, slots)).withColumn("time", slot_start(F.col("date"), F.col("slot"))))
    some = months.where("action = 'drop_duplicates'").select("DIRECTION_SK", "month").distinct()
    within = lambda df: df.withColumn("month", F.trunc("date", "month")).join(some, ["DIRECTION_SK", "month"], "left_semi").drop("month")
    dedup = repeated_values(within(slots), within(records)).select(*place, "dedup")
    on = cut(flags(months, slots).join(dedup, place, "left"))
    s = slots.withColumns({"count": F.col("raw"), "fix": F.lit(None).cast("string")}).join(on, place, "left")
    s = mark(s, F.col("_drop_duplicates") & F.col("dedup").isNotNull(), "drop_duplicates", F.col("dedup"))
    subtracted = months.where("action = 'subtract_other'").select("COUNTER_SK").distinct()
    all_ = s.join(subtracted, "COUNTER_SK", "left_semi").groupBy("SITE_SK", "COUNTER_SK", "time").agg(F.sum("count").alias("_all"), F.bool_or("_subtract_other").alias("_any")).where("_any")
    s = s.join(all_.drop("_any"), ["SITE_SK", "COUNTER_SK", "time"], "left")
    s = mark(s, F.col("_subtract_other"), "subtract_other", F.greatest(F.col("count") - (F.col("_all") - F.col("count")), F.lit(0)))
    s = mark(s, F.col("_missing"), "missing")
    s = mark(s, F.col("_scale"), "scale", half_even(F.col("count") * F.col("_factor")))
    s = s.withColumn("direction_unreliable", F.coalesce("_direction_unreliable", F.lit(False)))
    return s.select(*KEYS, "date", "slot", "time", "raw", "records", "load", "count", "fix", "direction_unreliable")

"""Literal rows for what the driver's tables can't reach: ties, daylight saving, order of actions, zero denominators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from slotweave.functions.columns import date_from_sk, half_even, pearson, ratio, slot_from_label, slot_label, with_run
from slotweave.functions.columns import minutes as _minutes
from slotweave.operators import cleaning, compare, decisions, faults, series, slots, views
from slotweave.sources import fixture as X

RECORD = "SITE_SK smallint, COUNTER_SK smallint, DIRECTION_SK smallint, date string, slot smallint, ID long, TOTAL_15MIN_COUNT int, Status tinyint, ADDED_UPDATED_DATETIME_SYDNEY string"


def recs(spark, rows):
    """rows: (site, counter, direction, date, slot, id, count, load)."""
    df = spark.createDataFrame([(a, b, c, d, e, f, g, 0, h) for a, b, c, d, e, f, g, h in rows], RECORD)
    return df.withColumns({c: F.col(c).cast("date") for c in ("date", "ADDED_UPDATED_DATETIME_SYDNEY")})


def decs(spark, *rows):
    return decisions.decision_table(X.decisions(spark, [(a, s, d, b, e, f, None, "x") for a, s, d, b, e, f in rows]))


def test_macros(spark):
    df = spark.createDataFrame([(20131, 32), (2026265, 95)], "sk int, slot smallint")
    got = df.select(date_from_sk(F.col("sk")), slot_label(F.col("slot")), slot_from_label(slot_label(F.col("slot")))).collect()
    assert [tuple(r) for r in got] == [(dt.date(2013, 1, 1), "08:00 - 08:14", 32), (dt.date(2026, 9, 22), "23:45 - 23:59", 95)]
    r = spark.createDataFrame([(1, 0), (0, 0), (-1, 0), (1, 4), (None, 0)], "a int, b int").select(ratio(F.col("a"), F.col("b"))).collect()
    assert r[0][0] == math.inf and math.isnan(r[1][0]) and r[2][0] == -math.inf and r[3][0] == 0.25 and r[4][0] is None
    assert [x[0] for x in spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double").select(half_even(F.col("x"))).collect()] == [0, 2, 2]
    c = spark.createDataFrame([(1, 2, 5), (2, 4, 5), (3, 6, 5)], "a int, b int, c int").agg(pearson(F.col("a"), F.col("b")), pearson(F.col("a"), F.col("c"))).first()
    assert c[0] == pytest.approx(1) and math.isnan(c[1])


@pytest.mark.parametrize("day, slot, local", [("2025-10-04", 63, "2025-10-05 01:45"), ("2025-10-04", 64, "2025-10-05 03:00"), ("2025-04-05", 63, "2025-04-06 02:45"), ("2025-04-05", 67, "2025-04-06 02:45")])
def test_daylight_saving(spark, day, slot, local):
    r = slots.local_records(recs(spark, [(4, 102, 40, day, slot, 1, 3, "2025-12-01")]), X.counters(spark)).first()
    assert (str(r["date"]), r["slot"]) == (local[:10], int(local[11:13]) * 4 + int(local[14:]) // 15)


def test_main_load(spark):
    t = slots.slot_table(recs(spark, [(0, 100, 0, "2024-01-02", 5, 1, 3, "2024-01-03"), (0, 100, 0, "2024-01-02", 5, 2, 1, "2024-01-04"), (0, 100, 0, "2024-01-02", 5, 3, 2, "2024-01-04"), (0, 100, 0, "2024-01-02", 6, 4, 0, "2024-01-04"), (0, 100, 0, "2024-01-02", 6, 5, 5, "2024-01-03")]))
    got = {r["slot"]: (r["raw"], r["records"], str(r["load"])) for r in t.collect()}
    assert got == {5: (6, 1, "2024-01-03"), 6: (5, 1, "2024-01-03")}


def test_out_of_range(spark):
    with pytest.raises(Exception, match="out of range"):
        slots.slot_table(recs(spark, [(0, 100, 0, "2024-01-02", 5, k, 40000, "2024-01-03") for k in range(2)])).collect()


def test_checks_hold_whatever_is_read(spark):
    many = recs(spark, [(0, 100, 0, "2024-01-02", 5, k, 40000, "2024-01-03") for k in range(2)])
    for read in (lambda t: t.select("records"), lambda t: t.select("SITE_SK").distinct(), lambda t: t.groupBy("date").count()):
        with pytest.raises(Exception, match="out of range"):
            read(slots.slot_table(many)).collect()
    r = recs(spark, [(2, 101, 20, "2024-01-08", 1, 1, 2, "2024-02-01")])
    clash = decs(spark, ("scale", 2, None, "2024-01-01", None, 0.5), ("scale", 2, 20, "2024-01-01", None, 0.25))
    for read in (lambda t: t.select("direction_unreliable"), lambda t: t.select("SITE_SK").distinct(), lambda t: t.groupBy("date").count()):
        with pytest.raises(Exception, match="disagree on the factor"):
            read(decisions.apply(slots.slot_table(r), clash, r)).collect()


def test_decisions_meet_their_months_only(spark):
    rows = [(2, 101, 20, d, 1, 1, 2, "2024-12-01") for d in ("2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01", "2024-03-31", "2024-05-01")]
    r = recs(spark, rows)
    d = decs(spark, ("missing", 2, 20, "2024-01-31", "2024-02-01", None), ("scale", 2, 20, "2024-03-31", None, 0.5), ("direction_unreliable", 2, None, "2023-01-01", "2024-02-29 00:15", None))
    got = {str(x["date"]): (x["count"], x["fix"], x["direction_unreliable"]) for x in decisions.apply(slots.slot_table(r), d, r).collect()}
    assert got == {"2024-01-31": (None, "missing", True), "2024-02-01": (None, "missing", True), "2024-02-29": (2, None, True), "2024-03-01": (2, None, False), "2024-03-31": (1, "scale", False), "2024-05-01": (1, "scale", False)}


def test_shared_folder_on_a_cluster():
    from slotweave.functions import lineage

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://there:7077"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        lineage.shared_folder(Cluster)


def _values(day, slot, values):
    return [(0, 100, 0, day, slot, k, v, "2024-02-01") for k, v in enumerate(values)]


@pytest.mark.parametrize("usual, values, want", [(1, [5, 5], (5, 5, True)), (1, [5, 4], (9, 0, False)), (3, [7, 7, 2, 2], (11, 7, True))])
def test_repeated_values(spark, usual, values, want):
    rows = [x for d in range(1, 4) for s in range(4) for x in _values(f"2024-01-0{d}", s, [1] * usual)] + _values("2024-01-03", 90, values)
    r = recs(spark, rows)
    got = [(x["dedup"], x["dropped"], x["matched"]) for x in slots.repeated_values(slots.slot_table(r), r).where("slot = 90").collect()]
    assert got == [want]


def test_usual_takes_the_smallest_of_ties(spark):
    rows = [x for d, n in ((1, 1), (2, 1), (3, 3), (4, 3)) for x in _values(f"2024-01-0{d}", 7, list(range(n)))]
    assert [r["usual"] for r in slots.usual_records(slots.slot_table(recs(spark, rows))).collect()] == [1]


@pytest.mark.parametrize("at, want", [([4 * k for k in range(8)], True), ([4 * k for k in range(7)], False), ([4 * k + k % 2 for k in range(9)], False)])
def test_hourly(spark, at, want):
    t = slots.with_hourly(slots.slot_table(recs(spark, [(0, 100, 0, "2024-01-02", s, s, 3, "2024-01-04") for s in at])))
    assert {r["hourly_binned"] for r in t.collect()} == {want}


def test_actions_in_order(spark):
    day = "2024-01-08"
    rows = [(2, 101, k, day, s, s, n, "2024-02-01") for k, n in ((20, 2), (21, 5)) for s in range(4)]
    r = recs(spark, rows)
    d = decs(spark, ("subtract_other", 2, 20, day, day, None), ("missing", 2, 21, day + " 00:15", day + " 00:15", None), ("scale", 2, 21, day, day, 0.5), ("zero_fill", 2, 21, day, day + " 01:15", None), ("uncertain", 2, None, day, None, None))
    got = {(x["DIRECTION_SK"], x["slot"]): (x["raw"], x["count"], x["fix"]) for x in decisions.apply(slots.slot_table(r), d, r).collect()}
    assert got[20, 0] == (2, 0, "subtract_other")
    assert got[21, 0] == (5, 2, "scale")
    assert got[21, 1] == (5, None, "missing")
    assert got[21, 4] == (0, 0, "scale") and got[21, 5] == (0, 0, "scale") and (21, 6) not in got and len(got) == 10


def test_decisions_are_checked(spark):
    with pytest.raises(Exception, match="unknown action"):
        decs(spark, ("paint", 1, None, "2024-01-01", None, None)).collect()
    with pytest.raises(Exception, match="positive factor"):
        decs(spark, ("scale", 1, None, "2024-01-01", None, None)).collect()
    r = recs(spark, [(2, 101, 20, "2024-01-08", 1, 1, 2, "2024-02-01")])
    clash = decs(spark, ("scale", 2, None, "2024-01-01", None, 0.5), ("scale", 2, 20, "2024-01-01", None, 0.25))
    with pytest.raises(Exception, match="disagree on the factor"):
        decisions.apply(slots.slot_table(r), clash, r).collect()


def test_mixed_precision_and_open_end(spark):
    got = decs(spark, ("missing", 3, None, "2024-01-12 03:15", "2024-01-12", None), ("missing", 3, None, "2024-01-13", None, None)).collect()
    assert [(str(r["start"]), r["end"] and str(r["end"])) for r in got] == [("2024-01-12 03:15:00", "2024-01-12 23:45:00"), ("2024-01-13 00:00:00", None)]


def test_provisional_days_go(spark):
    r = recs(spark, [(0, 100, 0, d, 1, 1, 2, "2024-01-03") for d in ("2024-01-02", "2024-01-03")])
    f = cleaning.final_slots(r, decs(spark), X.dates(spark))
    assert [str(x["date"]) for x in f.collect()] == ["2024-01-02"]
    assert [tuple(x) for x in cleaning.fix_counts(f).collect()] == [(None, 1)]


def test_runs(spark):
    t = spark.sql("SELECT explode(array(timestamp_ntz'2024-01-01 00:00', timestamp_ntz'2024-01-01 00:15', timestamp_ntz'2024-01-01 00:45')) AS time, 1 AS k")
    assert sorted((r["time"].minute, r["run"]) for r in with_run(t, ["k"], "time", _minutes(15)).collect()) == [(0, 1), (15, 1), (45, 2)]


def test_doubled_runs_over_days_without_bikes(spark):
    rows = [(0, 100, 0, f"2024-01-{d:02d}", s, s, n, "2024-02-01") for d, n in ((1, 2), (2, 4), (3, 0), (4, 0), (5, 2), (8, 3)) for s in range(8)]
    s = views.slots(recs(spark, rows), X.dates(spark))
    (r,) = faults.doubled(s).collect()
    assert (str(r["start"]), str(r["end"]), r["days"], r["nonzero_slots"]) == ("2024-01-01", "2024-01-05", 3, 24)


def test_groups_over_a_chain(spark):
    rows = [(s, c, s, "2024-01-01", 1, 1, 1, "2024-02-01") for s, c in ((9, 1), (8, 1), (8, 2), (7, 2), (7, 3), (6, 3), (3, 9))]
    got = {r["SITE_SK"]: r["review_group"] for r in slots.review_groups(recs(spark, rows)).collect()}
    assert got == {9: "G0006", 8: "G0006", 7: "G0006", 6: "G0006", 3: "G0003"}


def test_empty_tables(spark):
    r = recs(spark, [(0, 100, 0, "2024-01-02", 1, 1, 2, "2024-01-03")]).where("false")
    f = cleaning.final_slots(r, decs(spark, ("missing", 1, None, "2024-01-01", None, None)), X.dates(spark))
    assert f.count() == 0
    p = series.series_parts(f, X.parts(spark), X.directions(spark), X.counters(spark))
    assert series.weekly_series(f, p).count() == 0 and compare.fix_diff(f, f).count() == 0


def test_sum_is_kept(spark):
    r = X.records(spark, "/root/testdata/sf0.001")
    assert r.agg(F.sum("TOTAL_15MIN_COUNT")).first()[0] == slots.slot_table(slots.local_records(r, X.counters(spark))).agg(F.sum("raw")).first()[0]

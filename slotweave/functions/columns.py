"""Column macros: slots, labels, dates, rounding, ratios. All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slot_start(date: Column, slot: Column) -> Column:
    """The local start of a slot, without a zone."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), slot.cast("int") * 15, F.lit(0))


def slot_of(time: Column) -> Column:
    return (F.hour(time) * 4 + F.floor(F.minute(time) / 15)).cast("smallint")


def date_from_sk(sk: Column) -> Column:
    """A year and an unpadded day of the year: 20131, 2026265."""
    s = sk.cast("string")
    return F.date_add(F.make_date(F.substring(s, 1, 4).cast("int"), F.lit(1), F.lit(1)), F.substring(s, 5, 3).cast("int") - 1)


def slot_from_label(label: Column) -> Column:
    return (F.substring(label, 1, 2).cast("int") * 4 + F.floor(F.substring(label, 4, 2).cast("int") / 15)).cast("smallint")


def slot_label(slot: Column) -> Column:
    def clock(m: Column) -> Column:
        two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
        return F.concat(two(F.floor(m / 60)), F.lit(":"), two(m % 60))

    m = slot.cast("int") * 15
    return F.concat(clock(m), F.lit(" - "), clock(m + 14))


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounds ties to even, by scaling: the same arithmetic as other engines."""
    x = x.cast("double")
    return F.rint(x * 10.0**digits) / 10.0**digits if digits else F.rint(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b with infinity and NaN where b is 0, and null where either is null."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(b != 0, F.try_divide(a, b)).when(a.isNull() | b.isNull(), None).when(a == 0, float("nan")).otherwise(F.when(a > 0, float("inf")).otherwise(float("-inf")))


def pearson(a: Column, b: Column) -> Column:
    """The correlation of two whole-number columns as an aggregate, from exact sums; NaN where one is constant."""
    a, b = a.cast("double"), b.cast("double")
    n = F.count(F.when(a.isNotNull() & b.isNotNull(), 1)).cast("double")
    both = n * F.sum(a * b) - F.sum(a) * F.sum(b)
    va, vb = n * F.sum(a * a) - F.sum(a) * F.sum(a), n * F.sum(b * b) - F.sum(b) * F.sum(b)
    return F.when((va <= 0) | (vb <= 0), float("nan")).otherwise(F.try_divide(both, F.sqrt(F.greatest(va, F.lit(0.0))) * F.sqrt(F.greatest(vb, F.lit(0.0)))))


def planar_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    north = (lat - lat0) * 111.0
    east = (lon - lon0) * (111.0 * F.cos(F.radians(lat0)))
    return half_even(F.sqrt(north * north + east * east), 2)


def between_dates(df: DataFrame, start: str | None = None, end: str | None = None, col: str = "date") -> DataFrame:
    """Rows within [start, end]; either end may be open."""
    if start:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def must(df: DataFrame, holds: Column, message: Column) -> DataFrame:
    """``df``, whose rows must all satisfy ``holds``: else reading it fails with ``message``. A filter, which stays whichever
    columns are read."""
    return df.where(F.when(F.coalesce(holds, F.lit(False)), True).otherwise(F.raise_error(message).cast("boolean")))


def with_run(df: DataFrame, by: list[str], order: str, step: Column) -> DataFrame:
    """Numbers runs of rows whose ``order`` grows by exactly ``step`` (gaps and islands), in column ``run``."""
    w = Window.partitionBy(*by).orderBy(order)
    new = F.coalesce((F.col(order) - F.lag(order).over(w) != step).cast("int"), F.lit(1))
    return df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w)).drop("_new")


def days(n: int) -> Column:
    return F.expr(f"interval '{n}' day")


def minutes(n: int) -> Column:
    return F.expr(f"interval '{n}' minute")

"""The registered queries of the count-series engine, each with the SQL that it is compared with.

Every query takes the driver's `events` table through the adapter in ``sources.fixture``. Days of that table are sparse at
small scale, so views that look at complete days take a lower threshold here; it is a parameter of the engine."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import date_from_sk, days, half_even, slot_from_label, slot_label, with_run
from ..functions.lineage import cut, scratch
from ..operators import audit, cleaning, compare, decisions, faults, series, slots, views
from ..settings import KEYS, Settings
from ..sources import files, rehearsal, semantic, verdicts
from ..sources import fixture as X
from . import oracle as O

SPARSE = Settings(complete_slots=20)
ALL_DIRECTIONS = [0, 1, 10, 11, 12, 20, 21, 30, 31, 40, 41, 50, 51]
CASES = [(0, 100, 100, "2024-01-15", "2024-01-08"), (2, 101, 101, "2024-01-15", "2024-01-08"), (2, 101, 101, "2024-01-22", "2024-01-15"), (4, 102, 102, "2024-01-22", "2024-01-08")]
CONTROLS = [(3, 101), (5, 102)]

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def register(select: str | None = None, pre: str = "base", more: str = "") -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if select:
            _sql[f.__name__] = O.sql(select, pre, more)
        return f

    return add


# --- inputs of the queries ------------------------------------------------------------------------------------------
def _records(spark: SparkSession, d: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return slots.local_records(X.records(spark, d), X.counters(spark), start=start, end=end)


def _s(spark: SparkSession, d: str) -> DataFrame:
    return views.slots(_records(spark, d), X.dates(spark))


def _both(spark: SparkSession, d: str) -> list[DataFrame]:
    """The final slots under the old and the new decisions, from one slot table."""
    r = _records(spark, d)
    prepared = cleaning.slots_and_loads(r)
    return [cleaning.final_slots(r, _dec(spark, rows), X.dates(spark), prepared=prepared) for rows in (X.OLD_DECISIONS, None)]


def _cleaned(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Where the whole cleaning has written its results, and its numbers of fixes."""
    path = scratch(spark)
    return path, cleaning.run(_records(spark, d), _dec(spark), X.parts(spark), X.dates(spark), X.directions(spark), X.counters(spark), path)


def _verdicts(spark: SparkSession) -> DataFrame:
    """The reviewer's document, written and read as a file."""
    path = scratch(spark)
    files.write_text(spark, json.dumps(X.verdict(), indent=1), path)
    return verdicts.read_verdicts(spark, path)


def _dec(spark: SparkSession, rows: list | None = None) -> DataFrame:
    return decisions.decision_table(X.decisions(spark, rows))


def _applied(spark: SparkSession, d: str) -> DataFrame:
    r = _records(spark, d)
    return decisions.apply(cut(slots.slot_table(r)), _dec(spark), r)


def _final(spark: SparkSession, d: str, rows: list | None = None) -> DataFrame:
    return cleaning.final_slots(_records(spark, d), _dec(spark, rows), X.dates(spark))


def _parts(spark: SparkSession, final: DataFrame) -> DataFrame:
    return series.series_parts(final, X.parts(spark), X.directions(spark), X.counters(spark))


def _none(spark: SparkSession) -> DataFrame:
    return X.parts(spark).where("false")


# --- records and slots ----------------------------------------------------------------------------------------------
@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, ID, n AS TOTAL_15MIN_COUNT, status AS Status, load AS ADDED_UPDATED_DATETIME_SYDNEY FROM recs")
def records(spark, d):
    return _records(spark, d)


@register("""SELECT slot, lpad(CAST(slot * 15 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(slot * 15 % 60 AS VARCHAR), 2, '0') || ' - ' || lpad(CAST((slot * 15 + 14) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((slot * 15 + 14) % 60 AS VARCHAR), 2, '0') AS label, slot AS back, count(*) AS n FROM raw GROUP BY slot""")
def slot_labels(spark, d):
    n = X.records(spark, d).groupBy("slot").agg(F.count("*").alias("n")).withColumn("label", slot_label(F.col("slot")))
    return n.withColumn("back", slot_from_label(F.col("label")))


@register("SELECT DISTINCT date, CAST(strftime(date, '%Y') || CAST(dayofyear(date) AS VARCHAR) AS INTEGER) AS sk, date AS back FROM raw")
def date_sk(spark, d):
    days_ = X.records(spark, d).select("date").distinct()
    return days_.withColumn("sk", F.concat(F.year("date"), F.dayofyear("date")).cast("int")).withColumn("back", date_from_sk(F.col("sk")))


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, raw, records, load FROM slots")
def slot_table(spark, d):
    return slots.slot_table(_records(spark, d))


@register("SELECT DISTINCT s.date, workday FROM s")
def workday(spark, d):
    return slots.with_workday(_records(spark, d).select("date").distinct(), X.dates(spark))


@register("SELECT DISTINCT DIRECTION_SK, date, hourly_binned FROM s")
def hourly_binned(spark, d):
    return _s(spark, d).select("DIRECTION_SK", "date", "hourly_binned").distinct()


@register("""SELECT site AS SITE_SK, 'G' || lpad(CAST(min(low) AS VARCHAR), 4, '0') AS review_group FROM reach GROUP BY site""",
          more="""pairs AS (SELECT DISTINCT SITE_SK, COUNTER_SK FROM recs), reach(site, low) AS (SELECT SITE_SK, SITE_SK FROM pairs UNION SELECT b.SITE_SK, r.low FROM reach r JOIN pairs a ON a.SITE_SK = r.site JOIN pairs b ON a.COUNTER_SK = b.COUNTER_SK)""")
def review_groups(spark, d):
    return slots.review_groups(_records(spark, d))


# --- sources and sinks ----------------------------------------------------------------------------------------------
_STORED = "SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, ID, n AS TOTAL_15MIN_COUNT, status AS Status, load AS ADDED_UPDATED_DATETIME_SYDNEY FROM "
_STORED_COLUMNS = ["SITE_SK", "COUNTER_SK", "DIRECTION_SK", "date", "slot", "ID", "TOTAL_15MIN_COUNT", "Status", slots.LOAD]


@register(_STORED + "raw WHERE SITE_SK IN (0, 2, 4) AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def stored_counts(spark, d):
    """Rows as the source has them, typed, stored by site and year and read back for some sites and a period."""
    path = scratch(spark)
    files.write_counts(files.typed_counts(X.source_rows(spark, d)), path)
    return files.read_counts(spark, path, [0, 2, 4], "2024-01-05", "2024-01-20").select(*_STORED_COLUMNS)


@register(_STORED + "recs WHERE SITE_SK >= 3 AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def stored_local(spark, d):
    """The same for a period of local dates: some of these were published under the date before."""
    path = scratch(spark)
    files.write_counts(files.typed_counts(X.source_rows(spark, d)), path)
    return files.read_local(spark, path, X.counters(spark), [3, 4, 5], "2024-01-05", "2024-01-20").select(*_STORED_COLUMNS)


_SK = "CAST('2024' || dayofyear(date) AS INTEGER)"


@register(f"SELECT SITE_SK, {_SK} AS DATE_SK, count(*) AS rows FROM raw GROUP BY ALL")
def inventory(spark, d):
    return files.inventory(X.source_rows(spark, d))


@register("SELECT SITE_SK, sk AS DATE_SK, n AS rows, chunk FROM walk",
          more=f"""days_ AS (SELECT SITE_SK, sk, n, row_number() OVER (PARTITION BY SITE_SK ORDER BY sk) AS i FROM (SELECT SITE_SK, {_SK} AS sk, count(*) AS n FROM raw GROUP BY ALL)),
walk(SITE_SK, i, sk, n, chunk, used) AS (SELECT SITE_SK, i, sk, n, 0, n FROM days_ WHERE i = 1 UNION ALL SELECT x.SITE_SK, x.i, x.sk, x.n, CASE WHEN w.used + x.n > 150 THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN w.used + x.n > 150 THEN x.n ELSE w.used + x.n END FROM walk w JOIN days_ x ON x.SITE_SK = w.SITE_SK AND x.i = w.i + 1)""")
def day_chunks(spark, d):
    return files.packed(files.inventory(X.source_rows(spark, d)), 150)


@register("SELECT SITE_SK, 2024 AS year, count(*) AS rows, count(*) AS stored, SITE_SK IN (3, 5) AS fetched, true AS complete FROM raw GROUP BY SITE_SK")
def ingest_report(spark, d):
    """A store that lacks a day of site 3 and all of site 5 is brought up to the inventory."""
    source, path = X.source_rows(spark, d), scratch(spark)
    counts = cut(files.typed_counts(source))
    files.write_counts(counts.where("SITE_SK <> 5 AND NOT (SITE_SK = 3 AND date = DATE'2024-01-09')"), path)
    return files.ingest(counts, files.inventory(source), path)


@register("SELECT c.COUNTER_SK, counter_id AS \"Counter ID\", n AS fact_rows FROM counters c JOIN (SELECT COUNTER_SK, count(*) AS n FROM raw GROUP BY ALL) r ON c.COUNTER_SK = r.COUNTER_SK")
def dimension_members(spark, d):
    """A dimension as a file of strings; the member without facts goes."""
    path = scratch(spark)
    more = spark.createDataFrame([("999", "C999", "TUBE", "Nobody")], "COUNTER_SK string, `Counter ID` string, Technology string, `Vendor name` string")
    files.write_csv(X.counters(spark).select(*(F.col(f"`{c}`").cast("string").alias(c) for c in X.counters(spark).columns)).unionByName(more), path)
    return files.dimension_rows(files.read_dimension(spark, path), X.records(spark, d), "COUNTER_SK").select(F.col("COUNTER_SK").cast("smallint").alias("COUNTER_SK"), "Counter ID", "fact_rows")


def _service(spark: SparkSession, fields: dict) -> DataFrame:
    semantic.register(spark)
    split = {"site": semantic.Field("c", "SITE_SK"), "day": semantic.Field("c", "DATE_SK"), "rows": semantic.Field("c", "Rows", "Measure")}
    query = semantic.Query({"c": "Counts"}, {k: semantic.Field("c", *f) for k, f in fields.items()})
    options = {"embedUrl": "http://embed", "report": "r", "query": query.to_json(), "split": json.dumps({k: vars(f) for k, f in split.items()}), "transport": f"{rehearsal.__name__}:answer"}
    return spark.read.format("semantic").options(**options)


_FACTS = f"""facts AS (SELECT s, 20240 + d AS day, k, (s * 7 + d * 3 + k) % 11 AS n, d FROM (SELECT unnest(range(1, {rehearsal.SITES + 1})) AS s), (SELECT unnest(range(1, {rehearsal.DAYS + 1})) AS d), (SELECT unnest(range(0, {rehearsal.SLOTS})) AS k) WHERE (d + s) % 3 <> 0 OR k % 4 = 0)"""


@register("SELECT CAST(s AS INTEGER) AS SITE_SK, CAST(day AS INTEGER) AS DATE_SK, CAST(k AS INTEGER) AS SLOT, strftime(DATE '2024-01-01' + CAST(d AS INTEGER), '%Y-%m-%dT00:00:00') AS LOADED, nullif(n, 0) AS Total FROM facts WHERE s IN (1, 2, 4)", more=_FACTS)
def service_counts(spark, d):
    """Through the data source: planned by site and day, fetched in windows of packed rows; a process's first token is refused."""
    fields = {k: (k,) for k in ("SITE_SK", "DATE_SK", "SLOT", "LOADED")} | {"Total": ("Total", "Measure")}
    return _service(spark, fields).schema("SITE_SK int, DATE_SK int, SLOT int, LOADED string, Total bigint").load().where("SITE_SK IN (1, 2, 4)")


@register("SELECT CAST(s AS INTEGER) AS SITE_SK, CAST(day AS INTEGER) AS DATE_SK, count(*) AS Rows FROM facts GROUP BY ALL", more=_FACTS)
def service_inventory(spark, d):
    """A measure groups by the columns that are asked for with it."""
    return _service(spark, {"SITE_SK": ("SITE_SK",), "DATE_SK": ("DATE_SK",), "Rows": ("Rows", "Measure")}).schema("SITE_SK int, DATE_SK int, Rows bigint").load()


@register(O._values_sql([(e, p, k) for e, ps in rehearsal.ENTITIES.items() for p, k in ps.items()], "entity, property, kind", "entity, property, kind"))
def service_schema(spark, d):
    found = semantic.Service("http://embed", "r", rehearsal.answer, lambda seconds: None).schema()
    return spark.createDataFrame([(e, p, k) for e, ps in found.items() for p, k in ps.items()], "entity string, property string, kind string")


@register(O._values_sql([(X.GROUP, i, *r) for i, r in enumerate(X.DECISIONS)], "g, i, action, s, d, b, e, f, r, w", 'g AS "group", i, action, CAST(s AS INTEGER) AS SITE_SK, CAST(d AS INTEGER) AS DIRECTION_SK, b AS start, e AS "end", CAST(f AS DOUBLE) AS factor, coalesce(CAST(r AS BOOLEAN), false) AS rejected, w AS diagnosis'))
def verdict_decisions(spark, d):
    return audit.flat_decisions(_verdicts(spark)).select("group", "i", "action", "SITE_SK", "DIRECTION_SK", "start", "end", "factor", "rejected", "diagnosis")


@register(O._values_sql(X.PARTS, "a, b, c, d, e, f", 'CAST(a AS SMALLINT) AS SITE_SK, b AS series, CAST(c AS SMALLINT) AS COUNTER_SK, CAST(d AS SMALLINT) AS DIRECTION_SK, CAST(e AS DATE) AS start, CAST(f AS DATE) AS "end"'))
def verdict_series(spark, d):
    """The series that is rejected goes."""
    return verdicts.series_table(_verdicts(spark))


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, time, workday, records, raw, count, fix, direction_unreliable, hourly_binned FROM cfinal", "clean")
def written_counts(spark, d):
    return files.read_slots(spark, _cleaned(spark, d)[0])


@register('SELECT SITE_SK, series, COUNTER_SK, DIRECTION_SK, start, "end", match_site FROM qparts', "series")
def written_series(spark, d):
    return files.read_series(spark, _cleaned(spark, d)[0])


@register("SELECT SITE_SK, series, week, bikes, complete_days, direction_unreliable FROM wk", "series")
def written_weekly(spark, d):
    return spark.read.parquet(f"{_cleaned(spark, d)[0]}/weekly")


@register("SELECT fix, count(*) AS slots FROM cfinal GROUP BY fix", "clean")
def written_fixes(spark, d):
    return _cleaned(spark, d)[1]


# --- decisions ------------------------------------------------------------------------------------------------------
@register('SELECT SITE_SK, DIRECTION_SK, start, "end", action, factor FROM cdec', "clean")
def decision_table(spark, d):
    return _dec(spark)


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot FROM capplied a WHERE NOT EXISTS (SELECT 1 FROM slots x WHERE x.DIRECTION_SK = a.DIRECTION_SK AND x.date = a.date AND x.slot = a.slot)", "clean")
def zero_fill(spark, d):
    s = cut(slots.slot_table(_records(spark, d)))
    return decisions.filled_slots(decisions.scoped(_dec(spark), s), s).select(*KEYS, "date", "slot")


_MARKED = "SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, raw, count FROM capplied WHERE "


def _marked(spark, d, fix):
    return _applied(spark, d).where(F.col("fix") == fix).select(*KEYS, "date", "slot", "raw", "count")


@register(_MARKED + "fix = 'drop_duplicates'", "clean")
def drop_duplicates(spark, d):
    return _marked(spark, d, "drop_duplicates")


@register(_MARKED + "fix = 'subtract_other'", "clean")
def subtract_other(spark, d):
    return _marked(spark, d, "subtract_other")


@register(_MARKED + "fix = 'missing'", "clean")
def missing(spark, d):
    return _marked(spark, d, "missing")


@register(_MARKED + "fix = 'scale'", "clean")
def scale_half_even(spark, d):
    return _marked(spark, d, "scale")


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, count(*) AS slots FROM capplied WHERE direction_unreliable GROUP BY ALL", "clean")
def direction_unreliable(spark, d):
    return _applied(spark, d).where("direction_unreliable").groupBy(*KEYS, "date").agg(F.count("*").alias("slots"))


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, time, raw, records, load, count, fix, direction_unreliable FROM capplied", "clean")
def apply_all(spark, d):
    return _applied(spark, d)


@register("SELECT DIRECTION_SK, month, usual FROM pusual")
def usual_records(spark, d):
    return slots.usual_records(slots.slot_table(_records(spark, d)))


@register("SELECT DIRECTION_SK, date, slot, dedup, dropped, matched FROM pdup")
def duplicate_values(spark, d):
    r = _records(spark, d)
    return slots.repeated_values(slots.slot_table(r), r)


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, time, workday, records, raw, count, fix, direction_unreliable, hourly_binned FROM cfinal", "clean")
def counts_15min(spark, d):
    return _final(spark, d)


@register("SELECT fix, count(*) AS slots FROM cfinal GROUP BY fix", "clean")
def fix_counts(spark, d):
    return cleaning.fix_counts(_final(spark, d))


@register('SELECT SITE_SK, series, COUNTER_SK, DIRECTION_SK, start, "end", match_site FROM qparts', "series")
def series_parts(spark, d):
    return _parts(spark, _final(spark, d))


@register("SELECT SITE_SK, series, week, bikes, complete_days, direction_unreliable FROM wk", "series")
def weekly_series(spark, d):
    f = cut(_final(spark, d))
    return series.weekly_series(f, _parts(spark, f))


# --- views ----------------------------------------------------------------------------------------------------------
@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, time, workday, records, count, hourly_binned FROM s")
def view_slots(spark, d):
    return _s(spark, d)


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, slot, time, workday, records, count, hourly_binned FROM s WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'")
def view_slots_period(spark, d):
    return views.slots(_records(spark, d, "2024-01-08", "2024-01-14"), X.dates(spark))


@register("SELECT s.SITE_SK, s.COUNTER_SK, s.DIRECTION_SK, min(date) AS first, max(date) AS last, any_value(d.orientation) AS orientation, any_value(d.way) AS way FROM slots s LEFT JOIN directions d ON s.DIRECTION_SK = d.DIRECTION_SK GROUP BY ALL")
def meta(spark, d):
    m = views.meta(_records(spark, d), X.sites(spark), X.counters(spark), X.directions(spark))["directions"]
    return m.select(*KEYS, "first", "last", F.col("Orientation description").alias("orientation"), F.col("Location in/out").alias("way"))


@register('SELECT SITE_SK, site_name AS "Site name", lat AS "Site latitude" FROM sites WHERE SITE_SK IN (SELECT SITE_SK FROM slots)')
def meta_sites(spark, d):
    m = views.meta(_records(spark, d), X.sites(spark), X.counters(spark), X.directions(spark))["sites"]
    return m.select("SITE_SK", "Site name", "Site latitude")


@register('SELECT COUNTER_SK, counter_id AS "Counter ID", technology AS "Technology", vendor AS "Vendor name" FROM counters WHERE COUNTER_SK IN (SELECT COUNTER_SK FROM slots)')
def meta_counters(spark, d):
    return views.meta(_records(spark, d), X.sites(spark), X.counters(spark), X.directions(spark))["counters"]


@register("""SELECT ID, DIRECTION_SK, date, slot, lpad(CAST(slot * 15 // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(slot * 15 % 60 AS VARCHAR), 2, '0') || ' - ' || lpad(CAST((slot * 15 + 14) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((slot * 15 + 14) % 60 AS VARCHAR), 2, '0') AS slot_label FROM raw WHERE date = DATE '2024-01-09'""")
def raw(spark, d):
    return views.raw(X.records(spark, d), "2024-01-09", "2024-01-09").select("ID", "DIRECTION_SK", "date", "slot", "slot_label")


@register("SELECT * FROM daily")
def daily(spark, d):
    return views.daily(_s(spark, d))


@register("SELECT date, weekday, " + ", ".join(f'max(CASE WHEN DIRECTION_SK = {k} THEN count END) AS "{k}"' for k in ALL_DIRECTIONS) + " FROM daily GROUP BY date, weekday")
def daily_wide(spark, d):
    return views.daily_wide(_s(spark, d), ALL_DIRECTIONS)


_WEEKLY = f"SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, {O.week()} AS week, CAST(sum(count) AS BIGINT) AS count, count(CASE WHEN slots >= 20 THEN 1 END) AS complete_days, {O.he('sum(slots) / 672.0', 3)} AS slot_share FROM daily GROUP BY ALL"


@register(_WEEKLY)
def weekly(spark, d):
    return views.weekly(_s(spark, d), SPARSE)


@register("SELECT week, " + ", ".join(f'max(CASE WHEN DIRECTION_SK = {k} THEN count END) AS "{k}"' for k in ALL_DIRECTIONS) + f" FROM ({_WEEKLY}) GROUP BY week")
def weekly_wide(spark, d):
    return views.weekly_wide(_s(spark, d), ALL_DIRECTIONS)


@register(f"SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, {O.week(unit='month')} AS month, {O.he('avg(count)')} AS per_day, count(*) AS days FROM daily WHERE slots >= 20 GROUP BY ALL")
def monthly(spark, d):
    return views.monthly(_s(spark, d), SPARSE)


@register(f"SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, {O.week(unit='month')} AS month, count(*) AS days, count(CASE WHEN slots >= 20 THEN 1 END) AS complete_days, {O.he('avg(CASE WHEN slots >= 20 THEN count END)')} AS per_day, {O.he('avg(records_per_slot)', 2)} AS records_per_slot FROM daily GROUP BY ALL")
def overview(spark, d):
    return views.overview(_s(spark, d), SPARSE)


def _hourly(where: str) -> str:
    return "SELECT DIRECTION_SK, " + ", ".join(O.he(f"sum(CASE WHEN hour(time) = {k} THEN count END) / count(DISTINCT date)", 1) + f' AS "{k}"' for k in range(24)) + f", count(DISTINCT date) AS days FROM s WHERE {where} GROUP BY DIRECTION_SK"


@register(_hourly("workday"))
def hourly(spark, d):
    return views.hourly(_s(spark, d))


@register(_hourly("NOT workday"))
def hourly_free(spark, d):
    return views.hourly(_s(spark, d), workday=False)


@register("SELECT DIRECTION_SK, date, slot, array_to_string(list(n ORDER BY ID), ',') AS records, array_to_string(list(status ORDER BY ID), ',') AS status, array_to_string(list(ID ORDER BY ID), ',') AS ids, count(DISTINCT load) AS loads FROM raw GROUP BY ALL")
def channels(spark, d):
    c = views.channels(X.records(spark, d))
    text = lambda x: F.concat_ws(",", F.col(x).cast("array<string>")).alias(x)
    return c.select("DIRECTION_SK", "date", "slot", text("records"), text("status"), text("ids"), F.size("loaded").cast("bigint").alias("loads"))


def _neighbours(where: str) -> str:
    return f"""SELECT n.SITE_SK, n.site_name AS "Site name", n.km, p.COUNTER_SK, p.first, p.last, c.technology AS "Technology" FROM
  (SELECT a.SITE_SK, a.site_name, {O.he('sqrt(((a.lat - m.lat) * 111.0) * ((a.lat - m.lat) * 111.0) + ((a.lon - m.lon) * (111.0 * cos(radians(m.lat)))) * ((a.lon - m.lon) * (111.0 * cos(radians(m.lat)))))', 2)} AS km FROM sites a JOIN sites m ON m.SITE_SK = 2 AND a.SITE_SK <> 2) n
  JOIN (SELECT SITE_SK, COUNTER_SK, min(date) AS first, max(date) AS last FROM raw GROUP BY ALL) p ON n.SITE_SK = p.SITE_SK LEFT JOIN counters c ON p.COUNTER_SK = c.COUNTER_SK WHERE n.km <= 3 AND {where}"""


_NEIGHBOUR = ["SITE_SK", "Site name", "km", "COUNTER_SK", "first", "last", "Technology"]


@register(_neighbours("c.technology <> 'CAMERA'"))
def neighbours(spark, d):
    return views.neighbours(X.records(spark, d), X.sites(spark), X.counters(spark), 2).select(*_NEIGHBOUR)


@register(_neighbours("true"))
def neighbours_and_cameras(spark, d):
    return views.neighbours(X.records(spark, d), X.sites(spark), X.counters(spark), 2, cameras=True).select(*_NEIGHBOUR)


_DAYS = "sd AS (SELECT SITE_SK, date, CASE WHEN bool_and(slots >= 20) THEN CAST(sum(count) AS BIGINT) END AS bikes FROM daily GROUP BY ALL), sw AS (SELECT date, " + ", ".join(f"max(CASE WHEN SITE_SK = {k} THEN bikes END) AS b{k}" for k in (0, 2, 3)) + " FROM sd WHERE SITE_SK IN (0, 2, 3) GROUP BY date)"
_RATIOS = f"{O.he(O.div('b0', 'b2'), 3)} AS ratio_2, {O.he(O.div('b0', 'b3'), 3)} AS ratio_3"


@register(f'SELECT week, b0 AS "0", b2 AS "2", b3 AS "3", days, {_RATIOS} FROM (SELECT {O.week()} AS week, CAST(sum(b0) AS BIGINT) AS b0, CAST(sum(b2) AS BIGINT) AS b2, CAST(sum(b3) AS BIGINT) AS b3, count(*) AS days FROM sw WHERE b0 IS NOT NULL AND b2 IS NOT NULL AND b3 IS NOT NULL GROUP BY ALL)', more=_DAYS)
def compare_week(spark, d):
    return views.compare(_s(spark, d), 0, [2, 3], "week", SPARSE)


@register(f'SELECT date, b0 AS "0", b2 AS "2", b3 AS "3", {_RATIOS} FROM sw', more=_DAYS)
def compare_day(spark, d):
    return views.compare(_s(spark, d), 0, [2, 3], "day", SPARSE)


def _directions(when: str) -> str:
    equal = "count(CASE WHEN a.count = b.count AND (a.count > 0 OR b.count > 0) THEN 1 END)"
    return f"""SELECT a.SITE_SK, a.DIRECTION_SK AS a, b.DIRECTION_SK AS b, {when}, CAST(sum(a.count) AS BIGINT) AS bikes_a, CAST(sum(b.count) AS BIGINT) AS bikes_b,
  {O.he(O.div('sum(a.count)', 'sum(b.count)'), 3)} AS ratio, {O.he(O.corr('a.count', 'b.count'), 3)} AS corr, {O.he(O.div(equal, 'count(CASE WHEN a.count > 0 OR b.count > 0 THEN 1 END)'), 3)} AS equal,
  {O.he('avg(CASE WHEN b.count > 0 THEN CAST(a.count >= b.count AS INT) END)', 3)} AS a_covers_b, {O.he('avg(CASE WHEN a.count > 0 THEN CAST(b.count >= a.count AS INT) END)', 3)} AS b_covers_a
  FROM s a JOIN s b ON a.SITE_SK = b.SITE_SK AND a.date = b.date AND a.time = b.time AND a.DIRECTION_SK < b.DIRECTION_SK GROUP BY ALL"""


@register(_directions(f"{O.week('a.date')} AS week"))
def directions(spark, d):
    return views.directions(_s(spark, d))


@register(_directions("a.date AS date"))
def directions_day(spark, d):
    return views.directions(_s(spark, d), "day")


@register("SELECT COUNTER_SK, date, count(DISTINCT s.DIRECTION_SK) AS directions, count(*) AS slots, CAST(sum(count) AS BIGINT) AS bikes, " + ", ".join(f"CAST(sum(CASE WHEN w = '{w}' THEN count END) AS BIGINT) AS \"{w}\"" for w in views.WAYS) + " FROM s LEFT JOIN (SELECT DIRECTION_SK, coalesce(way, 'NA') AS w FROM directions) d ON s.DIRECTION_SK = d.DIRECTION_SK GROUP BY ALL")
def counter_days(spark, d):
    return views.counter_days(_s(spark, d), X.directions(spark))


@register("SELECT date, count(*) AS sites, count(CASE WHEN b = 0 THEN 1 END) AS zero_sites, count(CASE WHEN w THEN 1 END) AS warning_sites, CAST(sum(b) AS BIGINT) AS bikes FROM (SELECT SITE_SK, date, sum(n) AS b, bool_or(status = 1) AS w FROM raw GROUP BY ALL) GROUP BY date")
def network(spark, d):
    return views.network(X.records(spark, d))


@register("SELECT date, day_type AS \"Day type\" FROM dates WHERE date >= DATE '2024-01-10'")
def calendar(spark, d):
    return views.calendar(X.dates(spark), "2024-01-10").select("date", "Day type")


@register("SELECT w.date, r.rain_mm_to_9am AS rain_mm, w.max_temp_c FROM weather w LEFT JOIN weather r ON r.date = w.date + 1")
def weather_shift(spark, d):
    return views.weather(X.weather(spark))


@register(O._values_sql(X.EVENTS, "date, end_date, name, kind, sites, effect, source", "CAST(date AS DATE) AS date, CAST(end_date AS DATE) AS end_date, name, effect, array_to_string(list_transform(string_split(sites, ';'), lambda x: CAST(trim(x) AS INTEGER)), ',') AS site_list"))
def event_list(spark, d):
    """The list of events, written and read as a file."""
    path = scratch(spark)
    files.write_csv(X.events(spark), path)
    listed = views.events(files.read_events(spark, path))
    return listed.select("date", "end_date", "name", "effect", F.concat_ws(",", F.col("site_list").cast("array<string>")).alias("site_list"))


@register("SELECT * FROM weather")
def weather_file(spark, d):
    path = scratch(spark)
    files.write_csv(X.weather(spark), path)
    return files.read_weather(spark, path)


@register("SELECT site AS SITE_SK FROM reach GROUP BY site HAVING min(low) = 1",
          more="pairs AS (SELECT DISTINCT SITE_SK, COUNTER_SK FROM recs WHERE SITE_SK > 0), reach(site, low) AS (SELECT SITE_SK, SITE_SK FROM pairs UNION SELECT b.SITE_SK, r.low FROM reach r JOIN pairs a ON a.SITE_SK = r.site JOIN pairs b ON a.COUNTER_SK = b.COUNTER_SK)")
def group_sites(spark, d):
    return views.group_sites(slots.review_groups(_records(spark, d).where("SITE_SK > 0")), "G0001")


@register("""SELECT CAST(row_number() OVER (ORDER BY n) AS INTEGER) AS n, line FROM (SELECT -2 AS n, '| SITE_SK | COUNTER_SK | DIRECTION_SK | first | last | way |' AS line UNION ALL SELECT -1, '| --- | --- | --- | --- | --- | --- |'
  UNION ALL SELECT s.DIRECTION_SK, '| ' || s.SITE_SK || ' | ' || s.COUNTER_SK || ' | ' || s.DIRECTION_SK || ' | ' || min(date) || ' | ' || max(date) || ' | ' || coalesce(any_value(way), '') || ' |' FROM slots s LEFT JOIN directions d ON s.DIRECTION_SK = d.DIRECTION_SK GROUP BY s.SITE_SK, s.COUNTER_SK, s.DIRECTION_SK)""")
def markdown_lines(spark, d):
    """The directions of a brief, as lines of the file that it is written to."""
    m = views.meta(_records(spark, d), X.sites(spark), X.counters(spark), X.directions(spark))
    m["directions"] = m["directions"].select(*KEYS, "first", "last", F.col("Location in/out").alias("way")).orderBy("DIRECTION_SK")
    path = scratch(spark)
    files.write_text(spark, files.brief(X.GROUP, [0, 1], m, "How to judge."), path)
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("n", "line"))
    start = lines.where("line LIKE '| SITE_SK | COUNTER_SK | DIRECTION_SK %'").select(F.col("n").alias("from_n"))
    return lines.crossJoin(start).where("n >= from_n AND line LIKE '|%'").select((F.col("n") - F.col("from_n") + 1).cast("int").alias("n"), "line")


# --- faults ---------------------------------------------------------------------------------------------------------
_USUAL = "us AS (SELECT DIRECTION_SK, workday, slot, avg(count) AS mean, median(count) AS med FROM s GROUP BY ALL), su AS (SELECT s.*, mean, med FROM s JOIN us USING (DIRECTION_SK, workday, slot))"


def _zeros(by: str) -> str:
    return f"SELECT {by}, min(time) AS start, max(time) AS \"end\", count(*) / 4 AS hours, count(CASE WHEN hour(time) BETWEEN 6 AND 19 THEN 1 END) / 4 AS daytime_hours, {O.he('sum(mean)')} AS usual_bikes FROM zr GROUP BY {by}, run HAVING count(*) / 4 >= 0.5"


@register(_zeros(O.K), more=f"{_USUAL}, z AS (SELECT * FROM su WHERE count = 0), {O.runs('zr', 'z', O.K, 'time', O.Q15)}")
def zeros(spark, d):
    return faults.zeros(_s(spark, d), min_hours=0.5)


@register(_zeros("COUNTER_SK"), more=f"{_USUAL}, z AS (SELECT COUNTER_SK, time, sum(mean) AS mean FROM su GROUP BY ALL HAVING sum(count) = 0), {O.runs('zr', 'z', 'COUNTER_SK', 'time', O.Q15)}")
def zeros_counter(spark, d):
    return faults.zeros(_s(spark, d), min_hours=0.5, counter=True)


@register(f"""SELECT r.SITE_SK, r.COUNTER_SK, r.DIRECTION_SK, r.start, r."end", r.days, r.nonzero_slots, {O.he('lev', 2)} AS level FROM dr r LEFT JOIN lv USING (DIRECTION_SK, run)""",
          more=f"""h AS (SELECT * REPLACE (CASE WHEN date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND DIRECTION_SK = 21 OR date > DATE '2024-01-24' AND SITE_SK = 3 THEN count * 2 ELSE count END AS count) FROM s),
dd AS (SELECT {O.K}, date, workday, sum(count) AS tot, count(CASE WHEN count > 0 THEN 1 END) AS nz, count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd FROM h GROUP BY ALL),
de AS (SELECT *, odd = 0 AS even FROM dd WHERE nz > 0), df AS (SELECT *, CASE WHEN even = lag(even) OVER (PARTITION BY DIRECTION_SK ORDER BY date) THEN 0 ELSE 1 END AS new FROM de),
dg AS (SELECT *, sum(new) OVER (PARTITION BY DIRECTION_SK ORDER BY date) AS run FROM df),
dr AS (SELECT {O.K}, run, min(date) AS start, max(date) AS "end", count(*) AS days, CAST(sum(nz) AS BIGINT) AS nonzero_slots FROM dg WHERE even GROUP BY ALL HAVING sum(nz) >= 20),
nr AS (SELECT r.DIRECTION_SK, r.run, g.workday, median(g.tot) AS ref FROM dr r JOIN dg g ON r.DIRECTION_SK = g.DIRECTION_SK AND NOT g.even AND (g.date >= r.start - 60 AND g.date < r.start OR g.date > r."end" AND g.date <= r."end" + 60) GROUP BY ALL),
lv AS (SELECT g.DIRECTION_SK, g.run, median({O.div('g.tot', 'n.ref')}) AS lev FROM dg g LEFT JOIN nr n ON g.DIRECTION_SK = n.DIRECTION_SK AND g.run = n.run AND g.workday = n.workday WHERE g.even GROUP BY ALL)""")
def doubled(spark, d):
    """Counts of one direction, and later of one site, are doubled first, so that there is something to find."""
    twice = (F.col("date").between("2024-01-10", "2024-01-12") & (F.col("DIRECTION_SK") == 21)) | ((F.col("date") > "2024-01-24") & (F.col("SITE_SK") == 3))
    return faults.doubled(_s(spark, d).withColumn("count", F.when(twice, F.col("count") * 2).otherwise(F.col("count"))))


@register("SELECT DIRECTION_SK, min(date) AS start, max(date) AS \"end\", count(*) AS days, CAST(sum(slots) AS BIGINT) AS slots, CAST(sum(matched_slots) AS BIGINT) AS matched_slots, CAST(sum(nonzero_repeats) AS BIGINT) AS nonzero_repeats, CAST(sum(repeated_bikes) AS BIGINT) AS repeated_bikes FROM rr GROUP BY DIRECTION_SK, run",
          more="rd AS (SELECT DIRECTION_SK, date, count(*) AS slots, count(CASE WHEN matched THEN 1 END) AS matched_slots, count(CASE WHEN dropped > 0 THEN 1 END) AS nonzero_repeats, sum(dropped) AS repeated_bikes FROM pdup GROUP BY ALL), " + O.runs("rr", "rd", "DIRECTION_SK", "date", "1"))
def duplicate_runs(spark, d):
    return faults.duplicates(_records(spark, d))


@register(f"SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, min(time) AS start, max(time) AS \"end\", count(*) AS slots, CAST(sum(count) AS BIGINT) AS bikes, {O.he('sum(med)')} AS usual FROM pr GROUP BY SITE_SK, COUNTER_SK, DIRECTION_SK, run",
          more=f"{_USUAL}, hit AS (SELECT * FROM su WHERE count >= 8 AND count >= 3 * greatest(med, 1)), {O.runs('pr', 'hit', 'DIRECTION_SK', 'time', O.Q15)}")
def spikes(spark, d):
    return faults.spikes(_s(spark, d), times=3, min_count=8)


@register("SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, min(week) AS start, max(week) + 6 AS \"end\", count(*) AS weeks, CAST(sum(slots) AS BIGINT) AS slots FROM ar GROUP BY SITE_SK, COUNTER_SK, DIRECTION_SK, run",
          more=f"az AS (SELECT * REPLACE (CASE WHEN date >= DATE '2024-01-08' AND DIRECTION_SK % 2 = 1 THEN count + 1 ELSE count END AS count) FROM s), aw AS (SELECT s.SITE_SK, s.COUNTER_SK, s.DIRECTION_SK, {O.week()} AS week, count(*) AS slots FROM az s JOIN counters c ON s.COUNTER_SK = c.COUNTER_SK AND c.technology = 'CAMERA' GROUP BY ALL HAVING count(CASE WHEN count = 0 THEN 1 END) = 0), " + O.runs("ar", "aw", "DIRECTION_SK", "week", "7"))
def absent_zeros(spark, d):
    """All slots of a week are looked at. Odd directions count one more from the second week on, so that some have no 0."""
    more = (F.col("date") >= "2024-01-08") & (F.col("DIRECTION_SK") % 2 == 1)
    return faults.absent_zeros(_s(spark, d).withColumn("count", F.when(more, F.col("count") + 1).otherwise(F.col("count"))), X.counters(spark))


# --- comparison of decisions ----------------------------------------------------------------------------------------
@register("SELECT 'old' AS version, action, count(*) AS decisions FROM oall WHERE NOT rejected GROUP BY action UNION ALL SELECT 'new', action, count(*) FROM call WHERE NOT rejected GROUP BY action", "old")
def action_counts(spark, d):
    return compare.action_counts(X.decisions(spark, X.OLD_DECISIONS), X.decisions(spark))


@register("""SELECT CASE WHEN e IS NULL THEN 'ongoing' ELSE 'factor' END AS reason, action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", factor, left(diagnosis, 120) AS diagnosis FROM oall WHERE NOT rejected AND (e IS NULL OR action = 'scale' AND factor <> 0.5)""", "old")
def listed_decisions(spark, d):
    return compare.listed(X.decisions(spark, X.OLD_DECISIONS))


@register("SELECT fix, coalesce(o.n, 0) AS old, coalesce(c.n, 0) AS new FROM (SELECT fix, count(*) AS n FROM ofinal WHERE fix IS NOT NULL GROUP BY fix) o FULL JOIN (SELECT fix, count(*) AS n FROM cfinal WHERE fix IS NOT NULL GROUP BY fix) c USING (fix)", "old")
def fix_diff(spark, d):
    return compare.fix_diff(*_both(spark, d))


@register("SELECT (SELECT CAST(coalesce(sum(raw), 0) AS BIGINT) FROM cfinal WHERE count IS NULL) AS missing_raw_bikes, count(*) AS series_weeks, CAST(coalesce(sum(bikes), 0) AS BIGINT) AS bikes, count(CASE WHEN complete_days = 7 THEN 1 END) AS full_weeks FROM wk", "series")
def verdict_totals(spark, d):
    f = cut(_final(spark, d))
    return compare.totals(f, series.weekly_series(f, _parts(spark, f)))


@register(f"""SELECT * FROM (SELECT SITE_SK, series, a.weeks, a.mean, b.weeks AS weeks_new, b.mean AS mean_new, coalesce(b.weeks, 0) - coalesce(a.weeks, 0) AS d_weeks, {O.he(O.div('b.mean', 'a.mean'), 3)} AS mean_ratio FROM fa a FULL JOIN fb b USING (SITE_SK, series))
  WHERE abs(d_weeks) >= 4 OR abs(mean_ratio - 1) >= 0.02 OR mean_ratio IS NULL""", "old",
          more=O.parts("v", "ofinal", []) + ", " + O.weekly("wo", "ofinal", "vparts") + ", " + O.weekly("wn", "cfinal", "vparts") + f", fa AS (SELECT SITE_SK, series, count(*) AS weeks, {O.he('avg(bikes)')} AS mean FROM wo WHERE complete_days = 7 GROUP BY ALL), fb AS (SELECT SITE_SK, series, count(*) AS weeks, {O.he('avg(bikes)')} AS mean FROM wn WHERE complete_days = 7 GROUP BY ALL)")
def weekly_diff(spark, d):
    return compare.weekly_diff(*map(cut, _both(spark, d)), X.directions(spark), X.counters(spark))


def _span(spark, d):
    return slots.slot_table(_records(spark, d)).groupBy(*KEYS).agg(F.min("date").alias("first"), F.max("date").alias("last"))


def _series(name: str, joined: bool) -> str:
    return f"""{name} AS (SELECT SITE_SK, series, string_agg(COUNTER_SK || ':' || DIRECTION_SK || ':' || a || ':' || b, ';' ORDER BY COUNTER_SK, DIRECTION_SK) AS key, count(DISTINCT (COUNTER_SK, DIRECTION_SK)) > 1 AS several
  FROM (SELECT *, CASE WHEN SITE_SK % 3 = 0 AND {joined} THEN 'S' || SITE_SK ELSE 'D' || DIRECTION_SK END AS series, CASE WHEN SITE_SK % 3 = 1 AND {joined} THEN z - 1 ELSE z END AS b
        FROM (SELECT {O.K}, min(date) AS a, max(date) AS z FROM slots GROUP BY ALL)) GROUP BY SITE_SK, series)"""


@register("""SELECT SITE_SK, series, 'unchanged' AS state, false AS joined FROM sold WHERE (SITE_SK, key) IN (SELECT SITE_SK, key FROM snew) UNION ALL SELECT SITE_SK, series, 'only old', false FROM sold WHERE (SITE_SK, key) NOT IN (SELECT SITE_SK, key FROM snew)
  UNION ALL SELECT SITE_SK, series, 'only new', several FROM snew WHERE (SITE_SK, key) NOT IN (SELECT SITE_SK, key FROM sold)""", more=_series("sold", False) + ", " + _series("snew", True))
def series_diff(spark, d):
    span = cut(_span(spark, d))
    return compare.series_diff(X.derived_parts(span, False), X.derived_parts(span, True))


@register("SELECT 'old' AS version, (SELECT count(*) FROM oall) AS decisions, (SELECT count(DISTINCT (SITE_SK, series)) FROM sold) AS series UNION ALL SELECT 'new', (SELECT count(*) FROM call), (SELECT count(DISTINCT (SITE_SK, series)) FROM snew)", "old", more=_series("sold", False) + ", " + _series("snew", True))
def verdict_sizes(spark, d):
    span = cut(_span(spark, d))
    return compare.sizes(X.decisions(spark, X.OLD_DECISIONS), X.decisions(spark), X.derived_parts(span, False), X.derived_parts(span, True))


# decisions that a rule makes of the days that directions have: more of them than the literal ones, from all of the table
def _derived(name: str, turn: int) -> str:
    kinds = "['missing', 'scale', 'subtract_other', 'drop_duplicates', 'direction_unreliable', 'uncertain']"
    return f"""{name} AS (SELECT list_extract({kinds}, k % 6 + 1) AS action, SITE_SK, CASE WHEN DIRECTION_SK % 4 <> 0 THEN DIRECTION_SK END AS DIRECTION_SK, CAST(date AS VARCHAR) AS b, CASE WHEN day(date) % 5 <> 0 THEN CAST(date + CAST(DIRECTION_SK % 3 AS INTEGER) AS VARCHAR) END AS e,
  CASE WHEN k % 6 = 1 THEN CASE WHEN day(date) % 2 = 0 THEN 0.5 ELSE 0.25 END END::DOUBLE AS factor, day(date) % 9 = 0 AS rejected, 'Camera day ' || date AS diagnosis FROM (SELECT *, DIRECTION_SK + day(date) AS k FROM daily) WHERE k % 4 = {turn})"""


_TWO = _derived("od", 0) + ", " + _derived("nd", 1)


def _two(spark, d):
    days_ = cut(views.daily(_s(spark, d)))
    return [X.derived_decisions(days_, turn) for turn in (0, 1)]


@register("SELECT 'old' AS version, action, count(*) AS decisions FROM od WHERE NOT rejected GROUP BY action UNION ALL SELECT 'new', action, count(*) FROM nd WHERE NOT rejected GROUP BY action", more=_TWO)
def derived_action_counts(spark, d):
    return compare.action_counts(*_two(spark, d))


@register("""SELECT CASE WHEN e IS NULL THEN 'ongoing' ELSE 'factor' END AS reason, action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", factor, left(diagnosis, 120) AS diagnosis FROM nd WHERE NOT rejected AND (e IS NULL OR action = 'scale' AND factor <> 0.5)""", more=_TWO)
def derived_listed(spark, d):
    return compare.listed(_two(spark, d)[1])


@register("""SELECT action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", left(diagnosis, 120) AS diagnosis FROM od o WHERE NOT rejected AND action IN ('scale', 'direction_unreliable', 'subtract_other', 'drop_duplicates') AND NOT EXISTS
  (SELECT 1 FROM nd n WHERE NOT n.rejected AND n.action = o.action AND n.SITE_SK = o.SITE_SK AND n.b <= coalesce(o.e, '9999-12-31') AND o.b <= coalesce(n.e, '9999-12-31'))""", more=_TWO)
def derived_dropped(spark, d):
    return compare.flag_dropped(*_two(spark, d))


@register("""SELECT action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", left(diagnosis, 100) AS diagnosis FROM nd WHERE NOT rejected AND action <> 'uncertain' AND e IS NOT NULL AND e >= CAST((SELECT max(date) FROM slots) - 3 AS VARCHAR)""", more=_TWO)
def derived_tail(spark, d):
    return compare.flag_tail(_two(spark, d)[1], slots.slot_table(_records(spark, d)))


@register("""SELECT COUNTER_SK, b AS start, e AS "end", array_to_string(list_sort(list(DISTINCT m.SITE_SK)), ',') AS at, array_to_string(any_value(sites), ',') AS sites FROM od m JOIN co c ON list_contains(c.sites, m.SITE_SK) WHERE NOT rejected AND action = 'missing' GROUP BY COUNTER_SK, b, e
  HAVING count(DISTINCT m.SITE_SK) < any_value(len(sites))""", more=_TWO + ", co AS (SELECT COUNTER_SK, list_sort(list(DISTINCT SITE_SK)) AS sites FROM slots GROUP BY COUNTER_SK HAVING count(DISTINCT SITE_SK) > 1)")
def derived_scope(spark, d):
    """All diagnoses speak of a camera, so that a span at one of its sites is enough."""
    return compare.flag_scope(_two(spark, d)[0], slots.slot_table(_records(spark, d)))


@register("""SELECT action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", left(diagnosis, 120) AS diagnosis FROM oall o WHERE NOT rejected AND action IN ('scale', 'direction_unreliable', 'subtract_other', 'drop_duplicates') AND NOT EXISTS
  (SELECT 1 FROM call n WHERE NOT n.rejected AND n.action = o.action AND n.SITE_SK = o.SITE_SK AND left(n.b, 10) <= left(coalesce(o.e, '9999-12-31'), 10) AND left(o.b, 10) <= left(coalesce(n.e, '9999-12-31'), 10))""", "old")
def flag_dropped(spark, d):
    return compare.flag_dropped(X.decisions(spark, X.OLD_DECISIONS), X.decisions(spark))


@register("""SELECT action, SITE_SK, DIRECTION_SK, b AS start, e AS "end", left(diagnosis, 100) AS diagnosis FROM oall WHERE NOT rejected AND action NOT IN ('uncertain', 'restore') AND e IS NOT NULL AND left(e, 10) >= CAST((SELECT max(date) FROM slots) - 3 AS VARCHAR)""", "old")
def flag_tail(spark, d):
    return compare.flag_tail(X.decisions(spark, X.OLD_DECISIONS), slots.slot_table(_records(spark, d)))


@register("""SELECT c.COUNTER_SK, m.b AS start, m.e AS "end", array_to_string(list_sort(list(DISTINCT m.SITE_SK)), ',') AS at, array_to_string(any_value(c.sites), ',') AS sites FROM mi m JOIN co c ON list_contains(c.sites, m.SITE_SK) GROUP BY c.COUNTER_SK, m.b, m.e
  HAVING count(DISTINCT m.SITE_SK) < any_value(len(c.sites)) AND (count(DISTINCT m.SITE_SK) > 1 OR bool_or(regexp_matches(m.text, 'camera|counter-wide|every zone|all zones|whole counter|all sites|every site')))""", "old",
          more="""tx AS (SELECT b, e, lower(string_agg(diagnosis, ' ')) AS text FROM call WHERE NOT rejected GROUP BY b, e), mi AS (SELECT DISTINCT c.b, c.e, c.SITE_SK, tx.text FROM call c JOIN tx ON c.b = tx.b AND c.e IS NOT DISTINCT FROM tx.e WHERE NOT rejected AND action = 'missing'),
co AS (SELECT COUNTER_SK, list_sort(list(DISTINCT SITE_SK)) AS sites FROM slots GROUP BY COUNTER_SK HAVING count(DISTINCT SITE_SK) > 1)""")
def flag_scope(spark, d):
    return compare.flag_scope(X.decisions(spark), slots.slot_table(_records(spark, d)))


@register(f"""SELECT SITE_SK, COUNTER_SK, a AS DIRECTION_SK, q, {O.he('before', 2)} AS before, {O.he('share', 2)} AS share FROM (SELECT *, lag(share) OVER (PARTITION BY SITE_SK, COUNTER_SK ORDER BY q) AS before FROM sx) WHERE (before - 0.5) * (share - 0.5) < 0 AND abs(share - before) > 0.25""",
          more=f"""sq AS (SELECT {O.K}, CASE WHEN date < DATE '2024-01-15' THEN DATE '2023-10-01' ELSE DATE '2024-01-01' END AS q, sum(count) AS am FROM (SELECT * REPLACE (CASE WHEN date >= DATE '2024-01-15' AND DIRECTION_SK % 2 = 0 OR date < DATE '2024-01-15' AND DIRECTION_SK % 2 = 1 THEN count * 9 ELSE count END AS count) FROM s) WHERE workday AND hour(time) BETWEEN 7 AND 8 AND COUNTER_SK <> 102 GROUP BY ALL),
st AS (SELECT SITE_SK, COUNTER_SK, min(DIRECTION_SK) AS a FROM sq GROUP BY ALL HAVING count(DISTINCT DIRECTION_SK) = 2),
sx AS (SELECT *, x / (x + y) AS share FROM (SELECT q.SITE_SK, q.COUNTER_SK, a, q, sum(CASE WHEN DIRECTION_SK = a THEN am END) AS x, sum(CASE WHEN DIRECTION_SK <> a THEN am END) AS y FROM sq q JOIN st t ON q.SITE_SK = t.SITE_SK AND q.COUNTER_SK = t.COUNTER_SK GROUP BY ALL) WHERE x IS NOT NULL AND y IS NOT NULL AND x + y >= 20)""")
def flag_swap(spark, d):
    """The table covers a month: its first half stands for a quarter, and counts are weighted so that shares flip."""
    late = F.col("date") >= "2024-01-15"
    heavy = (late & (F.col("DIRECTION_SK") % 2 == 0)) | (~late & (F.col("DIRECTION_SK") % 2 == 1))
    s = _s(spark, d).withColumn("count", F.when(heavy, F.col("count") * 9).otherwise(F.col("count")))
    s = s.withColumn("date", F.when(late, F.col("date")).otherwise(F.date_sub("date", 31)))
    return compare.flag_swap(s, X.counters(spark), min_total=20)


@register("SELECT f.SITE_SK, f.COUNTER_SK, p.SITE_SK AS series_site, p.series, p.COUNTER_SK AS part_counter, p.DIRECTION_SK AS part_direction, p.a AS start, p.z AS \"end\" FROM (SELECT DISTINCT SITE_SK, COUNTER_SK FROM slots WHERE SITE_SK % 2 = 0) f LEFT JOIN (SELECT DISTINCT SITE_SK, series, COUNTER_SK FROM sp) u ON u.COUNTER_SK = f.COUNTER_SK LEFT JOIN sp p ON p.SITE_SK = u.SITE_SK AND p.series = u.series",
          more=f"sp AS (SELECT *, 'S' || SITE_SK AS series FROM (SELECT {O.K}, min(date) AS a, max(date) AS z FROM slots GROUP BY ALL) WHERE SITE_SK % 3 = 0)")
def swap_series(spark, d):
    """Every second site stands for those that flip; series are those that the rule joins."""
    span = cut(_span(spark, d))
    return compare.swap_series(span.where("SITE_SK % 2 = 0"), X.derived_parts(span, True).where("SITE_SK % 3 = 0"))


@register("SELECT SITE_SK, series, median(bikes) AS median, count(CASE WHEN bikes = 0 THEN 1 END) AS zero_weeks FROM (SELECT SITE_SK, series, CASE WHEN week = DATE '2024-01-08' THEN 0 ELSE bikes END AS bikes FROM wk WHERE complete_days = 7) GROUP BY ALL HAVING median(bikes) >= 50 AND count(CASE WHEN bikes = 0 THEN 1 END) > 0", "series")
def zero_weeks(spark, d):
    f = cut(_final(spark, d))
    w = series.weekly_series(f, _parts(spark, f))
    return compare.zero_weeks(w.withColumn("bikes", F.when(F.col("week") == "2024-01-08", F.lit(0)).otherwise(F.col("bikes"))))


# --- audits ---------------------------------------------------------------------------------------------------------
@register(f"SELECT {O.K}, date, CAST(sum(count) AS BIGINT) AS bikes, count(*) AS slots, count(CASE WHEN count = 0 THEN 1 END) AS zero_slots, count(CASE WHEN count > 0 THEN 1 END) AS nonzero_slots, count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd_slots, CAST(sum(CASE WHEN slot < 20 THEN count ELSE 0 END) AS BIGINT) AS night, CAST(sum(CASE WHEN slot BETWEEN 28 AND 75 THEN count ELSE 0 END) AS BIGINT) AS day7_19, max(count) AS max_slot, any_value(warn) AS warn FROM s JOIN (SELECT SITE_SK, COUNTER_SK, DIRECTION_SK, date, bool_or(status = 1) AS warn FROM recs GROUP BY ALL) w USING (SITE_SK, COUNTER_SK, DIRECTION_SK, date) GROUP BY ALL")
def direction_days(spark, d):
    r = _records(spark, d)
    return audit.direction_days(views.slots(r, X.dates(spark)), r)


@register("SELECT COUNTER_SK, date, slot, time, CAST(sum(count) AS BIGINT) AS bikes, count(DISTINCT s.DIRECTION_SK) AS directions, CAST(sum(CASE WHEN way = 'IN' THEN count ELSE 0 END) AS BIGINT) AS n_in, CAST(sum(CASE WHEN way = 'OUT' THEN count ELSE 0 END) AS BIGINT) AS n_out FROM s LEFT JOIN directions d ON s.DIRECTION_SK = d.DIRECTION_SK GROUP BY ALL")
def counter_slots(spark, d):
    return audit.counter_slots(_s(spark, d), X.directions(spark))


@register(f"""SELECT COUNTER_SK, date, bikes, med, {O.he(O.div('bikes', 'med'), 3)} AS rel FROM (SELECT COUNTER_SK, date, bikes, CASE WHEN count(*) OVER w >= 10 THEN quantile_cont(bikes, 0.5) OVER w END AS med FROM rf WINDOW w AS (PARTITION BY COUNTER_SK ORDER BY date ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING))""",
          more="rb AS (SELECT COUNTER_SK, date, CAST(sum(count) AS BIGINT) AS bikes FROM s GROUP BY ALL), rs AS (SELECT COUNTER_SK, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT COUNTER_SK, min(date) AS a, max(date) AS b FROM rb GROUP BY ALL)), rf AS (SELECT rs.COUNTER_SK, rs.date, coalesce(bikes, 0) AS bikes FROM rs LEFT JOIN rb ON rs.COUNTER_SK = rb.COUNTER_SK AND rs.date = rb.date)")
def rolling_median_level(spark, d):
    return audit.rolling_level(_s(spark, d))


@register(f"SELECT COUNTER_SK, min(time) AS start, max(time) AS \"end\", count(*) / 4 AS hours, coalesce(sum(usual), 0) AS usual_bikes, {O.he('avg(CAST(bikes IS NULL AS INT))', 2)} AS absent FROM gr GROUP BY COUNTER_SK, run HAVING sum(usual) >= 15",
          more=f"""gc AS (SELECT COUNTER_SK, date, slot, time, workday, sum(count) AS bikes FROM s GROUP BY ALL), gu AS (SELECT COUNTER_SK, workday, slot, median(bikes) AS usual FROM gc GROUP BY ALL),
gg AS (SELECT COUNTER_SK, unnest(generate_series(a, b, INTERVAL 15 MINUTE)) AS time FROM (SELECT COUNTER_SK, min(time) AS a, max(time) AS b FROM gc GROUP BY ALL)),
gf AS (SELECT g.COUNTER_SK, g.time, c.bikes, coalesce(d.day_type = 'Weekday (excl. PH)', isodow(CAST(g.time AS DATE)) <= 5) AS workday, hour(g.time) * 4 + minute(g.time) // 15 AS slot FROM gg g LEFT JOIN gc c ON g.COUNTER_SK = c.COUNTER_SK AND g.time = c.time LEFT JOIN dates d ON d.date = CAST(g.time AS DATE)),
gz AS (SELECT f.*, u.usual FROM gf f LEFT JOIN gu u ON f.COUNTER_SK = u.COUNTER_SK AND f.workday = u.workday AND f.slot = u.slot WHERE coalesce(f.bikes, 0) = 0), {O.runs('gr', 'gz', 'COUNTER_SK', 'time', O.Q15)}""")
def outage_runs(spark, d):
    return audit.outage_runs(_s(spark, d), X.dates(spark))


_LEVELS = f"""pd AS (SELECT {O.K}, date, sum(count) AS bikes, count(DISTINCT slot) AS slots FROM s WHERE workday GROUP BY ALL HAVING count(DISTINCT slot) >= 10),
ps AS (SELECT SITE_SK, COUNTER_SK, date, sum(bikes) AS bikes FROM pd GROUP BY ALL HAVING sum(bikes) > 0),
pl AS (SELECT SITE_SK, COUNTER_SK, {O.week()} AS period, median(bikes) AS v, count(*) AS n FROM ps GROUP BY ALL HAVING count(*) >= 3)"""


@register("SELECT SITE_SK, COUNTER_SK, period, v, n FROM pl", more=_LEVELS)
def period_levels(spark, d):
    return audit.period_levels(_s(spark, d), "week", 3, Settings(complete_slots=10))


@register(f"SELECT SITE_SK, count(*) AS periods, {O.he('median(r)', 3)} AS site_ratio, {O.he('median(control)', 3)} AS control_ratio, {O.he('median(r / control)', 3)} AS step, {O.he('min(r / control)', 3)} AS low, {O.he('max(r / control)', 3)} AS high FROM ra GROUP BY SITE_SK",
          more=_LEVELS + ", " + O._values("cases", "a, b, c, d, e", CASES, "CAST(a AS SMALLINT) AS SITE_SK, b AS old_counter, c AS new_counter, CAST(d AS DATE) AS period, CAST(e AS DATE) AS before") + ", " + O._values("controls", "a, b", CONTROLS, "a AS SITE_SK, b AS COUNTER_SK") + """,
cn AS (SELECT t.period, t.before, exp(avg(ln(x.v / y.v))) AS control FROM (SELECT DISTINCT period, before FROM cases) t JOIN controls k ON true JOIN pl x ON x.SITE_SK = k.SITE_SK AND x.COUNTER_SK = k.COUNTER_SK AND x.period = t.period JOIN pl y ON y.SITE_SK = k.SITE_SK AND y.COUNTER_SK = k.COUNTER_SK AND y.period = t.before GROUP BY ALL HAVING count(*) = 2),
ra AS (SELECT c.SITE_SK, a.v / b.v AS r, control FROM cases c JOIN pl a ON a.SITE_SK = c.SITE_SK AND a.COUNTER_SK = c.new_counter AND a.period = c.period JOIN pl b ON b.SITE_SK = c.SITE_SK AND b.COUNTER_SK = c.old_counter AND b.period = c.before JOIN cn ON cn.period = c.period AND cn.before = c.before)""")
def replacement_step(spark, d):
    levels = audit.period_levels(_s(spark, d), "week", 3, Settings(complete_slots=10))
    cases = spark.createDataFrame(CASES, "SITE_SK smallint, old_counter smallint, new_counter smallint, period string, before string").withColumns({c: F.col(c).cast("date") for c in ("period", "before")})
    return audit.replacement_step(levels, cases, spark.createDataFrame(CONTROLS, "SITE_SK smallint, COUNTER_SK smallint"))


@register(f"SELECT count(*) AS days, CAST(sum(o) AS BIGINT) AS old_bikes, CAST(sum(n) AS BIGINT) AS new_bikes, {O.he(O.div('sum(n)', 'sum(o)'), 3)} AS ratio FROM (SELECT date, sum(CASE WHEN COUNTER_SK = 100 THEN count END) AS o, sum(CASE WHEN COUNTER_SK = 101 THEN count END) AS n FROM daily WHERE SITE_SK = 1 AND slots >= 2 GROUP BY date) WHERE o IS NOT NULL AND n IS NOT NULL")
def overlap_ratio(spark, d):
    return audit.overlap_ratio(_s(spark, d), 1, 100, 101, Settings(complete_slots=2))


@register("SELECT f.date, vendor, count(*) AS direction_days, count(CASE WHEN odd = 0 AND nz >= 2 THEN 1 END) AS even_days, count(CASE WHEN bikes = 0 THEN 1 END) AS zero_days, count(CASE WHEN f.records >= 1.25 * usual THEN 1 END) AS record_days FROM fd f JOIN pusual u ON f.DIRECTION_SK = u.DIRECTION_SK AND f.month = u.month LEFT JOIN counters c ON f.COUNTER_SK = c.COUNTER_SK GROUP BY ALL",
          more=f"fd AS (SELECT {O.K}, date, {O.week(unit='month')} AS month, sum(count) AS bikes, count(CASE WHEN count > 0 THEN 1 END) AS nz, count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd, avg(records) AS records FROM s GROUP BY ALL)")
def feed_wide_days(spark, d):
    return audit.feed_days(_s(spark, d), X.counters(spark), 2)


_PLANTED = "date = DATE '2024-01-11' AND DIRECTION_SK = 21 THEN count * 2 WHEN date = DATE '2024-01-17' AND COUNTER_SK = 102 THEN 0 WHEN date = DATE '2024-01-19' AND DIRECTION_SK % 2 = 0 THEN count + 40"


@register("SELECT date, vendor, pattern, count(*) AS places FROM (SELECT COUNTER_SK, date, 'even' AS pattern FROM pe WHERE odd = 0 AND nz >= 2 AND o1 > 0 AND o2 > 0 AND d1 = date - 1 AND d2 = date + 1 UNION ALL SELECT w.COUNTER_SK, w.date, 'zero' FROM pw w JOIN pu u ON w.COUNTER_SK = u.COUNTER_SK AND w.wd = u.wd WHERE bikes = 0 AND usual >= 10 UNION ALL SELECT COUNTER_SK, date, 'covers' FROM pc) x LEFT JOIN counters c USING (COUNTER_SK) GROUP BY ALL",
          more=f"""ph AS (SELECT * REPLACE (CASE WHEN {_PLANTED} ELSE count END AS count) FROM s),
pe AS (SELECT *, lag(odd) OVER w AS o1, lead(odd) OVER w AS o2, lag(date) OVER w AS d1, lead(date) OVER w AS d2 FROM (SELECT {O.K}, date, count(CASE WHEN count > 0 THEN 1 END) AS nz, count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd FROM ph GROUP BY ALL) WINDOW w AS (PARTITION BY DIRECTION_SK ORDER BY date)),
pw AS (SELECT COUNTER_SK, date, isodow(date) AS wd, sum(count) AS bikes FROM ph GROUP BY ALL), pu AS (SELECT COUNTER_SK, wd, median(bikes) AS usual FROM pw GROUP BY ALL),
pr AS (SELECT {O.K}, date, slot // 4 AS h, sum(count) AS n FROM ph GROUP BY ALL),
pc AS (SELECT a.COUNTER_SK, a.date FROM pr a JOIN pr b ON a.SITE_SK = b.SITE_SK AND a.COUNTER_SK = b.COUNTER_SK AND a.date = b.date AND a.h = b.h AND a.DIRECTION_SK <> b.DIRECTION_SK GROUP BY a.SITE_SK, a.COUNTER_SK, a.date, a.DIRECTION_SK, b.DIRECTION_SK HAVING bool_and(a.n >= b.n) AND count(*) >= 2 AND sum(b.n) > 0)""")
def feed_wide_patterns(spark, d):
    """One direction's day is doubled, a counter's day set to 0, and some directions get a day of many bikes."""
    n = F.when((F.col("date") == "2024-01-11") & (F.col("DIRECTION_SK") == 21), F.col("count") * 2).when((F.col("date") == "2024-01-17") & (F.col("COUNTER_SK") == 102), F.lit(0))
    n = n.when((F.col("date") == "2024-01-19") & (F.col("DIRECTION_SK") % 2 == 0), F.col("count") + 40).otherwise(F.col("count"))
    return audit.feed_patterns(_s(spark, d).withColumn("count", n), X.counters(spark), 2, 10, 2)


@register(f"SELECT {O.K}, week, am, pm, share, {O.he('share - lag(share) OVER (PARTITION BY ' + O.K + ' ORDER BY week)', 3)} AS change FROM (SELECT *, {O.he('am / (am + pm)', 3)} AS share FROM aa WHERE am + pm > 0)",
          more=f"aa AS (SELECT {O.K}, {O.week()} AS week, CAST(sum(CASE WHEN hour(time) BETWEEN 6 AND 8 THEN count ELSE 0 END) AS BIGINT) AS am, CAST(sum(CASE WHEN hour(time) BETWEEN 16 AND 18 THEN count ELSE 0 END) AS BIGINT) AS pm FROM s WHERE workday GROUP BY ALL)")
def am_share_swap(spark, d):
    return audit.am_share(_s(spark, d))


@register(f"SELECT COUNTER_SK, date, before, after, {O.he(O.div('after', 'before'), 3)} AS step FROM (SELECT *, CASE WHEN count(*) OVER b >= 5 THEN quantile_cont(bikes, 0.5) OVER b END AS before, CASE WHEN count(*) OVER a >= 5 THEN quantile_cont(bikes, 0.5) OVER a END AS after FROM wd WINDOW b AS (PARTITION BY COUNTER_SK ORDER BY date RANGE BETWEEN INTERVAL 21 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), a AS (PARTITION BY COUNTER_SK ORDER BY date RANGE BETWEEN CURRENT ROW AND INTERVAL 20 DAY FOLLOWING)) WHERE before IS NOT NULL AND after IS NOT NULL",
          more="wd AS (SELECT COUNTER_SK, date, sum(count) AS bikes FROM s WHERE workday GROUP BY ALL)")
def step_scan(spark, d):
    return audit.steps(_s(spark, d))


@register("""SELECT z.SITE_SK, z.DIRECTION_SK, z.start, z."end", z.usual_bikes FROM zz z WHERE NOT EXISTS (SELECT 1 FROM cdec d WHERE d.action = 'zero_fill' AND d.SITE_SK = z.SITE_SK AND (d.DIRECTION_SK IS NULL OR d.DIRECTION_SK = z.DIRECTION_SK) AND d.start <= z.start AND coalesce(d."end", TIMESTAMP '9999-12-31') >= z."end")""", "clean",
          more=f"{_USUAL}, z AS (SELECT * FROM su WHERE count = 0), {O.runs('zr', 'z', O.K, 'time', O.Q15)}, zz AS (SELECT {O.K}, min(time) AS start, max(time) AS \"end\", {O.he('sum(mean)')} AS usual_bikes FROM zr GROUP BY {O.K}, run HAVING {O.he('sum(mean)')} >= 2)")
def uncovered_runs(spark, d):
    runs = faults.zeros(_s(spark, d), min_hours=0)
    return audit.uncovered(runs, _dec(spark), "zero_fill", 2).select("SITE_SK", "DIRECTION_SK", "start", "end", "usual_bikes")


@register(f"SELECT SITE_SK, o.date, o.bikes, {O.he('rel', 3)} AS rel, {O.he('net', 3)} AS network FROM (SELECT l.*, {O.div('l.bikes', 'u.usual')} AS rel FROM ll l JOIN (SELECT SITE_SK, workday, median(bikes) AS usual FROM ll GROUP BY ALL) u USING (SITE_SK, workday)) o JOIN (SELECT date, {O.div('w.bikes', 'v.usual')} AS net FROM ln w JOIN (SELECT workday, median(bikes) AS usual FROM ln GROUP BY ALL) v USING (workday)) n ON o.date = n.date WHERE rel < 0.6 AND net > 0.6",
          more="ll AS (SELECT SITE_SK, date, workday, CAST(sum(count) AS BIGINT) AS bikes FROM s GROUP BY ALL), ln AS (SELECT date, workday, sum(bikes) AS bikes FROM ll GROUP BY ALL)")
def local_lows(spark, d):
    return audit.local_lows(_s(spark, d), 0.6, 0.6)


@register("SELECT e.date, count(DISTINCT COUNTER_SK) AS counters FROM du e JOIN pusual u ON e.DIRECTION_SK = u.DIRECTION_SK AND e.month = u.month WHERE e.records >= 1.1 * usual GROUP BY e.date HAVING count(DISTINCT COUNTER_SK) >= 3",
          more=f"du AS (SELECT {O.K}, date, {O.week(unit='month')} AS month, avg(records) AS records FROM s GROUP BY ALL HAVING count(*) >= 20)")
def duplicate_days(spark, d):
    return audit.duplicate_days(_s(spark, d), 1.1, 3, SPARSE)


def _shapes(by: str) -> str:
    return f"SELECT {by}, month, nz, {O.he('odd / nz', 3)} AS odd_share, {O.he(O.div('night', 'bikes'), 3)} AS night_share, {O.he(O.div('n_in', 'n_out'), 3)} AS in_out, odd < 0.05 * nz AS looks_doubled FROM (SELECT {by}, {O.week(unit='month')} AS month, count(CASE WHEN count > 0 THEN 1 END) AS nz, count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd, sum(count) AS bikes, sum(CASE WHEN slot < 20 THEN count ELSE 0 END) AS night, sum(CASE WHEN way = 'IN' THEN count ELSE 0 END) AS n_in, sum(CASE WHEN way = 'OUT' THEN count ELSE 0 END) AS n_out FROM s LEFT JOIN directions d USING (DIRECTION_SK) GROUP BY ALL) WHERE nz >= 40"


@register(_shapes("COUNTER_SK"))
def shape_shares(spark, d):
    return audit.shapes(_s(spark, d), X.directions(spark))


@register(_shapes("SITE_SK, DIRECTION_SK"))
def shape_shares_by_zone(spark, d):
    return audit.shapes(_s(spark, d), X.directions(spark), by=("SITE_SK", "DIRECTION_SK"))


# --- primitives that no query above shows alone ---------------------------------------------------------------------
@register(f"SELECT DIRECTION_SK, CAST(run AS BIGINT) AS run, min(date) AS start, max(date) AS \"end\", count(*) AS days FROM xr GROUP BY DIRECTION_SK, run", more="xd AS (SELECT DISTINCT DIRECTION_SK, date FROM s WHERE count >= 9), " + O.runs("xr", "xd", "DIRECTION_SK", "date", "1"))
def busy_runs(spark, d):
    x = _s(spark, d).where("count >= 9").select("DIRECTION_SK", "date").distinct()
    return with_run(x, ["DIRECTION_SK"], "date", days(1)).groupBy("DIRECTION_SK", "run").agg(F.min("date").alias("start"), F.max("date").alias("end"), F.count("*").alias("days"))


@register(f"SELECT count, {O.he('count * 0.5')} AS half, {O.he('count / 3.0', 1)} AS third, count(*) AS n FROM s GROUP BY count")
def half_even_rounding(spark, d):
    return _s(spark, d).groupBy("count").agg(F.count("*").alias("n")).select("count", half_even(F.col("count") * 0.5).alias("half"), half_even(F.col("count") / 3.0, 1).alias("third"), "n")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)

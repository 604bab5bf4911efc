"""DuckDB SQL for the registered queries. Common table expressions are shared; an engine runs only those that it needs."""

from __future__ import annotations

from ..settings import ACTIONS, NOTES
from ..sources import fixture as X

K = "SITE_SK, COUNTER_SK, DIRECTION_SK"


def _v(x: object) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    return repr(x) if isinstance(x, int | float) else "'" + str(x).replace("'", "''") + "'"


def _values(name: str, cols: str, rows: list[tuple], casts: str) -> str:
    body = ", ".join("(" + ", ".join(map(_v, r)) + ")" for r in rows)
    return f"{name} AS (SELECT {casts} FROM (VALUES {body}) t({cols}))"


def _values_sql(rows: list[tuple], cols: str, casts: str) -> str:
    return f"SELECT {casts} FROM (VALUES " + ", ".join("(" + ", ".join(map(_v, r)) + ")" for r in rows) + f") t({cols})"


def he(x: str, n: int = 0) -> str:
    return f"(round_even(CAST({x} AS DOUBLE) * {10.0**n}, 0) / {10.0**n})" if n else f"round_even(CAST({x} AS DOUBLE), 0)"


def div(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    return f"(CASE WHEN {b} <> 0 THEN {a} / {b} WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN {a} = 0 THEN CAST('nan' AS DOUBLE) WHEN {a} > 0 THEN CAST('inf' AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END)"


def corr(a: str, b: str) -> str:
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
    va, vb = (f"(count(*) * sum({x} * {x}) - sum({x}) * sum({x}))" for x in (a, b))
    return f"(CASE WHEN {va} <= 0 OR {vb} <= 0 THEN CAST('nan' AS DOUBLE) ELSE (count(*) * sum({a} * {b}) - sum({a}) * sum({b})) / (sqrt(greatest({va}, 0)) * sqrt(greatest({vb}, 0))) END)"


def time(d: str = "date", s: str = "slot") -> str:
    return f"(CAST({d} AS TIMESTAMP) + to_minutes(15 * CAST({s} AS INTEGER)))"


def week(d: str = "date", unit: str = "week") -> str:
    return f"CAST(date_trunc('{unit}', {d}) AS DATE)"


def mode(src: str, by: str, col: str, name: str) -> str:
    return f"(SELECT {by}, {col} AS {name} FROM (SELECT {by}, {col}, count(*) AS c FROM {src} GROUP BY {by}, {col}) QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY c DESC, {col}) = 1)"


def usual(p: str, src: str) -> str:
    day = mode(src, "DIRECTION_SK, date", "records", "m")
    return f"{p}day AS {day}, {p}month AS (SELECT DIRECTION_SK, {week(unit='month')} AS month, m FROM {p}day), {p}usual AS {mode(f'{p}month', 'DIRECTION_SK, month', 'm', 'usual')}"


def repeats(p: str, src: str) -> str:
    return f"""{usual(p, src)},
{p}extra AS (SELECT s.DIRECTION_SK, s.date, s.slot, s.load, u.usual FROM {src} s JOIN {p}usual u ON s.DIRECTION_SK = u.DIRECTION_SK AND {week('s.date', 'month')} = u.month WHERE s.records > u.usual),
{p}val AS (SELECT r.DIRECTION_SK, r.date, r.slot, e.usual, r.n AS v, count(*) AS k FROM recs r JOIN {p}extra e ON r.DIRECTION_SK = e.DIRECTION_SK AND r.date = e.date AND r.slot = e.slot AND r.load = e.load GROUP BY ALL),
{p}one AS (SELECT DIRECTION_SK, date, slot, sum(k) - any_value(usual) AS excess, sum(v * k) AS total FROM {p}val GROUP BY ALL),
{p}rep AS (SELECT DIRECTION_SK, date, slot, v, row_number() OVER (PARTITION BY DIRECTION_SK, date, slot ORDER BY v DESC) AS i FROM (SELECT *, unnest(range(0, k // 2)) AS j FROM {p}val)),
{p}drop AS (SELECT o.DIRECTION_SK, o.date, o.slot, o.excess, o.total, coalesce(sum(r.v) FILTER (WHERE r.i <= o.excess), 0) AS dropped, count(r.v) AS m
  FROM {p}one o LEFT JOIN {p}rep r ON o.DIRECTION_SK = r.DIRECTION_SK AND o.date = r.date AND o.slot = r.slot GROUP BY ALL),
{p}dup AS (SELECT DIRECTION_SK, date, slot, CAST(total - dropped AS BIGINT) AS dedup, CAST(dropped AS BIGINT) AS dropped, m >= excess AS matched FROM {p}drop)"""


BASE = f"""
raw AS (SELECT CAST(user_id % 6 AS SMALLINT) AS SITE_SK,
    CAST(100 + (user_id % 6) // 2 + CASE WHEN user_id % 6 = 1 AND event_id % 10 = 0 THEN 1 ELSE 0 END AS SMALLINT) AS COUNTER_SK,
    CAST((user_id % 6) * 10 + event_id % 2 + CASE WHEN user_id % 6 = 1 AND event_id % 10 = 0 THEN 2 ELSE 0 END AS SMALLINT) AS DIRECTION_SK,
    CAST(ts AS DATE) AS date, CAST(hour(ts) * 4 + minute(ts) // 15 AS SMALLINT) AS slot, event_id AS ID,
    CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value / 10) AS INTEGER) END AS n, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS TINYINT) AS status,
    least(CAST(CAST(ts AS DATE) + 1 + CAST(event_id % 3 = 0 AS INT) AS DATE), DATE '2024-01-30') AS load FROM events),
{_values('counters', 'a, b, c, d', X.COUNTERS, 'CAST(a AS SMALLINT) AS COUNTER_SK, b AS counter_id, c AS technology, d AS vendor')},
{_values('directions', 'a, b, c', X.DIRECTIONS, 'CAST(a AS SMALLINT) AS DIRECTION_SK, b AS orientation, c AS way')},
{_values('sites', 'a, b, c, d', X.SITES, 'CAST(a AS SMALLINT) AS SITE_SK, b AS site_name, CAST(c AS DOUBLE) AS lat, CAST(d AS DOUBLE) AS lon')},
{_values('weather', 'a, b, c', X.WEATHER, 'CAST(a AS DATE) AS date, CAST(b AS DOUBLE) AS rain_mm_to_9am, CAST(c AS DOUBLE) AS max_temp_c')},
dates AS (SELECT date, CASE WHEN date IN ({', '.join(f"DATE '{d}'" for d in X.HOLIDAYS)}) THEN 'Public holiday' WHEN isodow(date) <= 5 THEN 'Weekday (excl. PH)' ELSE 'Weekend' END AS day_type
  FROM (SELECT CAST(unnest(generate_series(DATE '2023-12-31', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS date) WHERE date NOT IN ({', '.join(f"DATE '{d}'" for d in X.UNLISTED)})),
moved AS (SELECT r.*, CASE WHEN c.vendor = 'VivaCity' THEN {time('r.date', 'r.slot')} + INTERVAL 11 HOUR ELSE {time('r.date', 'r.slot')} END AS t FROM raw r LEFT JOIN counters c ON r.COUNTER_SK = c.COUNTER_SK),
recs AS MATERIALIZED (SELECT {K}, CAST(t AS DATE) AS date, CAST(hour(t) * 4 + minute(t) // 15 AS SMALLINT) AS slot, ID, n, status, load FROM moved),
loads AS (SELECT {K}, date, slot, load, sum(n) AS n, count(*) AS records FROM recs GROUP BY ALL),
slots AS MATERIALIZED (SELECT {K}, date, slot, CAST(sum(n) AS INTEGER) AS raw, CAST(first(records ORDER BY n DESC, load) AS SMALLINT) AS records, first(load ORDER BY n DESC, load) AS load FROM loads GROUP BY ALL),
s AS MATERIALIZED (SELECT {', '.join('s.' + k for k in K.split(', '))}, s.date, s.slot, {time('s.date', 's.slot')} AS time, coalesce(d.day_type = 'Weekday (excl. PH)', isodow(s.date) <= 5) AS workday, s.records, s.raw AS count,
    count(CASE WHEN raw > 0 THEN 1 END) OVER w >= 8 AND coalesce(min(CASE WHEN raw > 0 THEN s.slot % 4 END) OVER w = max(CASE WHEN raw > 0 THEN s.slot % 4 END) OVER w, false) AS hourly_binned
  FROM slots s LEFT JOIN dates d ON s.date = d.date WINDOW w AS (PARTITION BY s.DIRECTION_SK, s.date)),
daily AS (SELECT {K}, date, CAST(sum(count) AS BIGINT) AS count, count(*) AS slots, {he('avg(records)', 2)} AS records_per_slot,
    count(CASE WHEN count % 2 = 1 THEN 1 END) AS odd_slots, count(CASE WHEN count > 0 THEN 1 END) AS nonzero_slots, strftime(date, '%a') AS weekday FROM s GROUP BY ALL),
{repeats('p', 'slots')}"""


def cleaned(p: str, rows: list[tuple]) -> str:
    """The cleaning under a list of decisions; its tables are prefixed with p."""
    acts, notes = (", ".join(map(_v, a)) for a in (ACTIONS, NOTES))
    del notes
    at = lambda c, clock: f"strptime(CASE WHEN len({c}) = 10 THEN {c} || '{clock}' ELSE {c} END, '%Y-%m-%d %H:%M')"
    hit = lambda a: f"coalesce(f.{a}, false)"
    return f"""
{_values(p + 'all', 'a, s, d, b, e, f, r, w', rows, "a AS action, CAST(s AS SMALLINT) AS SITE_SK, CAST(d AS SMALLINT) AS DIRECTION_SK, CAST(b AS VARCHAR) AS b, CAST(e AS VARCHAR) AS e, CAST(f AS DOUBLE) AS factor, coalesce(CAST(r AS BOOLEAN), false) AS rejected, w AS diagnosis")},
{p}dec AS (SELECT SITE_SK, DIRECTION_SK, {at('b', ' 00:00')} AS start, {at('e', ' 23:45')} AS "end", action, factor FROM {p}all WHERE NOT rejected AND action IN ({acts})),
{p}keys AS (SELECT DISTINCT {K} FROM slots),
{p}scope AS (SELECT d.SITE_SK, k.COUNTER_SK, d.DIRECTION_SK, start, coalesce("end", TIMESTAMP '9999-12-31 23:45:00') AS "end", action, factor FROM {p}dec d JOIN (SELECT DISTINCT COUNTER_SK, DIRECTION_SK FROM {p}keys) k ON d.DIRECTION_SK = k.DIRECTION_SK
  UNION ALL SELECT k.SITE_SK, k.COUNTER_SK, k.DIRECTION_SK, start, coalesce("end", TIMESTAMP '9999-12-31 23:45:00'), action, factor FROM {p}dec d JOIN {p}keys k ON d.SITE_SK = k.SITE_SK WHERE d.DIRECTION_SK IS NULL),
{p}fill AS (SELECT DISTINCT {K}, date, CAST(slot AS SMALLINT) AS slot FROM (SELECT z.SITE_SK, z.COUNTER_SK, z.DIRECTION_SK, y.date, unnest(range(0, 96)) AS slot, z.start, z."end" FROM {p}scope z JOIN (SELECT DISTINCT COUNTER_SK, date FROM slots) y ON z.COUNTER_SK = y.COUNTER_SK WHERE action = 'zero_fill')
  WHERE {time()} BETWEEN start AND "end"),
{p}fs AS MATERIALIZED (SELECT {K}, date, slot, raw, records, load, {time()} AS time FROM slots
  UNION ALL SELECT {K}, date, slot, 0, 0, NULL, {time()} FROM {p}fill f WHERE NOT EXISTS (SELECT 1 FROM slots x WHERE x.DIRECTION_SK = f.DIRECTION_SK AND x.date = f.date AND x.slot = f.slot)),
{p}flag AS (SELECT t.DIRECTION_SK, t.time, {', '.join(f"bool_or(action = '{a}') AS {a}" for a in ACTIONS[1:])}, min(factor) AS factor
  FROM (SELECT DISTINCT DIRECTION_SK, time FROM {p}fs) t JOIN {p}scope z ON t.DIRECTION_SK = z.DIRECTION_SK AND t.time BETWEEN z.start AND z."end" WHERE z.action <> 'zero_fill' GROUP BY ALL),
{repeats(p, p + 'fs')},
{p}1 AS (SELECT x.*, f.* EXCLUDE (DIRECTION_SK, time), {hit('drop_duplicates')} AND d.dedup IS NOT NULL AS h1, d.dedup FROM {p}fs x LEFT JOIN {p}flag f ON x.DIRECTION_SK = f.DIRECTION_SK AND x.time = f.time LEFT JOIN {p}dup d ON x.DIRECTION_SK = d.DIRECTION_SK AND x.date = d.date AND x.slot = d.slot),
{p}2 AS (SELECT *, CASE WHEN h1 THEN dedup ELSE raw END AS c1, CASE WHEN h1 THEN 'drop_duplicates' END AS f1 FROM {p}1),
{p}3 AS (SELECT *, CASE WHEN coalesce(subtract_other, false) THEN greatest(c1 - (sum(c1) OVER (PARTITION BY SITE_SK, COUNTER_SK, time) - c1), 0) ELSE c1 END AS c2, CASE WHEN coalesce(subtract_other, false) THEN 'subtract_other' ELSE f1 END AS f2 FROM {p}2),
{p}4 AS (SELECT *, CASE WHEN coalesce(missing, false) THEN NULL ELSE c2 END AS c3, CASE WHEN coalesce(missing, false) THEN 'missing' ELSE f2 END AS f3 FROM {p}3),
{p}5 AS (SELECT *, CASE WHEN coalesce(scale, false) AND c3 IS NOT NULL THEN round_even(c3 * factor, 0) ELSE c3 END AS c4, CASE WHEN coalesce(scale, false) AND c3 IS NOT NULL THEN 'scale' ELSE f3 END AS fix FROM {p}4),
{p}applied AS MATERIALIZED (SELECT {K}, date, slot, time, raw, records, load, CAST(c4 AS INTEGER) AS count, fix, coalesce(direction_unreliable, false) AS direction_unreliable FROM {p}5),
{p}kept AS (SELECT a.* FROM {p}applied a JOIN (SELECT COUNTER_SK, max(load) AS last_load FROM recs GROUP BY ALL) l ON a.COUNTER_SK = l.COUNTER_SK WHERE a.date < l.last_load),
{p}final AS MATERIALIZED (SELECT {', '.join('a.' + k for k in K.split(', '))}, a.date, a.time, coalesce(d.day_type = 'Weekday (excl. PH)', isodow(a.date) <= 5) AS workday, a.records, a.raw, a.count, a.fix, a.direction_unreliable,
    count(CASE WHEN raw > 0 THEN 1 END) OVER w >= 8 AND coalesce(min(CASE WHEN raw > 0 THEN a.slot % 4 END) OVER w = max(CASE WHEN raw > 0 THEN a.slot % 4 END) OVER w, false) AS hourly_binned
  FROM {p}kept a LEFT JOIN dates d ON a.date = d.date WINDOW w AS (PARTITION BY a.DIRECTION_SK, a.date))"""


def parts(p: str, final: str, reviewed: list[tuple]) -> str:
    rows = reviewed or [(0, "", 0, -1, None, None)]
    return f"""
{_values(p + 'rev', 'a, b, c, d, e, f', rows, "CAST(a AS SMALLINT) AS SITE_SK, b AS series, CAST(c AS SMALLINT) AS COUNTER_SK, CAST(d AS SMALLINT) AS DIRECTION_SK, CAST(e AS DATE) AS start, CAST(f AS DATE) AS \"end\"")},
{p}pair AS (SELECT DISTINCT {K} FROM {final}),
{p}sev AS (SELECT SITE_SK, count(DISTINCT COUNTER_SK) > 1 AS several FROM {p}pair GROUP BY ALL),
{p}known AS (SELECT * FROM {p}rev r WHERE EXISTS (SELECT 1 FROM {p}pair x WHERE x.COUNTER_SK = r.COUNTER_SK AND x.DIRECTION_SK = r.DIRECTION_SK)),
{p}parts AS (SELECT SITE_SK, series, COUNTER_SK, DIRECTION_SK, start, "end", CAST(NULL AS SMALLINT) AS match_site FROM {p}known
  UNION ALL SELECT x.SITE_SK, coalesce(d.orientation, CAST(x.DIRECTION_SK AS VARCHAR)) || CASE WHEN d.way IN ('IN', 'OUT') THEN ' (' || d.way || ')' ELSE '' END || CASE WHEN v.several THEN ' [counter ' || c.counter_id || ']' ELSE '' END,
    x.COUNTER_SK, x.DIRECTION_SK, NULL, NULL, x.SITE_SK FROM {p}pair x JOIN {p}sev v ON x.SITE_SK = v.SITE_SK LEFT JOIN directions d ON x.DIRECTION_SK = d.DIRECTION_SK LEFT JOIN counters c ON x.COUNTER_SK = c.COUNTER_SK
    WHERE NOT EXISTS (SELECT 1 FROM {p}known k WHERE k.COUNTER_SK = x.COUNTER_SK AND k.DIRECTION_SK = x.DIRECTION_SK))"""


def weekly(name: str, final: str, parts_: str) -> str:
    return f"""
{name}pd AS (SELECT p.SITE_SK, p.series, p.COUNTER_SK, p.DIRECTION_SK, f.date, coalesce(sum(f.count), 0) AS bikes, count(f.count) AS valid, bool_or(direction_unreliable) AS du FROM {final} f JOIN {parts_} p ON f.COUNTER_SK = p.COUNTER_SK AND f.DIRECTION_SK = p.DIRECTION_SK
  WHERE (p.match_site IS NULL OR p.match_site = f.SITE_SK) AND (p.start IS NULL OR f.date >= p.start) AND (p."end" IS NULL OR f.date <= p."end") GROUP BY ALL),
{name}d AS (SELECT SITE_SK, series, date, sum(bikes) AS bikes, bool_and(valid >= 90) AS complete, bool_or(du) AS du FROM {name}pd GROUP BY ALL),
{name} AS (SELECT SITE_SK, series, {week()} AS week, CAST(sum(bikes) AS BIGINT) AS bikes, CAST(count(*) AS SMALLINT) AS complete_days, bool_or(du) AS direction_unreliable FROM {name}d WHERE complete GROUP BY ALL)"""


def runs(name: str, src: str, by: str, order: str, step: str) -> str:
    return f"{name} AS (SELECT *, sum(new) OVER (PARTITION BY {by} ORDER BY {order}) AS run FROM (SELECT *, CASE WHEN {order} - lag({order}) OVER (PARTITION BY {by} ORDER BY {order}) = {step} THEN 0 ELSE 1 END AS new FROM {src}))"


CLEAN = BASE + ", " + cleaned("c", X.DECISIONS)
OLD = CLEAN + ", " + cleaned("o", X.OLD_DECISIONS)
SERIES = CLEAN + ", " + parts("q", "cfinal", X.PARTS) + ", " + weekly("wk", "cfinal", "qparts")
Q15 = "INTERVAL 15 MINUTE"
PRE = {"base": BASE, "clean": CLEAN, "series": SERIES, "old": OLD}


def sql(select: str, pre: str = "base", more: str = "") -> str:
    return f"WITH RECURSIVE {PRE[pre]}{', ' + more if more else ''}\n{select}"

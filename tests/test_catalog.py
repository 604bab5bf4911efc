"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from slotweave.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    cur = duck.execute(catalog.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = sorted(str([str(plain(dict(zip(names, r, strict=True))[c])) for c in cols]) for r in cur.fetchall())
    assert sorted(names) == cols
    norm = lambda v: str(plain(float(v) if isinstance(v, float) else v))
    assert sorted(str([norm(r[c]) for c in cols]) for r in got.collect()) == want


def test_absent_zeros_looks_at_every_slot(spark, monkeypatch):
    day = lambda direction, date, zero: [(4, 102, direction, date, k, 0 if k == zero else 3) for k in range(96)]
    rows = day(40, "2024-01-02", 50) + day(40, "2024-01-09", None) + day(41, "2024-01-02", 36)
    s = spark.createDataFrame(rows, "SITE_SK short, COUNTER_SK int, DIRECTION_SK int, date string, slot int, count int")
    monkeypatch.setattr(catalog, "_s", lambda spark, d: s.withColumn("date", s["date"].cast("date")))
    got = [(r["DIRECTION_SK"], str(r["start"]), str(r["end"]), r["weeks"], r["slots"]) for r in catalog.queries()["absent_zeros"](spark, DATA).collect()]
    assert got == [(40, "2024-01-08", "2024-01-14", 1, 96)]

import json
import os
import subprocess

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, IsNotNull

from slotweave.operators import audit, slots
from slotweave.settings import KEYS
from slotweave.sources import files, rehearsal, semantic, verdicts
from slotweave.sources import fixture as X
from slotweave.streaming import ingest as stream

from .test_engine import recs

#: A folder of reviewers' documents, if there is one.
CORPUS = os.environ.get("VERDICTS", "")


def test_rows_are_unpacked():
    ds = {"ValueDicts": {"D0": ["a", "b"]}, "PH": [{"DM0": [
        {"S": [{"N": "G0", "T": 1, "DN": "D0"}, {"N": "G1", "T": 7}, {"N": "M0", "T": 4}], "C": [0, 0, 5]},
        {"C": [1], "R": 6}, {"C": [86400000], "R": 1, "Ø": 4}, {"R": 7, "Ø": 7}, {"C": ["literal", 1, 2]}]}]}
    assert list(semantic.Rows(ds)) == [["a", "1970-01-01T00:00:00", 5], ["b", "1970-01-01T00:00:00", 5], ["b", "1970-01-02T00:00:00", None], ["b", "1970-01-02T00:00:00", None], ["literal", "1970-01-01T00:00:00.001000", 2]]
    assert list(semantic.Rows({})) == []


def test_days_are_packed(spark):
    cases = [[(1, 20000), (2, 9999), (3, 1), (4, 40000), (5, 2)], [(1, 40000)], [(k, 10000) for k in range(1, 8)], []]
    want = [[[1, 2], [3], [4], [5]], [[1]], [[1, 2], [3, 4], [5, 6], [7]], []]
    assert [semantic.packed_days(c) for c in cases] == want
    rows = [(site, day, n) for site, c in enumerate(cases) for day, n in c]
    got: dict = {}
    for r in files.packed(spark.createDataFrame(rows, "SITE_SK int, DATE_SK int, rows long"), 29_999).orderBy("SITE_SK", "DATE_SK").collect():
        got.setdefault((r["SITE_SK"], r["chunk"]), []).append(r["DATE_SK"])
    assert got == {(site, k): days for site, c in enumerate(want) for k, days in enumerate(c)}


def test_requests():
    assert semantic.spelled("o'b") == {"Literal": {"Value": "'o''b'"}} and semantic.spelled(3) == {"Literal": {"Value": "3L"}}
    query = semantic.Query({"m": "Mode"}, {"x": semantic.Field("m", "X")})
    ids = {"model": 7, "dataset": "d", "report": "r"}
    command = lambda body: body["queries"][0]["Query"]["Commands"][0]["SemanticQueryDataShapeCommand"]
    plain = query.request(ids)
    assert "Where" not in command(plain)["Query"] and command(plain)["Binding"]["DataReduction"]["Primary"]["Window"] == {"Count": 30000} and plain["modelId"] == 7
    more = query.where(semantic.Field("m", "X"), [1, "a"])
    assert semantic.Query.from_json(more.to_json()) == more
    body = command(more.request(ids, ["t"]))
    assert body["Binding"]["DataReduction"]["Primary"]["Window"] == {"Count": 30000, "RestartTokens": ["t"]}
    assert body["Query"]["Where"] == [{"Condition": {"In": {"Expressions": [semantic.Field("m", "X").spec()], "Values": [[semantic.spelled(1)], [semantic.spelled("a")]]}}}]


COUNTS = semantic.Query({"c": "Counts"}, {k: semantic.Field("c", k) for k in ("SITE_SK", "DATE_SK", "SLOT")})


def test_service_pages_and_asks_again(monkeypatch):
    rehearsal._refused.clear()
    calls, waits, failures = [], [], [OSError("down"), None, "error"]

    def shaky(url, body, headers):
        calls.append(url)
        if "querydata" in url and failures and (f := failures.pop(0)):
            if isinstance(f, OSError):
                raise f
            return {"results": [{"result": {"data": {"dsr": {"DS": [{"odata.error": "no"}]}}}}]}
        return rehearsal.answer(url, body, headers)

    service = semantic.Service("http://x", "r", shaky, waits.append)
    assert service.schema() == {"Counts": {**rehearsal.ENTITIES["Counts"]}}
    got = list(service.rows(COUNTS.where(semantic.Field("c", "SITE_SK"), [1, 3])))
    assert got == [[s, d, k] for s, d, k, _ in rehearsal.facts() if s in (1, 3)] and len(got) > 2 * rehearsal.WINDOW
    assert waits == [1, 2, 4]
    always = semantic.Service("http://x", "r", lambda url, body, headers: (_ for _ in ()).throw(semantic.Refused("no")) if "querydata" in url else rehearsal.answer(url, body, headers), (long := []).append)
    with pytest.raises(semantic.Refused):
        list(always.rows(COUNTS))
    assert long == [1, 2, 4, 8, 16]


def test_tokens_are_renewed():
    asked = []

    def send(url, body, headers):
        asked.append(url)
        return {"EmbedToken": {"Token": str(len(asked)), "Expiration": "2000-01-01T00:00:00+00:00" if len(asked) < 3 else "2999-01-01T00:00:00+00:00"}}

    token = semantic.Token("http://x", "r", send)
    assert [token.headers()["Authorization"][-1] for _ in range(4)] == ["1", "2", "3", "3"] and len(set(asked)) == 3


def test_partitions_and_filters():
    options = {"embedurl": "http://x", "report": "r", "query": COUNTS.to_json(), "transport": f"{rehearsal.__name__}:answer", "split": json.dumps({k: vars(f) for k, f in {"site": semantic.Field("c", "SITE_SK"), "day": semantic.Field("c", "DATE_SK"), "rows": semantic.Field("c", "Rows", "Measure")}.items()})}
    reader = semantic.SemanticReader(["SLOT", "SITE_SK"], options)
    kept = list(reader.pushFilters([EqualTo(("SITE_SK",), 2), IsNotNull(("SLOT",)), EqualTo(("other",), 1)]))
    assert kept == [IsNotNull(("SLOT",)), EqualTo(("other",), 1)]
    parts = reader.partitions()
    assert [p.only[0][1] for p in parts] == [(2,)] and parts[0].only[1][1] == tuple(range(20241, 20250))
    assert sorted(reader.read(parts[0])) == sorted((k, s) for s, _, k, _ in rehearsal.facts() if s == 2)


VERDICT = {
    "group": "G0001",
    "decisions": [{"action": "missing", "SITE_SK": 1, "DIRECTION_SK": None, "start": "2024-01-01", "end": None, "confidence": "high", "diagnosis": "d"}, {"action": "scale", "factor": 0.5, "SITE_SK": 1, "DIRECTION_SK": 3, "start": "2024-01-02", "end": "2024-01-02 08:00", "rejected": True}],
    "series": [{"SITE_SK": 1, "name": "N", "confidence": "high", "evidence": "", "parts": [{"COUNTER_SK": 5, "DIRECTION_SK": 3, "start": None, "end": "2024-01-05"}]}, {"SITE_SK": 1, "name": "M", "rejected": True, "parts": []}],
    "proposals": [],
}


def test_verdicts(spark, tmp_path):
    (tmp_path / "G0001.json").write_text(json.dumps(VERDICT, indent=1))
    for v in (verdicts.read_verdicts(spark, f"{tmp_path}/*.json"), verdicts.from_dicts(spark, [VERDICT])):
        assert [r["action"] for r in verdicts.decisions(v).collect()] == ["missing"]
        assert [r["action"] for r in verdicts.decisions(v, rejected=True).collect()] == ["missing", "scale"]
        assert [(r["series"], str(r["end"])) for r in verdicts.series_table(v).collect()] == [("N", "2024-01-05")]
        assert sorted((r["i"], r["rejected"]) for r in audit.flat_decisions(v).collect()) == [(0, False), (1, True)]
    assert verdicts.at_revision(str(tmp_path), "G0001.json") == VERDICT


def test_verdict_at_a_revision(tmp_path):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    git("init", "-q")
    for k in range(2):
        (tmp_path / "v.json").write_text(json.dumps({"k": k}))
        git("add", ".")
        git("commit", "-qm", str(k))
    (tmp_path / "v.json").write_text(json.dumps({"k": 2}))
    (tmp_path / "w.json").write_text(json.dumps({"k": 3}))
    assert [verdicts.at_revision(str(tmp_path), "v.json", r)["k"] for r in ("HEAD~1", "HEAD", None, "w.json")] == [0, 1, 2, 3]


@pytest.mark.skipif(not os.path.isdir(CORPUS), reason="needs the corpus of verdicts")
def test_corpus(spark):
    v = verdicts.read_verdicts(spark, CORPUS + "/*.json")
    d = verdicts.decisions(v, rejected=True)
    assert v.count() == 120 and d.count() == 2038 and d.where("rejected").count() == 7
    assert {r[0]: r[1] for r in d.groupBy("action").count().collect()} == {"missing": 1511, "restore": 248, "drop_duplicates": 128, "uncertain": 77, "scale": 48, "zero_fill": 15, "direction_unreliable": 8, "subtract_other": 3}
    assert d.where("DIRECTION_SK is null").count() == 476 and d.where("end is null").count() == 19


def test_counts_round_trip(spark, tmp_path):
    raw = spark.createDataFrame([(1, 20241, "08:00 - 08:14", 3, 5, 7, 1, 9, 1.5, 2.5, 0, "ok", "2024-01-02T00:00:00"), (2, 2025365, "23:45 - 23:59", 3, 5, 7, 1, 9, None, None, 0, "ok", "2026-01-02T00:00:00")],
                                "ID long, DATE_SK int, `15MIN_TIME_SLOT` string, SITE_SK int, DIRECTION_SK int, COUNTER_SK int, MODE_SK int, TOTAL_15MIN_COUNT int, SPEED_15MIN_MEDIAN double, SPEED_15MIN_85P double, Status int, `Status description` string, ADDED_UPDATED_DATETIME_SYDNEY string")
    typed = files.typed_counts(raw)
    files.write_counts(typed, f"{tmp_path}/counts")
    back = files.read_counts(spark, f"{tmp_path}/counts", [3], "2025-01-01")
    assert [(str(r["date"]), r["slot"]) for r in back.collect()] == [("2025-12-31", 95)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "year" in plan
    want = spark.createDataFrame([(3, 20241, 1), (3, 2025365, 2)], "SITE_SK int, DATE_SK int, rows int")
    assert [tuple(r) for r in files.stale_site_years(want, files.read_counts(spark, f"{tmp_path}/counts")).collect()] == [(3, 2025, 2)]
    assert files.dimension_rows(spark.createDataFrame([(3, "x"), (4, "y")], "SITE_SK int, n string"), typed, "SITE_SK").collect()[0]["fact_rows"] == 2


def test_text_files(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("2", "b")], "a string, b string")
    files.write_csv(df, f"{tmp_path}/c")
    assert sorted(map(tuple, files.read_dimension(spark, f"{tmp_path}/c").collect())) == [("1", None), ("2", "b")]
    assert files.markdown(df.coalesce(1)) == "| a | b |\n| --- | --- |\n| 1 |  |\n| 2 | b |"
    text = files.brief("G1", [1, 2], {"sites": df, "counters": df, "directions": df}, "judge")
    assert text.startswith("# Review group G1\n\nThe group's sites: `[1, 2]`\n\n## Sites\n\n| a") and text.endswith("## Directions (dates with data)\n\n" + files.markdown(df) + "\n\njudge")
    files.write_text(spark, text, f"{tmp_path}/brief")
    assert "\n".join(r[0] for r in spark.read.text(f"{tmp_path}/brief").collect()) == text


def test_stream(spark, tmp_path):
    r = recs(spark, [(0, 100, 0, "2024-01-02", 5, 1, 3, "2024-01-03"), (0, 100, 0, "2024-01-02", 5, 2, 4, "2024-01-04")])
    r.where("ID = 1").write.parquet(f"{tmp_path}/in/a")
    r.where("ID = 2").write.parquet(f"{tmp_path}/in/b")
    s = spark.readStream.schema(r.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    stream.ingest(spark, s, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    assert [(x["raw"], x["records"], str(x["load"])) for x in stream.stored(spark, f"{tmp_path}/out").collect()] == [(7, 1, "2024-01-04")]


def test_stream_of_local_records_is_the_slot_table(spark, tmp_path):
    r = recs(spark, [(4, 102, 40, "2024-01-02", s, k, k % 5, "2024-01-04" if k % 2 else "2024-01-03") for k, s in enumerate([5, 5, 60, 60, 61, 95, 95, 0])] + [(0, 100, 0, "2024-01-02", 3, 99, 4, "2024-01-03")])
    r.write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema(r.schema).parquet(f"{tmp_path}/in")
    stream.ingest(spark, s, f"{tmp_path}/out", f"{tmp_path}/cp", X.counters(spark)).awaitTermination(120)
    row = lambda x: sorted((tuple(map(str, y)) for y in x.select(*KEYS, "date", "slot", "raw", "records", "load").collect()))
    assert row(stream.stored(spark, f"{tmp_path}/out")) == row(slots.slot_table(slots.local_records(r, X.counters(spark))))


def test_stream_checks_the_range(spark, tmp_path):
    r = recs(spark, [(0, 100, 0, "2024-01-02", 5, k, 40000, "2024-01-03") for k in range(2)])
    r.write.parquet(f"{tmp_path}/in")
    stream.ingest(spark, spark.readStream.schema(r.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(120)
    with pytest.raises(Exception, match="out of range"):
        stream.stored(spark, f"{tmp_path}/out").select("records").collect()


def test_slot_sums_wait_for_the_watermark(spark, tmp_path):
    day = lambda d, n: recs(spark, [(0, 100, 0, d, 5, 1, n, "2024-02-01"), (0, 100, 0, d, 5, 2, 1, "2024-02-01")])
    # the slot is complete when the stream is 7 days on; a record that is later still is left out
    for k, (d, n) in enumerate([("2024-01-02", 3), ("2024-01-20", 4), ("2024-01-02", 50), ("2024-01-21", 4)]):
        day(d, n).write.parquet(f"{tmp_path}/in/{k}")
        os.utime(f"{tmp_path}/in/{k}", (k + 1, k + 1))
        for f in os.listdir(f"{tmp_path}/in/{k}"):
            os.utime(f"{tmp_path}/in/{k}/{f}", (1000 + k, 1000 + k))
    s = spark.readStream.schema(day("2024-01-01", 1).schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = stream.slot_sums(s).writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = [(str(x["time"]), x["raw"], x["records"]) for x in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert ("2024-01-02 01:15:00", 4, 2) in got and all(t != "2024-01-02 01:15:00" or n == 4 for t, n, _ in got)


def test_local_period_reaches_the_scan(spark, tmp_path):
    r = recs(spark, [(4, 102, 40, "2024-01-0%d" % d, s, d, 1, "2024-02-01") for d in range(1, 9) for s in (1, 60)])
    r.write.parquet(f"{tmp_path}/r")
    at = slots.local_records(spark.read.parquet(f"{tmp_path}/r"), X.counters(spark), start="2024-01-04", end="2024-01-05")
    assert sorted({str(x["date"]) for x in at.collect()}) == ["2024-01-04", "2024-01-05"] and at.count() == 4
    plan = at._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2024-01-03)" in plan and "LessThanOrEqual(date,2024-01-06)" in plan


def test_ingest_replaces_what_is_stale(spark, tmp_path):
    rows = [(s, 3, 5, 1, "2024-01-0%d" % d, 0, k, 1, 0, "2024-02-01") for s in (1, 2) for d in (1, 2) for k in range(s)]
    typed = spark.createDataFrame(rows, "SITE_SK int, DIRECTION_SK int, COUNTER_SK int, MODE_SK int, date string, slot int, ID int, TOTAL_15MIN_COUNT int, Status int, ADDED_UPDATED_DATETIME_SYDNEY string")
    typed = typed.select(*((F.col(f.name) if f.name in typed.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in files.RAW_SCHEMA))
    want = spark.createDataFrame([(1, 20241, 1), (1, 20242, 1), (2, 20241, 2), (2, 20242, 2)], "SITE_SK int, DATE_SK int, rows long")
    said = lambda counts, expected: sorted(tuple(r) for r in files.ingest(counts, expected, f"{tmp_path}/c").collect())
    assert said(typed, want) == [(1, 2024, 2, 2, True, True), (2, 2024, 4, 4, True, True)]
    assert said(typed, want) == [(1, 2024, 2, 2, False, True), (2, 2024, 4, 4, False, True)]
    # the source has a day less of site 2 than it said: told, and fetched again the next time
    assert said(typed.where("SITE_SK = 1 or date = DATE'2024-01-01'"), want.withColumn("rows", F.expr("rows + if(SITE_SK = 2, 1, 0)"))) == [(1, 2024, 2, 2, False, True), (2, 2024, 6, 2, True, False)]
    assert said(typed, want) == [(1, 2024, 2, 2, False, True), (2, 2024, 4, 4, True, True)]

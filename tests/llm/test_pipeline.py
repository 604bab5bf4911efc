"""The pipeline's stages against brute force, each on its own input, and the queries against their SQL."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from slotweave.llm import quality, queries

from .test_dedup import exact_by_force, near_by_force
from .test_other import check_packing, targets_by_force

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, DATA)
        out.write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        got = after.collect()
        rows = [(r["doc_id"], r["text"]) for r in before]
        if number < 4:
            assert after.columns == docs.columns
        if name == "quality_classifier":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in got}
            assert gone and not any(labels.get(i) == 1 for i in gone)
            judged = quality.classify(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()
            assert {r["doc_id"] for r in got} == {r["doc_id"] for r in judged if r["p_good"] >= quality.THRESHOLD}
        elif name == "exact_dedup":
            assert {r["doc_id"] for r in got} == {i for i, x in exact_by_force(rows).items() if x[2]}
        elif name == "minhash_near_dedup":
            assert {r["doc_id"] for r in got} == {i for i, x in near_by_force(rows, 5).items() if x[2]}
        elif name == "source_mixing":
            sizes = Counter()
            for r in before:
                sizes[r["source"]] += len((r["text"] or "").encode().split())
            taken, target = Counter(r["doc_id"] for r in got), targets_by_force(dict(sizes))
            for r in before:
                rate = target[r["source"]] / sizes[r["source"]]
                assert int(rate) <= taken[r["doc_id"]] <= int(rate) + 1
        else:
            n = check_packing(rows, got)
            assert len({r["doc_id"] for r in got}) < len({r["row"] for r in got}) and n <= 1.03 * sum(r["length"] for r in got) / 1024 + 1
            return
        docs = after


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = queries.queries()[name](spark, DATA)
    cols = sorted(got.columns)
    cur = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted(str([dict(zip(names, r, strict=True))[c] for c in cols]) for r in cur.fetchall())
    assert sorted(str([r[c] for c in cols]) for r in got.collect()) == want

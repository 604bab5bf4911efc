import hashlib
import itertools
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotweave.llm import common, exact_dedup, minhash, substring_dedup

WORDS = [f"w{i}" for i in range(2000)]
EDGE = [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "a b"), (9004, "A  b"), (9005, "a b"), (9006, "é x"), (9007, "word " * 12000)]


def family(r, n, size, rates):
    base = [r.choice(WORDS) for _ in range(size)]
    return [" ".join(r.choice(WORDS) if r.random() < (p := r.choice(rates)) else w for w in base) for _ in range(n)]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- exact ----------------------------------------------------------------------------------------------------------
def exact_by_force(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    out = {}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        out[i] = (min(same), len(same), i == min(same), hashlib.sha256(t.encode()).hexdigest())
    return out


def test_exact(docs_of):
    r = random.Random(1)
    rows = [(i, r.choice(["", " ", "x", "x y", "x\ty", "x  y", "long " * 3000]) + r.choice(["", "z"])) for i in range(400)] + EDGE
    got = {i: (x["keep_id"], x["group_size"], x["kept"], x["text_sha256"]) for i, x in by_id(exact_dedup.exact_groups(docs_of(rows))).items()}
    assert got == exact_by_force(rows)


def test_exact_drop_keeps_columns(docs_of):
    df = docs_of([(2, "a  b"), (1, "a b"), (3, "b"), (1, "a\tb")])
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 1, 3]
    assert exact_dedup.drop_copies(df.where("false")).count() == 0


def test_grace_splits_buckets_that_do_not_fit():
    rows = [(k, k, 1, b"%d" % (k % 70) * 40) for k in range(700)]
    got = sorted((sorted(reps), low, n) for reps, low, n in exact_dedup.grace(iter(rows), budget=500))
    assert got == sorted((list(range(k, 700, 70)), k, 10) for k in range(70))


def test_grace_with_one_hash(monkeypatch):
    monkeypatch.setattr(exact_dedup, "content_hash", lambda c: 7)
    assert sorted(low for _, low, _ in exact_dedup.grace(iter([(k, k, 1, b"%d" % (k % 9)) for k in range(90)]), budget=300)) == list(range(9))


def test_combiner_flushes():
    b = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(["s"] * 50), pa.array([b"%d" % (k % 5) * 30 for k in range(50)])], names=["doc_id", "sha", "content"])
    out = pa.Table.from_batches(exact_dedup.combine(iter([b]), budget=400)).to_pylist()
    assert len(out) == 50 and sum(r["n"] or 0 for r in out) == 50 and all((r["content"] is None) == (r["rep_id"] is None) for r in out)


# --- near -----------------------------------------------------------------------------------------------------------
def near_by_force(rows, k):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("k", [4, 5])
def test_near(docs_of, k):
    r = random.Random(k)
    texts = [t for _ in range(4) for t in family(r, 40, r.choice([25, 80, 250]), [0, 0.005, 0.015, 0.03, 0.06])]
    r.shuffle(texts)
    rows = [*enumerate(texts), *EDGE]
    got = {i: (x["n_shingles"], x["component_id"], x["kept"]) for i, x in by_id(minhash.near_copies(docs_of(rows), k=k)).items()}
    assert got == near_by_force(rows, k)


def test_near_empty_and_drop(docs_of):
    df = docs_of([(5, "a b c d e f g h"), (4, "A b c d e f g h"), (7, None), (8, None)])
    assert minhash.near_copies(df.where("false")).count() == 0
    out = minhash.drop_near_copies(df)
    assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == [4, 7, 8]


def test_near_with_ids_that_repeat(docs_of):
    r = random.Random(11)
    texts = [t for _ in range(6) for t in family(r, 12, 60, [0, 0.005, 0.02])]
    r.shuffle(texts)
    rows = [(r.choice([None, None, 7, 8, 100 + i]), t) for i, t in enumerate(texts)]
    rows += [(5, "p q r s t u v w x y"), (None, "P q r s t u v w x y"), (None, "nothing like the others is in here"), (9, "one text of nine"), (9, "another text that has the id nine")]
    force = near_by_force(list(enumerate(t for _, t in rows)), 5)
    low = {}
    for i, (d, _) in enumerate(rows):
        c = force[i][1]
        low[c] = min(low.get(c, common.NO_ID), common.NO_ID if d is None else d)
    want = [(d, force[i][0], None if (c := low[force[i][1]]) == common.NO_ID else c) for i, (d, _) in enumerate(rows)]
    df = docs_of(rows)
    got = minhash.near_copies(df).collect()
    assert sorted(((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got), key=str) == sorted(want, key=str)
    assert all(x["kept"] == (x["doc_id"] == x["component_id"]) for x in got)
    stay = [row for row, w in zip(rows, want, strict=True) if w[0] == w[2]]
    assert sorted(((x["doc_id"], x["text"]) for x in minhash.drop_near_copies(df).collect()), key=str) == sorted(stay, key=str)


@pytest.mark.parametrize("group", [64, 6])
def test_near_misses_that_share_a_difference(docs_of, monkeypatch, group):
    """A family of which half the members share edits, and are no links of each other nor of the rest but for a few."""
    monkeypatch.setattr(minhash, "GROUP", group)
    r = random.Random(12)
    base = [r.choice(WORDS) for _ in range(220)]
    texts = [" ".join("y" if r.random() < 0.002 else w for w in base) for _ in range(160)]
    shared = [base[:40], ["edit", "one"], base[44:90], ["edit", "two", "is", "here"], base[95:]]
    for _ in range(150):
        w = [x for part in shared for x in part]
        for at in r.sample(range(len(w)), r.choice([4, 5, 5, 6, 6, 7])):
            w[at] = f"u{r.random()}" if r.random() < 0.9 else "often"
        texts.append(" ".join(w))
    r.shuffle(texts)
    rows, asked = list(enumerate(texts)), []
    confirmed = minhash._confirmed

    def counted(pairs, sets, percent):
        asked.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(minhash, "_confirmed", counted)
    got = {i: (x["n_shingles"], x["component_id"], x["kept"]) for i, x in by_id(minhash.near_copies(docs_of(rows), k=4)).items()}
    assert got == near_by_force(rows, 4)
    # 150 members share the edits: a group of all of them has 11,175 pairs
    assert 20 < len({c for _, c, _ in got.values()}) and len(asked) == 2 and sum(asked) <= (4 if group == 6 else 32) * len(texts)


def test_sketch_fills_and_estimates():
    import numpy as np

    rng = np.random.default_rng(0)
    for n in (1, 2, 10, 5000):
        assert (minhash.sketch(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))) != np.uint64(2**64 - 1)).all()
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    same = np.mean(minhash.sketch(x[:2000], 512) == minhash.sketch(x[1000:], 512))
    assert abs(same - 1 / 3) < 0.08


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["id"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "u long, v long"), "u", "v").collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 200: 100, 150: 100}


# --- substrings -----------------------------------------------------------------------------------------------------
def substring_by_force(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i, w in words.items():
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def test_substrings(docs_of):
    r = random.Random(3)
    passages = [[r.choice(WORDS) for _ in range(r.choice([49, 50, 51, 80, 200]))] for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [r.choice(passages) if r.random() < 0.5 else [r.choice(WORDS) for _ in range(r.randint(1, 90))] for _ in range(r.randint(1, 5))]
        text = [w if r.random() > 0.003 else "x" for p in parts for w in p]
        rows.append((i * 3, r.choice([" ", "\n", "\t "]).join(text)))
    rows += [(500, "same " * 300), (501, "same " * 60), (502, "same " * 49), *EDGE]
    got = {i: (x["n_words"], x["n_removed"], x["kept_sha256"]) for i, x in by_id(substring_dedup.repeated_words(docs_of(rows))).items()}
    assert got == substring_by_force(rows, 50)


def test_substrings_empty_and_drop(docs_of):
    text = " ".join(WORDS[:70])
    df = docs_of([(2, "p q " + text), (1, text + "\nend"), (3, "short  one")])
    assert substring_dedup.repeated_words(df.where("false")).count() == 0
    out = substring_dedup.drop_repeats(df)
    assert out.columns == df.columns and {r["doc_id"]: r["text"] for r in out.collect()} == {1: text + "\nend", 2: "p q", 3: "short  one"}


def test_rows_without_an_id(docs_of):
    text = " ".join(WORDS[:70])
    df = docs_of([(None, text), (3, text), (None, "only here"), (None, None)])
    exact = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(df).collect()), key=str)
    assert exact == sorted([(None, 3, 2, False), (3, 3, 2, True), (None, None, 1, True), (None, None, 1, True)], key=str)
    near = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_copies(df).collect()), key=str)
    assert near == sorted([(None, 3, False), (3, 3, True), (None, None, True), (None, None, True)], key=str)
    assert sorted(r["n_removed"] for r in substring_dedup.repeated_words(df).collect()) == [0, 0, 0, 0]


def repeated_by_force(rows, window):
    """Rows that may repeat or lack an id: (id, words, words that go)."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1) if i is not None else ():
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = {k for s in range(len(w) - window + 1) if i is not None and first[tuple(w[s : s + window])] < i for k in range(s, s + window)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def passages_and_words(seed, n, ids, rate=0.003):
    r = random.Random(seed)
    passages = [[r.choice(WORDS) for _ in range(r.choice([30, 49, 50, 51, 80, 200]))] for _ in range(12)]
    rows = []
    for k in range(n):
        parts = [r.choice(passages) if r.random() < 0.6 else [r.choice(WORDS) for _ in range(r.randint(1, 60))] for _ in range(r.randint(1, 5))]
        rows.append((ids(r, k), " ".join(w if r.random() > rate else "x" for p in parts for w in p)))
    return rows


@pytest.mark.parametrize("batches", [1, 2, 3, 7])
def test_substrings_with_ids_that_repeat(docs_of, batches):
    rows = passages_and_words(5, 90, lambda r, k: r.choice([None, 3, 40, k, k, -k]))
    df = docs_of(rows)
    got = sorted(((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.repeated_words(df, batches=batches).collect()), key=str)
    assert got == repeated_by_force(rows, 50)
    kept = {(x[0], x[3]) for x in got}
    assert {(x["doc_id"], hashlib.sha256(b" ".join(x["text"].encode().split())).hexdigest()) for x in substring_dedup.drop_repeats(df, batches=batches).collect()} == kept


def test_one_sequence_in_very_many_documents(docs_of):
    r = random.Random(8)
    line = [r.choice(WORDS) for _ in range(45)]
    rows = [(k, " ".join([r.choice(WORDS) for _ in range(r.randint(0, 9))] + line + [r.choice(WORDS) for _ in range(r.randint(0, 9))])) for k in range(400)]
    got = sorted(((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.repeated_words(docs_of(rows)).collect()), key=str)
    assert got == repeated_by_force(rows, 50)


def test_index_that_grows_and_is_opened_again(spark, docs_of, tmp_path):
    """Batches one by one, each with an index that was opened anew, know the same windows as all documents at once."""
    rows = [(k, t) for k, (_, t) in enumerate(passages_and_words(6, 100, lambda r, k: k))]
    want = {i: (n, gone) for i, n, gone, _ in repeated_by_force(rows, 50)}
    tiers = []
    for at in range(0, 100, 20):
        index = substring_dedup.FingerprintIndex(spark, f"{tmp_path}/index")
        batch = docs_of(rows[at : at + 20])
        spans = {r["doc_id"]: [x.asDict() for x in r["spans"]] for r in index.add(substring_dedup.stretches_of(batch), substring_dedup._keyed(docs_of(rows[: at + 20]), "text", "doc_id")).collect()}
        for i, _ in rows[at : at + 20]:
            assert int(substring_dedup.covered(want[i][0], spans.get(i, []), 50).sum()) == want[i][1]
        tiers.append([len(t) for t in index.state["tiers"]])
    assert tiers == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
    assert sum(r.count() for r in index.runs.values()) >= max(r.count() for r in index.runs.values()) > 0
    with pytest.raises(ValueError):
        substring_dedup.FingerprintIndex(spark, f"{tmp_path}/index", 40)
    # the same batch again: history has all of it
    again = index.add(substring_dedup.stretches_of(docs_of(rows[:20])), substring_dedup._keyed(docs_of(rows), "text", "doc_id"))
    lost = {r["doc_id"]: int(substring_dedup.covered(want[r["doc_id"]][0], [x.asDict() for x in r["spans"]], 50).sum()) for r in again.collect()}
    assert lost == {i: n for i, (n, _) in want.items() if i < 20 and n >= 50}
    index.drop()
    assert not (tmp_path / "index").exists()


def test_runs_are_merged_without_a_shuffle(spark, docs_of, tmp_path):
    index = substring_dedup.FingerprintIndex(spark, f"{tmp_path}/index")
    rows = passages_and_words(9, 60, lambda r, k: k)
    names = [index._write(substring_dedup.stretches_of(docs_of(part)).select("doc_id", "t", F.explode(F.arrays_zip("fp", "s", "e", "h1", "h2")).alias("x")).select("doc_id", "t", "x.*", F.col("doc_id").alias("last"), F.lit(0).alias("batch")).dropDuplicates(["h1", "h2"])) for part in (rows[:30], rows[30:])]
    a, b = (index.runs[n] for n in names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (substring_dedup._merged(a, b), a.join(b.select("h1", "h2"), ["h1", "h2"], "left")):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    index.drop()


def test_trimmed_passes_all_on():
    assert list(common.trimmed(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]

"""Substring dedup by a log-structured index of window fingerprints.

A window is ``WINDOW`` consecutive words. Its fingerprint is the least of the hashes of its ``GRAM``-word grams, so
that neighbouring windows mostly share one: a document is a row of stretches of windows of one fingerprint, and each
stretch has a 128-bit digest of all its words. Equal windows have equal fingerprints, and nearly all of a copied passage
is equal stretches.

Index: a batch of documents becomes a sorted immutable run of the distinct stretches that it has: digest, fingerprint,
and where the first of them stands. Runs are bucketed and sorted by digest, so that a new one is merge-joined with those
before it without a shuffle of either; they are compacted by merging when a tier has ``FAN_IN`` of them. ``add`` judges a
batch against all that was indexed before, and within itself:

1. stretches whose digest is in a run, or in an earlier document of the batch, are known as a whole;
2. of the others, those with a fingerprint that history or the batch has too may know single windows: the windows of these
   stretches, and of those in the runs, are digested from the texts and the earliest document of each is found.

The index lies under a path with a manifest for each state, so that a later session goes on with it. Runs point to
documents by id and a hash of the text; the texts themselves stay in the corpus."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gram_hashes, materialize, mix64, partitions, release, shared_dir, word_hashes

WINDOW, GRAM = 50, 25
FAN_IN = 2
BATCHES = 2
#: Comes before all ids: the owner of a window that history has.
HISTORY = -(2**63)


# --- per document ---------------------------------------------------------------------------------------------------
def fingerprints(w: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The fingerprint of each window of a document with these word hashes."""
    if len(w) < window:
        return np.empty(0, np.uint64)
    m, width, reach = gram_hashes(w, gram), 1, window - gram + 1
    while 2 * width <= reach:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[: len(m) - (reach - width)], m[reach - width :])


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of both bases and of their inverses modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(4096, 1 << (n - 1).bit_length())
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64) for base in _BASES for b in (base, pow(base, -1, 2**64))]
    return _POWERS


def span_digests(w: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of the words start..end for each pair of positions, from the words' hashes: polynomials in two
    bases, the second over hashes that are mixed once more."""
    p, out = _powers(len(w) + 1), []
    for k, h in enumerate((w, mix64(w + np.uint64(0x2545F4914F6CDD1D)))):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * p[2 * k][: len(h)], dtype=np.uint64)])
        out.append(mix64(((c[end] - c[start]) * p[2 * k + 1][start]) + (end - start).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def runs_of(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each maximal stretch of one fingerprint."""
    cut = np.flatnonzero(f[1:] != f[:-1]) + 1
    return np.concatenate([[0], cut]).astype(np.int64), np.concatenate([cut - 1, [len(f) - 1]]).astype(np.int64)


BASE = "doc_id long, t long, n_words long, sha string, fp array<long>, s array<int>, e array<int>, h1 array<long>, h2 array<long>"


def _base(window: int):
    """(doc_id, t, text) -> the same with the number of words, the digest of all, and the stretches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                n, sha, off, parts = [], [], [0], ([], [], [], [], [])
                for i, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                    words = text.split() if text else []
                    n.append(len(words))
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    if len(words) >= window and i is not None:
                        w = word_hashes(words)
                        f = fingerprints(w, window, window // 2)
                        s, e = runs_of(f)
                        for part, x in zip(parts, (f[s].view(np.int64), s.astype(np.int32), e.astype(np.int32), *span_digests(w, s, e + window)), strict=True):
                            part.append(x)
                        off.append(off[-1] + len(s))
                    else:
                        off.append(off[-1])
                offsets = pa.array(off, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int32() if k in (1, 2) else pa.int64())) for k, x in enumerate(parts)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha), *lists], names=["doc_id", "t", "n_words", "sha", "fp", "s", "e", "h1", "h2"])

    return rows


def _windows(window: int):
    """(owner, t, text, stretches) -> (owner, t, start, digest) of each window of the stretches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for owner, t, text, spans in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                w = word_hashes(text.split())
                at = np.unique(np.concatenate([np.arange(x["s"], x["e"] + 1, dtype=np.int64) for x in spans]))
                w1, w2 = span_digests(w, at, at + window)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), owner, np.int64)), pa.array(np.full(len(at), t, np.int64)), pa.array(at.astype(np.int32)), pa.array(w1), pa.array(w2)], names=["owner", "t", "s", "w1", "w2"])

    return rows


def covered(n: int, spans: list[dict], window: int) -> np.ndarray:
    """Which of n words lie in a window that starts in one of the spans (s..e)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [x["s"] for x in spans], 1)
    np.add.at(edge, [x["e"] + window for x in spans], -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(window: int, with_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, t, text, spans in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                words = text.split()
                gone = covered(len(words), spans, window)
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out.append((i, t, int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
            c = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([*(pa.array(c[k], pa.int64()) for k in range(3)), *(pa.array(c[k], pa.string()) for k in (3, 4))], names=["doc_id", "t", "n_removed", "kept_sha", "kept_text"])

    return rows


# --- the index ------------------------------------------------------------------------------------------------------
def _merged(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Two runs as one, by a merge join of their buckets; of a digest in both the older batch's row stays."""
    rest = F.struct(*(c for c in _ROW if c not in ("h1", "h2")))
    both = older.select("h1", "h2", rest.alias("x")).join(newer.select("h1", "h2", rest.alias("y")), ["h1", "h2"], "full")
    return both.select("h1", "h2", F.coalesce("x", "y").alias("z")).select("h1", "h2", "z.*")


RUN = "h1 bigint, h2 bigint, fp bigint, doc_id bigint, t bigint, s int, e int, last bigint, batch int"
_ROW = [c.split()[0] for c in RUN.split(", ")]


class FingerprintIndex:
    """Sorted immutable runs of the distinct stretches of all batches so far, under ``path``: of each the digest (h1, h2), the
    fingerprint, the first document that has it in its batch and where, and the largest doc_id there that has it.

    There is one writer at a time. A batch counts when its manifest is written; a run that no manifest names was left by a
    writer that died, and isn't read."""

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW) -> None:
        """The index at ``path`` as its last manifest tells, or a new one."""
        self.spark, self.path = spark, path.rstrip("/")
        self.state = {"window": window, "buckets": partitions(spark), "batches": 0, "version": 0, "tiers": []}
        jvm = spark.sparkContext._jvm
        self._fs = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        kept = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        if self._fs.exists(kept):
            done = [x.getPath().getName() for x in self._fs.listStatus(kept) if self._fs.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))]
            if done:
                self.state = json.loads(spark.read.text(f"{self.path}/manifest/{max(done)}").first()[0])
        if self.state["window"] != window:
            raise ValueError(f"the index has windows of {self.state['window']} words")
        self.runs = {name: self._open(name) for tier in self.state["tiers"] for name in tier}

    def _open(self, name: str) -> DataFrame:
        table = f"slotweave_run_{name}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({RUN}) USING parquet CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.state['buckets']} BUCKETS LOCATION '{self.path}/runs/{name}'")
        return self.spark.table(table)

    def _write(self, rows: DataFrame) -> str:
        """A run from rows that are dealt by digest: one sorted file a bucket."""
        name = uuid.uuid4().hex
        rows.select(*_ROW).write.format("parquet").bucketBy(self.state["buckets"], "h1", "h2").sortBy("h1", "h2").option("path", f"{self.path}/runs/{name}").saveAsTable(f"slotweave_run_{name}")
        self.runs[name] = self.spark.table(f"slotweave_run_{name}")
        return name

    def _drop(self, name: str) -> None:
        del self.runs[name]
        self.spark.sql(f"DROP TABLE IF EXISTS slotweave_run_{name}")
        self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/runs/{name}"), True)

    def add(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """Indexes a batch; (doc_id, t, spans) of its documents with windows that history has, or a document of the batch with
        a smaller doc_id.

        ``batch`` is a table with the columns of BASE, ``texts`` (doc_id, t, text) holds the texts of all documents of
        the index and of the batch. A span (s, e) is the first word of its first and of its last window."""
        window, before = self.state["window"], dict(self.runs)
        st = batch.where("doc_id is not null").select("doc_id", "t", F.explode(F.arrays_zip("fp", "s", "e", "h1", "h2")).alias("x")).select("doc_id", "t", "x.*")
        first = F.min(F.struct("doc_id", "t", "s", "e", "fp")).alias("x")
        found = st.groupBy("h1", "h2").agg(first, F.max("doc_id").alias("last")).select("h1", "h2", "x.*", "last", F.lit(self.state["batches"]).alias("batch"))
        name = self._write(found)
        own = self.runs[name]
        # merge joins of sorted runs: which digests does history have?
        seen = own.select("h1", "h2", "fp", "doc_id", "last")
        for i, run in enumerate(before.values()):
            seen = seen.join(run.select("h1", "h2", F.lit(True).alias(f"in{i}")), ["h1", "h2"], "left")
        old = reduce(lambda x, y: x | y, [F.coalesce(f"in{i}", F.lit(False)) for i in range(len(before))], F.lit(False))
        seen = materialize(seen.select("h1", "h2", "fp", "doc_id", "last", old.alias("old")), "sub-seen")
        known = seen.where("old or doc_id < last").select("h1", "h2", F.when(F.col("old"), F.lit(HISTORY)).otherwise(F.col("doc_id")).alias("owner"), F.lit(False).alias("asked"))
        # stretches that are new, but have a fingerprint that history or an earlier document has
        new = seen.where("not old").select("h1", "h2", "fp", "doc_id")
        by_fp = materialize(new.groupBy("fp").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")), "sub-fp")
        past = [run.join(by_fp.select("fp"), "fp", "left_semi").select("fp", "doc_id", "t", "s", "e") for run in before.values()]
        sources = materialize(reduce(DataFrame.unionByName, past), "sub-source") if past else None
        hit = by_fp.where("lo < hi").select("fp")
        hit = materialize(hit.unionByName(sources.select("fp")).distinct() if past else hit, "sub-hit")
        asked = new.join(hit, "fp", "left_semi").select("h1", "h2", F.col("doc_id").alias("owner"), F.lit(True).alias("asked"))
        marks = materialize(known.unionByName(asked), "sub-mark")
        release(seen, by_fp, hit)
        met = st.join(marks, ["h1", "h2"]).where(F.when(F.col("asked"), F.col("owner") == F.col("doc_id")).otherwise(F.col("owner") < F.col("doc_id")))
        met = materialize(met.select("doc_id", "t", "s", "e", "asked"), "sub-met")

        stretches = met.where("asked").select("doc_id", "t", "s", "e", F.col("doc_id").alias("owner"))
        if past:
            stretches = stretches.unionByName(sources.select("doc_id", "t", "s", "e", F.lit(HISTORY).alias("owner")))
        stretches = stretches.groupBy("doc_id", "t", "owner").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
        read = texts.join(stretches, ["doc_id", "t"]).dropDuplicates(["doc_id", "t", "owner"]).select("owner", "t", "text", "spans")
        windows = materialize(read.mapInArrow(_windows(window), "owner long, t long, s int, w1 long, w2 long"), "sub-window")
        # written before it is joined, so that adaptive execution can split a window that very many documents have
        earliest = windows.groupBy("w1", "w2").agg(F.min("owner").alias("first"), F.max("owner").alias("last")).where("first < last").drop("last")
        earliest = materialize(earliest, "sub-earliest")
        single = windows.where(F.col("owner") != HISTORY).join(earliest, ["w1", "w2"]).where("first < owner").select(F.col("owner").alias("doc_id"), "t", "s", F.col("s").alias("e"))
        spans = met.where("not asked").select("doc_id", "t", "s", "e").unionByName(single).groupBy("doc_id", "t").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
        out = materialize(spans, "sub-spans")
        release(marks, met, windows, earliest, *([sources] if past else []))
        self._grow(name)
        return out

    def _grow(self, name: str) -> None:
        """Puts a run on the lowest tier, compacts the tiers that are full and writes the manifest."""
        tiers, gone, level = self.state["tiers"], [], 0
        while True:
            if level == len(tiers):
                tiers.append([])
            tiers[level].append(name)
            if len(tiers[level]) < FAN_IN:
                break
            name = self._write(reduce(_merged, [self.runs[x] for x in tiers[level]]))
            gone += tiers[level]
            tiers[level] = []
            level += 1
        self.state |= {"batches": self.state["batches"] + 1, "version": self.state["version"] + 1}
        self.spark.createDataFrame([(json.dumps(self.state),)], "v string").coalesce(1).write.text(f"{self.path}/manifest/{self.state['version']:08d}")
        for x in gone:
            self._drop(x)

    def drop(self) -> None:
        """Removes the index."""
        for x in list(self.runs):
            self._drop(x)
        self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path), True)


def _keyed(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows are told apart by id and text; rows that are equal in both are one document."""
    t = F.col(text).cast("binary")
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(t).alias("t"), t.alias("text"))


def stretches_of(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """What the index takes of each row of ``docs``, as a table."""
    return materialize(_keyed(docs, text, key).mapInArrow(_base(window), BASE), "sub-base")


def _judged(docs: DataFrame, text: str, key: str, window: int, batches: int, with_text: bool) -> DataFrame:
    """(doc_id, t, n_words, n_removed, kept_sha256, kept_text), a row for each row of ``docs``."""
    spark = docs.sparkSession
    rows, base = _keyed(docs, text, key), stretches_of(docs, text, key, window)
    index = FingerprintIndex(spark, f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", window)
    low, high = base.agg(F.min("doc_id"), F.max("doc_id")).first()
    step, found = 1 if low is None else max(1, -(-(high - low + 1) // batches)), []
    for at in range(0 if low is None else low, 1 if low is None else high + 1, step):
        found.append(index.add(base.where((F.col("doc_id") >= at) & (F.col("doc_id") < at + step)), rows.where(F.col("doc_id") < at + step)))
    index.drop()
    cut = rows.join(reduce(DataFrame.unionByName, found), ["doc_id", "t"]).dropDuplicates(["doc_id", "t"]).select("doc_id", "t", "text", "spans")
    cut = cut.mapInArrow(_cut(window, with_text), "doc_id long, t long, n_removed long, kept_sha string, kept_text string")
    out = base.select("doc_id", "t", "n_words", "sha").join(cut, ["doc_id", "t"], "left")
    return out.select("doc_id", "t", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256"), "kept_text")


def repeated_words(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, batches: int = BATCHES, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256 [, kept_text]), a row for each row of ``docs``; kept_text is null where
    nothing was removed.

    A word goes if a window that covers it has a word sequence that also starts in a document with a smaller doc_id;
    the windows are those of the input. Words are runs of anything but ASCII white space, compared unchanged; a null
    text has none, and a text of fewer words than a window, or without a doc_id, loses none and takes none from others.
    Rows that repeat a doc_id are judged each by its own text, and not by each other. Empty tables give an empty result;
    other columns are not looked at. Documents are indexed in batches in the order of their ids."""
    out = _judged(docs, text, key, window, batches, with_text).drop("t")
    return out if with_text else out.drop("kept_text")


def drop_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the repeated words taken out of their texts; a text that loses none is unchanged."""
    cut = _judged(docs, text, key, window, batches, True).where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("_cut_id"), F.col("t").alias("_cut_t"), F.col("kept_text").alias("_cut_text")).dropDuplicates(["_cut_id", "_cut_t"])
    out = docs.join(cut, (docs[key].cast("long") == cut["_cut_id"]) & (F.xxhash64(docs[text].cast("binary")) == cut["_cut_t"]), "left")
    return out.select(*((F.coalesce(cut["_cut_text"], docs[c].cast("string")) if c == text else docs[c]).alias(c) for c in docs.columns))

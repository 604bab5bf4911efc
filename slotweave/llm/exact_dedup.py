"""Exact deduplication by Grace hashing.

1. Each input partition is combined: an open-addressing table of bounded size gives every row a local representative, so
   that of a text that fills a third of the table only one row a partition (and table filling) travels.
2. The representatives are dealt by a hash of their text. A task that can't hold its bucket in the table's budget
   partitions it by further bits of the hash into spill files of its own (scratch of one task attempt, as Spark's own
   spill, removed with it) and treats each file as a bucket of its own, down to the level at which it fits.
3. A small table (representative, kept row, size of the group) is joined back to the rows.

Tables compare complete contents; hashes only choose slots and files.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_of, materialize, normalized, partitions, shown_id, trimmed

#: Bytes of content that a table holds before it is flushed (step 1) or its bucket is split into files (step 2).
TABLE_BYTES = 48 << 20
FANOUT = 16
MAX_LEVEL = 14


class ContentTable:
    """Open addressing with linear probing; a slot has the number of an entry, an entry its complete content."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find_or_add(self, h: int, content: bytes) -> int:
        if 3 * len(self.contents) >= 2 * len(self.slots):
            self._grow()
        slots, mask = self.slots, len(self.slots) - 1
        i = h & mask
        while (k := slots[i]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return k
            i = (i + 1) & mask
        slots[i] = k = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 100
        return k

    def _grow(self) -> None:
        self.slots = slots = [-1] * (2 * len(self.slots))
        mask = len(slots) - 1
        for k, h in enumerate(self.hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = k


def content_hash(content: bytes) -> int:
    return xxhash.xxh3_64_intdigest(content, seed=8)


LOCAL = pa.schema([("doc_id", pa.int64()), ("sha", pa.string()), ("rep", pa.int64()), ("rep_id", pa.int64()), ("n", pa.int64()), ("content", pa.binary())])


def combine(batches: Iterator[pa.RecordBatch], budget: int = TABLE_BYTES) -> Iterator[pa.RecordBatch]:
    """(doc_id, sha, content) -> rows of LOCAL: each row's representative; on the representative's row also the smallest
    doc_id, the number of rows it stands for and the content."""
    base = TaskContext.get().partitionId() << 40 if TaskContext.get() else 0

    def flush() -> Iterator[pa.RecordBatch]:
        first: set[int] = set()
        content, rep_id, n = [], [], []
        for k in entry:
            lead = k not in first
            first.add(k)
            content.append(table.contents[k] if lead else None)
            rep_id.append(low[k] if lead else None)
            n.append(count[k] if lead else None)
        cols = [pa.array(ids, pa.int64()), pa.array(shas, pa.string()), pa.array([base + k for k in entry], pa.int64()), pa.array(rep_id, pa.int64()), pa.array(n, pa.int64()), pa.array(content, pa.binary())]
        yield from pa.Table.from_arrays(cols, schema=LOCAL).to_batches(max_chunksize=2000)

    table, entry, ids, shas, low, count = ContentTable(), [], [], [], [], []
    for b in batches:
        for i, sha, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            k = table.find_or_add(content_hash(content), content)
            if k == len(low):
                low.append(i)
                count.append(0)
            low[k] = min(low[k], i)
            count[k] += 1
            entry.append(k)
            ids.append(i)
            shas.append(sha)
            if table.bytes > budget or len(ids) >= 500_000:
                yield from flush()
                base += len(low)
                table, entry, ids, shas, low, count = ContentTable(), [], [], [], [], []
    if ids:
        yield from flush()


FOUND = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def grace(rows: Iterator[tuple[int, int, int, bytes]], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[tuple[list[int], int, int]]:
    """(rep, smallest doc_id, rows, content) of one bucket -> (reps, smallest doc_id, rows) of each distinct content."""
    table, reps, low, count = ContentTable(), [], [], []
    rows = iter(rows)
    for rep, i, n, content in rows:
        k = table.find_or_add(content_hash(content), content)
        if k == len(low):
            reps.append([])
            low.append(i)
            count.append(0)
        reps[k].append(rep)
        low[k] = min(low[k], i)
        count[k] += n
        if table.bytes > budget and len(low) > 1 and level < MAX_LEVEL:
            break
    else:
        yield from zip(reps, low, count, strict=True)
        return
    files = [tempfile.TemporaryFile() for _ in range(FANOUT)]
    try:
        shift = 60 - 4 * level

        def put(entry: tuple, content: bytes) -> None:
            pickle.dump((*entry, content), files[(content_hash(content) >> shift) & (FANOUT - 1)], pickle.HIGHEST_PROTOCOL)

        for k, content in enumerate(table.contents):
            put((reps[k], low[k], count[k]), content)
        del table
        for rep, i, n, content in rows:
            put(([rep], i, n), content)
        for f in files:
            f.seek(0)
            yield from ((list(chain.from_iterable(r)), i, n) for r, i, n in grace(_load(f), budget, level + 1))
            f.close()
    finally:
        for f in files:
            f.close()


def _load(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def dedup_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    out: list[tuple[int, int, int]] = []
    for reps, low, n in grace(rows):
        out += [(r, low, n) for r in reps]
        if len(out) >= 10_000:
            yield _found(out)
            out = []
    if out:
        yield _found(out)


def _found(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=FOUND)


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of ``docs``.

    Texts are equal when they are after each run of ASCII white space has become one space; a null text is the empty
    one. The smallest doc_id of a group stays. Rows that repeat a doc_id are rows as any other: they count in
    group_size, and all rows with the kept doc_id are kept; a null doc_id comes after all others. An empty table gives an empty result. Further columns are
    ignored, whatever their names."""
    content = normalized(F.col(text))
    rows = docs.select(id_of(F.col(key)).alias("doc_id"), F.sha2(content, 256).alias("sha"), content.cast("binary").alias("content"))
    local = materialize(rows.mapInArrow(trimmed(combine), "doc_id long, sha string, rep long, rep_id long, n long, content binary"), "exact-local")
    n = partitions(docs.sparkSession)
    reps = local.where("rep_id is not null").select("rep", "rep_id", "n", "content").repartition(n, F.xxhash64("content"))
    found = reps.mapInArrow(trimmed(dedup_bucket), "rep long, keep_id long, group_size long")
    return local.select("doc_id", "sha", "rep").join(found, "rep").select(shown_id("doc_id"), shown_id("keep_id"), "group_size", (F.col("doc_id") == F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs, text, key).where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[key].cast("long").eqNullSafe(kept["_kept_id"]), "left_semi")

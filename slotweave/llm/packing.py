"""Best-fit packing of tokenized documents by length patterns.

The histogram of piece lengths (at most ``cap`` numbers) is all that the driver sees. Every pattern of one to three
lengths that add up to ``cap`` is enumerated, repeat counts are fitted to the histogram by non-negative least squares,
rounded so that no length is used more often than it occurs, and what remains is packed best-fit decreasing, again by
counts. The plan says, for each length, which ranks go to which slot of which sequences; the pieces get their rank among
those of their length in a distributed way and look their place up. Its size is bounded by ``cap``, not by the data."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, trimmed, with_rank
from .tokens import default_path, encoder

CAP = 1024
END = 2  # the id after each document
ITERATIONS = 400


# --- pieces ---------------------------------------------------------------------------------------------------------
def _piece_rows(path: str, cap: int, with_ids: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                out: list[tuple] = []
                for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    ids = np.append(enc.encode(text) if text else np.empty(0, "<u4"), np.array([END], "<u4"))
                    cuts = [0, *range(len(ids) % cap or cap, len(ids) + 1, cap)] if len(ids) > cap else [0, len(ids)]
                    row += 1
                    out += [(i, k, s, e - s, zlib.crc32(ids[s:e].tobytes()), row, ids[s:e].astype(np.int32) if with_ids else None) for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))]
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), *(pa.array(c[k], pa.int64()) for k in (2, 3, 4, 5)), pa.array(c[6], pa.list_(pa.int32()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "row", "ids"],
                )

    return rows


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", cap: int = CAP, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row, ids): the pieces of each document; a longer one than ``cap`` is cut so
    that all pieces but the first have ``cap`` tokens. row: a number that the pieces of one row of ``docs`` share."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(trimmed(_piece_rows(path or default_path(), cap, with_ids)), "doc_id long, piece int, start long, length long, ids_crc32 long, row long, ids array<int>")


# --- plan -----------------------------------------------------------------------------------------------------------
def patterns(lengths: np.ndarray, cap: int) -> np.ndarray:
    """All (a <= b <= c) of the lengths, 0 for none, that add up to cap; one in a row."""
    there = np.zeros(cap + 1, bool)
    there[lengths] = True
    there[0] = True
    found = []
    for c in lengths[lengths * 3 >= cap]:
        b = np.arange(-(-(cap - c) // 2), min(c, cap - c) + 1)
        a = cap - c - b
        ok = there[a] & there[b]
        found.append(np.column_stack([a[ok], b[ok], np.full(ok.sum(), c)]))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def fit(hist: np.ndarray, pats: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Non-negative repeat counts x of the patterns with least sum over lengths of (length * (uses - hist))**2, by
    accelerated projected gradient steps. Longer pieces weigh more: short ones fill gaps easily."""
    cap = len(hist) - 1
    weight = np.arange(cap + 1) / cap
    size = max(hist.max(), 1)
    h = hist / size
    flat = pats.ravel()

    def uses(x: np.ndarray) -> np.ndarray:
        u = np.bincount(flat, np.repeat(x, 3), cap + 1)
        u[0] = 0
        return u

    def back(r: np.ndarray) -> np.ndarray:
        return r[pats].sum(axis=1)

    w2 = weight**2
    v = np.ones(len(pats))
    for _ in range(20):  # the largest curvature
        v = back(w2 * uses(v))
        top = np.linalg.norm(v)
        v /= top
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(iterations):
        new = np.maximum(0, y - back(w2 * (uses(y) - h)) / (1.01 * top))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x * size


def whole_counts(x: np.ndarray, pats: np.ndarray, hist: np.ndarray) -> np.ndarray:
    """Whole repeat counts that use no length more often than it occurs. Fractions are carried to the next pattern of
    the same largest length, so that each length keeps about the uses that were fitted."""
    n = np.zeros(len(pats), np.int64)
    left = hist.astype(np.int64).copy()
    order = np.lexsort((pats[:, 1], -pats[:, 2]))
    last, carry = -1, 0.0
    for j, want, (a, b, c) in zip(order.tolist(), x[order].tolist(), pats[order].tolist(), strict=True):
        if c != last:
            last, carry = c, 0.5
        carry += want
        k = int(carry)
        if k > 0:
            need: dict[int, int] = {}
            for z in (a, b, c):
                if z:
                    need[z] = need.get(z, 0) + 1
            k = max(0, min(k, *(int(left[z]) // m for z, m in need.items())))
            carry -= k
            for z, m in need.items():
                left[z] -= k * m
            n[j] = k
    return n


def best_fit(hist: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of sequences, [(length, how many in each)]): best-fit decreasing, sequences of equal content together."""
    cap = len(hist) - 1
    open_: dict[int, list[list]] = {}
    for l in range(cap, 0, -1):
        n = int(hist[l])
        spaces = sorted(s for s in open_ if s >= l and open_[s])
        at = 0
        while n and at < len(spaces):
            s = spaces[at]
            groups = open_[s]
            if not groups:
                at += 1
                continue
            count, content = groups.pop()
            fits = s // l
            full = min(count, n // fits)
            if full:
                open_.setdefault(s - fits * l, []).append([full, [*content, (l, fits)]])
                n -= full * fits
            rest = count - full
            if rest and n:
                open_.setdefault(s - n * l, []).append([1, [*content, (l, n)]])
                rest, n = rest - 1, 0
            if rest:
                groups.append([rest, content])
        if n:
            fits = cap // l
            if n >= fits:
                open_.setdefault(cap - fits * l, []).append([n // fits, [(l, fits)]])
            if n % fits:
                open_.setdefault(cap - n % fits * l, []).append([1, [(l, n % fits)]])
    return [(count, content) for groups in open_.values() for count, content in groups]


def plan(hist: np.ndarray) -> dict[str, np.ndarray]:
    """Slots, by length and first rank: ``copies`` pieces of ``length`` lie one after another from ``offset`` in each
    of ``n`` sequences from ``sequence`` on; the slot takes the ranks from ``rank`` on."""
    cap = len(hist) - 1
    lengths = np.flatnonzero(hist)
    pats = patterns(lengths, cap)
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    left = hist.astype(np.int64).copy()
    left[0] = 0
    if len(pats):
        n = whole_counts(fit(hist, pats), pats, hist)
        for j in np.flatnonzero(n):
            groups.append((int(n[j]), [(int(z), 1) for z in pats[j] if z]))
            for z in pats[j]:
                if z:
                    left[z] -= n[j]
    groups += best_fit(left)
    slots, rank, sequence = [], np.zeros(cap + 1, np.int64), 0
    for n, content in groups:
        offset = 0
        for l, copies in content:
            slots.append((l, rank[l], n, copies, sequence, offset))
            rank[l] += n * copies
            offset += l * copies
        sequence += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 6)
    return dict(zip(("length", "rank", "n", "copies", "sequence", "offset"), table.T, strict=True)) | {"sequences": np.array(sequence)}


def _placed(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        first = np.searchsorted(p["length"], np.arange(p["length"].max() + 2)) if len(p["length"]) else None
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            k = np.empty(len(length), np.int64)
            for l in np.unique(length):
                at = length == l
                lo, hi = first[l], first[l + 1]
                k[at] = lo + np.searchsorted(p["rank"][lo:hi], rank[at], side="right") - 1
            q = rank - p["rank"][k]
            sequence, copy = p["sequence"][k] + q % p["n"][k], q // p["n"][k]
            keep = [b.column(i) for i, name in enumerate(b.schema.names) if name != "rank"]
            names = [name for name in b.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(p["offset"][k] + copy * length)], names=[*names, "sequence_id", "offset"])

    return rows


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", cap: int = CAP, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row [, ids], sequence_id, offset), a row for each piece.

    ``path`` names the tokenizer's file. A null text is an empty document, which has only its end id; a very long one is
    encoded at once by one task, and is many pieces. Documents that repeat a doc_id, or have none, are packed as any
    other; (row, piece) tells all pieces apart. Sequences have no gaps and at most ``cap`` tokens. An empty table gives
    no piece; further columns are not looked at."""
    cut = materialize(pieces(docs, text, key, cap, path, with_ids), "pack-pieces")
    hist = np.zeros(cap + 1, np.int64)
    for length, n in cut.groupBy("length").agg(F.count("*")).collect():  # at most cap rows
        hist[length] = n
    p = docs.sparkSession.sparkContext.broadcast(plan(hist))
    # places are found without the ids, which join their pieces at the end
    bare = cut.drop("ids")
    ranked = with_rank(bare, ["length"], ["row", "piece"]).select(*bare.columns, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bare.schema) + ", sequence_id long, offset long"
    placed = ranked.mapInArrow(_placed(p), schema)
    return placed.join(cut.select("row", "piece", "ids"), ["row", "piece"]) if with_ids else placed

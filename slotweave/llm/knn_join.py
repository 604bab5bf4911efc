"""Exact top-k search by inner product: a Voronoi kNN join.

Vectors are grouped by their nearest pivot (a bounded sample of the vectors) and, within a cell, by rings of distance
from it. The summary of a ring is its number of vectors, the largest distance and the largest norm; with
q.x = q.p + q.(x - p) it bounds every score of a ring for a query from both sides. The rings with the best lower bounds
that hold k vectors give a bound that the k-th best score can't be below, and a query goes only to cells with a ring
whose upper bound reaches it. Cells are cut to blocks of a fixed size, so a vector that is repeated very often is
spread; each block finds the best k for its queries, which are merged. A cell is sent to the groups of queries of which
one needs it, and to no other."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Pivots: the square root of the number of vectors, within these bounds.
PIVOTS = (16, 4096)
RINGS = 8
#: Rows of a block, and queries that meet a block at once.
BLOCK_ROWS, QUERY_ROWS = 8192, 20_000
#: Routes that a task puts into one batch.
ROUTE_ROWS = 20_000
#: Numbers in a matrix of vectors by pivots or rings.
MATRIX = 2_000_000


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(id, v): the components as floor(scale * x); without vectors that are null or hold a null or non-finite one."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(x.isNotNull() & F.col(key).isNotNull()).where(~bad).select(F.col(key).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), d).astype(np.float64)


def _by_length(b: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    n = np.asarray(b.column(column).value_lengths())
    for d in np.unique(n):
        yield int(d), np.flatnonzero(n == d)


def _pieces(at: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Cuts rows so that a matrix of them by ``width`` stays small."""
    step = max(1, MATRIX // max(width, 1))
    return (at[k : k + step] for k in range(0, len(at), step))


def _cells(pivots: dict[int, np.ndarray]):
    """(id, v) -> cell (vector length, pivot), ring, distance and norm."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for d, b in ((d, whole.take(pa.array(at))) for d, n in _by_length(whole, 1) for at in _pieces(n, len(pivots.get(d, (0,))))):
                x = _matrix(b.column(1), d)
                p = pivots.get(d, np.zeros((1, d)))
                far = ((x**2).sum(axis=1)[:, None] - 2 * x @ p.T + (p**2).sum(axis=1)[None, :]) if d else np.zeros((len(x), 1))
                cell = far.argmin(axis=1)
                dist = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
                norm = np.sqrt((x**2).sum(axis=1))
                ring = np.minimum(RINGS - 1, (RINGS * dist / (1 + dist + np.sqrt((p[cell] ** 2).sum(axis=1)))).astype(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.full(len(x), d, np.int64)), pa.array(cell), pa.array(ring), pa.array(dist), pa.array(norm)], names=["id", "v", "d", "cell", "ring", "dist", "norm"])

    return rows


def _routes(pivots: dict[int, np.ndarray], summary: list[tuple], blocks: dict[tuple[int, int], int], k: int, groups: int):
    """(id, v, own) of queries -> a row for each block that it has to meet, with the rings of it. own: the vectors that
    have the query's id, which are none of its candidates."""
    # cell, ring, number, largest distance and largest norm of the rings of each length, by cell
    rings = {d: [np.array(c) for c in list(zip(*sorted(s[1:] for s in summary if s[0] == d), strict=True))] for d in {s[0] for s in summary}}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for d, b in ((d, whole.take(pa.array(at))) for d, n in _by_length(whole, 1) for at in _pieces(n, len(rings[d][0]) if d in rings else 1)):
                if d not in rings:
                    continue
                q = _matrix(b.column(1), d)
                cell, ring, count, dmax, nmax = rings[d]
                p = pivots.get(d, np.zeros((1, d)))
                size = np.sqrt((q**2).sum(axis=1))[:, None]
                mid, reach = (q @ p.T)[:, cell], size * dmax[None, :]
                slack = 1e-9 * (np.abs(mid) + reach) + 1e-6
                low, high = np.maximum(mid - reach, -size * nmax) - slack, np.minimum(mid + reach, size * nmax) + slack
                order = np.argsort(-low, axis=1, kind="stable")
                mine = np.asarray(b.column(2))[:, None]
                enough = np.cumsum(count[order], axis=1) >= k + mine  # all that have the query's id may be among them
                first = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
                floor = np.where(first < 0, -np.inf, low[np.arange(len(q)), order[np.arange(len(q)), first]])
                need = high >= floor[:, None]
                start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                bits = np.zeros((len(q), p.shape[0]), np.int64)
                bits[:, cell[start]] = np.add.reduceat(need * (1 << ring)[None, :], start, axis=1)
                who, where = np.nonzero(bits)
                times = np.array([blocks.get((d, c), 0) for c in range(p.shape[0])], np.int64)[where]
                src, at_cell = np.repeat(who, times), np.repeat(where, times)
                salt = np.arange(len(src)) - np.repeat(np.cumsum(times) - times, times)
                ids = np.asarray(b.column(0))
                for k0 in range(0, len(src), ROUTE_ROWS):
                    i, c = src[k0 : k0 + ROUTE_ROWS], at_cell[k0 : k0 + ROUTE_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(i), d, np.int64)), pa.array(c), pa.array(salt[k0 : k0 + ROUTE_ROWS]), pa.array(ids[i] % groups), pa.array(ids[i]), b.column(1).take(pa.array(i, pa.int64())), pa.array(bits[i, c])],
                        names=["d", "cell", "salt", "part", "query_id", "q", "rings"],
                    )

    return rows


def best(scores: np.ndarray, k: int, none: np.ndarray) -> np.ndarray:
    """The columns of the k highest scores of each row, ties to the smaller column; those in ``none`` take no part
    (column -1). Whole numbers are compared as such."""
    lowest = -np.inf if scores.dtype.kind == "f" else np.iinfo(np.int64).min
    s = np.where(none, lowest, scores)
    if s.shape[1] <= 4 * k:
        order = np.argsort(-s, axis=1, kind="stable") if s.dtype.kind == "f" else np.argsort(~s, axis=1, kind="stable")
        order = order[:, :k]
    else:
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k, None]
        # all above the k-th score, and of those equal to it the first
        above, equal = s > kth, s == kth
        room = k - above.sum(axis=1, keepdims=True)
        chosen = above | (equal & (np.cumsum(equal, axis=1) <= room))
        cols = np.nonzero(chosen)[1].reshape(len(s), k)
        found = np.take_along_axis(s, cols, axis=1)
        by = np.argsort(-found if found.dtype.kind == "f" else ~found, axis=1, kind="stable")
        order = np.take_along_axis(cols, by, axis=1)
    return np.where(np.take_along_axis(none, order, axis=1), -1, order)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q @ x.T in whole numbers: as doubles where every partial sum is one exactly, else as 64-bit integers, which hold
    any score below 2**63 (sums wrap around on the way, which does no harm)."""
    if _largest(x) * _largest(q) * max(x.shape[1], 1) < 2**53:
        return q.astype(np.float64) @ x.astype(np.float64).T
    return q @ x.T


def _block(k: int):
    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
        if not left.num_rows or not right.num_rows:
            return empty
        left = left.sort_by("id")
        d = left["d"][0].as_py()
        raw = lambda t, c: np.asarray(t[c].combine_chunks().flatten()).reshape(t.num_rows, d)
        x, ids, ring = raw(left, "v"), left["id"].to_numpy(), left["ring"].to_numpy()
        out = []
        for at in range(0, right.num_rows, 256):
            r = right.slice(at, 256)
            qid, mask = r["query_id"].to_numpy(), r["rings"].to_numpy()
            s = _exact(x, raw(r, "q"))
            none = ((mask[:, None] >> ring[None, :]) & 1 == 0) | (qid[:, None] == ids[None, :])
            col = best(s, min(k, len(ids)), none)
            row = np.repeat(np.arange(len(qid)), col.shape[1])
            col = col.ravel()
            row, col = row[col >= 0], col[col >= 0]
            out.append(pa.table({"query_id": qid[row], "vec_id": ids[col], "score": s[row, col].astype(np.int64)}))
        return pa.concat_tables(out)

    return join


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id", vector: str = "embedding", scale: int = 1024, pivots: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the ``k`` others of highest
    integer inner product, ties to the smaller id.

    Vectors that are null or without an id, or hold a null or a non-finite component, take no part; a vector meets only those of its own
    length. Rows that repeat the query's id count as its own, and of the rows that have it the vector that is smallest,
    component by component, asks; other repeated ids are candidates one by one. With fewer than k candidates all are
    returned, and none for an empty table. Scores are exact below 2**63. Pivots are vectors in the order of a hash of
    their ids, a bounded sample that only decides about speed."""
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector, scale)
    pivots = pivots or min(max(math.isqrt(rows.count()), PIVOTS[0]), PIVOTS[1])
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    by_d: dict[int, list] = {}
    for r in sample:
        by_d.setdefault(len(r["v"]), []).append(r["v"])
    centres = {d: np.unique(np.array(v, np.float64).reshape(len(v), d), axis=0) for d, v in by_d.items()}
    data = materialize(rows.mapInArrow(_cells(centres), "id long, v array<long>, d long, cell long, ring long, dist double, norm double"), "knn-cells")
    # cells x rings numbers for each vector length, whatever the number of vectors
    summary = [tuple(r) for r in data.groupBy("d", "cell", "ring").agg(F.count("*"), F.max("dist"), F.max("norm")).collect()]
    sizes: dict[tuple[int, int], int] = {}
    for s in summary:
        sizes[s[0], s[1]] = sizes.get((s[0], s[1]), 0) + s[3]
    blocks = {c: -(-n // BLOCK_ROWS) for c, n in sizes.items()}
    query = data.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"), F.count("*").alias("own"))
    groups = max(1, -(-query.count() // QUERY_ROWS))
    routed = materialize(query.mapInArrow(_routes(centres, summary, blocks, k, groups), "d long, cell long, salt long, part long, query_id long, q array<long>, rings long"), "knn-routes")
    # the cells that a group of queries needs: at most cells x groups rows, and those that none needs go no further
    needed = routed.groupBy("d", "cell").agg(F.collect_set("part").alias("parts"))
    salts = spark.createDataFrame([(*c, n) for c, n in blocks.items()] or [(0, 0, 1)], "d long, cell long, salts long")
    # a row a cell, so that both fit a broadcast
    wanted = F.broadcast(needed.join(salts, ["d", "cell"]))
    dealt = data.select("id", "v", "d", "cell", "ring").join(wanted, ["d", "cell"]).withColumn("salt", F.pmod(F.xxhash64("id", "v"), F.col("salts")))
    dealt = dealt.withColumn("part", F.explode("parts")).drop("parts", "salts")
    by = ["d", "cell", "salt", "part"]
    found = dealt.groupBy(*by).cogroup(routed.groupBy(*by)).applyInArrow(_block(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

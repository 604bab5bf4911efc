"""MinHash near-dedup: fast similarity sketches, banding, exact verification, components.

A sketch has ``t`` coordinates. In round i < t every shingle is hashed to one coordinate with the value i + (0..1), in
round t + j to coordinate j; a coordinate keeps the least value it saw, and rounds stop when none is empty. So every
coordinate fills (after 2t rounds at most), one round does for sets much larger than t, and the share of equal
coordinates is concentrated around the Jaccard similarity.

Rows of equal shingle sets form a class, which has a number of its own, and one text of each class goes on: rows that
repeat a doc_id with different texts, or have none, are searched like all others. Sketches are cut to bands; classes that share
a band are candidates, and what bands connect is a family. Nothing is capped and no group is expanded into all its
pairs: each member is first confirmed, on the full sets, against the smallest one of its buckets, which settles most
families; in the others the pairs that may still be linked are found exactly by what members differ in from their family
(see _left_over) and confirmed too. The bands miss a pair of similarity 0.8 with a chance below 1e-5."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, gram_hashes, id_of, materialize, mix64, release, shown_id, trimmed, word_hashes

ROWS, BANDS = 4, 24
#: Levels of W to a doubling (see _left_over).
LEVELS = 8
#: Members of a group from which pairs are made; of a larger one a family is made (see _left_over).
GROUP = 64
COORDINATES = ROWS * BANDS
_SEEDS = mix64(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_EMPTY = np.uint64(2**64 - 1)


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The distinct hashed ``k``-word shingles of a text, A-Z lower-cased, sorted; of a shorter text its one sequence."""
    return np.unique(gram_hashes(word_hashes(text.lower().split()), k)) if text else np.empty(0, np.uint64)


def sketch(h: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """t values of (round << 32 | hash); equal values of two sketches stand for an equal least shingle."""
    s = np.full(t, _EMPTY)
    step = max(1, min(t, (4 * t) // len(h)))
    r = 0
    while r < t:
        rounds = np.arange(r, min(t, r + step))
        x = mix64(h[None, :] ^ _SEEDS[rounds][:, None])
        at = ((x >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
        value = (rounds.astype(np.uint64)[:, None] << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
        np.minimum.at(s, at.ravel().astype(np.intp), value.ravel())
        if s.max() != _EMPTY:
            return s
        r += step
    for j in np.flatnonzero(s == _EMPTY):
        s[j] = (np.uint64(t + j) << np.uint64(32)) | (mix64(h ^ _SEEDS[t + j]) & np.uint64(0xFFFFFFFF)).min()
    return s


def band_keys(s: np.ndarray) -> np.ndarray:
    rows = s.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return h


def digest(h: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(h.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


SKETCH = "doc_id long, t long, n long, h1 long, h2 long, bands array<long>"


def _sketch_rows(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                n, h1, h2, bands, off = [], [], [], [], [0]
                for text in b.column(2).to_pylist():
                    h = shingles(text, k)
                    n.append(len(h))
                    x, y = digest(h)
                    h1.append(x)
                    h2.append(y)
                    if len(h):
                        bands.append(band_keys(sketch(h)))
                    off.append(len(bands) * BANDS)
                flat = np.concatenate(bands).view(np.int64) if bands else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat))],
                    names=["doc_id", "t", "n", "h1", "h2", "bands"],
                )

    return rows


def _set_rows(k: int):
    """(id, h1, h2, text) -> (id, set) of the texts whose set has the digest (h1, h2)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                ids, sets = [], [np.empty(0, np.uint64)]
                for i, h1, h2, text in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    h = shingles(text, k)
                    if digest(h) == (h1, h2):
                        ids.append(i)
                        sets.append(h)
                off = np.cumsum([len(x) for x in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64)))], names=["id", "set"])

    return rows


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``.

    A text's set: its distinct shingles of ``k`` words, A-Z lower-cased; of fewer words, the whole sequence; without
    words, or null, it is empty and linked with nothing. Two texts are linked when 100 * intersection >= percent * union
    (80 is what the bands are made for; a higher value is as exact). component_id is the smallest doc_id that links
    reach, a null doc_id coming last. Repeated rows and ties fall in one component; of rows that repeat the kept doc_id all
    are kept. Rows that repeat a doc_id with different texts, or have none, look for links each with its own text. Empty
    tables give an empty result; other columns are not looked at."""
    out = _searched(docs, text, key, k, percent)
    return out.select(shown_id("doc_id"), F.col("n").alias("n_shingles"), shown_id("component_id"), (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _rows(docs: DataFrame, text: str, key: str) -> tuple[Column, Column]:
    """What tells rows apart: the doc_id and a hash of the text."""
    return id_of(docs[key]), F.xxhash64(docs[text].cast("binary"))


def _searched(docs: DataFrame, text: str, key: str, k: int, percent: int) -> DataFrame:
    """(doc_id, t, n, component_id), NO_ID for null."""
    if percent < 80:
        raise ValueError("the bands are made for similarities of 80 % or more")
    doc_id, t = _rows(docs, text, key)
    rows = docs.select(doc_id.alias("doc_id"), t.alias("t"), docs[text].cast("binary").alias("text"))
    sk = materialize(rows.mapInArrow(trimmed(_sketch_rows(k)), SKETCH), "mh-sketch")
    some = sk.where("n > 0")
    classes = some.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"), F.min_by("t", "doc_id").alias("t"))
    found = materialize(classes, "mh-class")
    # numbers in the order of doc_ids: stars have the first text of a family in the middle
    classes = materialize(found.orderBy("doc_id", "t").withColumn("id", F.monotonically_increasing_id()), "mh-class")
    release(found)
    one = ["doc_id", "t", "h1", "h2"]
    reps = some.join(classes, one).dropDuplicates(one)
    banded = materialize(reps.select("id", "n", F.explode("bands").alias("band")), "mh-banded")
    buckets = banded.groupBy("band").agg(F.min(F.struct("id", "n")).alias("low"), F.count("*").alias("size")).where("size > 1")
    buckets = materialize(buckets.select("band", F.col("low.id").alias("low"), F.col("low.n").alias("low_n")), "mh-bucket")
    shared = materialize(banded.join(buckets, "band"), "mh-shared")
    release(banded)
    member = materialize(classes.join(shared.select("id").distinct(), "id", "left_semi"), "mh-member")
    # large tables are never broadcast here, so small ones aren't either
    sets = rows.join(member.hint("merge"), ["doc_id", "t"]).select("id", "h1", "h2", "text").mapInArrow(trimmed(_set_rows(k)), "id long, set array<long>")
    sets = materialize(sets.dropDuplicates(["id"]), "mh-set")

    star = materialize(shared.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"), F.col("n").alias("nb"), F.col("low_n").alias("na")).distinct(), "mh-star")
    release(shared)
    first = star.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent).groupBy("b").agg(F.min("a").alias("a"))
    links = materialize(_confirmed(first, sets, percent), "mh-link")
    parts = materialize(connected_components(links, "a", "b"), "mh-part")
    family = materialize(connected_components(star, "a", "b").withColumnRenamed("component", "family"), "mh-family")
    at = materialize(family.join(parts, "id", "left").select("id", "family", F.coalesce("component", "id").alias("part")), "mh-at")
    split = materialize(at.groupBy("family").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("m")).where("lo < hi").select("family", "m"), "mh-split")
    # nothing is left over where each family is one component
    more = None if split.isEmpty() else materialize(_confirmed(_left_over(at.join(split.select("family"), "family"), split, sets, percent), sets, percent), "mh-link")
    final = parts if more is None or more.isEmpty() else materialize(connected_components(links.unionByName(more), "a", "b"), "mh-part")
    release(sets, star, family, at)

    of_class = materialize(classes.join(final, "id", "left").select("h1", "h2", "doc_id", F.coalesce("component", "id").alias("component")), "mh-of-class")
    low = materialize(of_class.groupBy("component").agg(F.min("doc_id").alias("component_id")), "mh-low")
    of_class = materialize(of_class.join(low, "component").select("h1", "h2", "component_id"), "mh-of-class")
    out = some.select("doc_id", "t", "n", "h1", "h2").join(of_class, ["h1", "h2"]).select("doc_id", "t", "n", "component_id")
    return out.unionByName(sk.where("n = 0").select("doc_id", "t", "n", F.col("doc_id").alias("component_id")))


def _left_over(members: DataFrame, split: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of families with several components, the pairs (a, b) that may still be linked.

    Members that share a difference meet (see _meetings), and a group of at most GROUP of them gives its pairs. Of a
    larger one a family of its own is made: with the shingles that most of *its* members have as the centre, what they
    share is no difference any more, so near misses that have only that in common don't meet again, and the others meet
    in smaller groups. That the centre has lost a difference of each member ends the rounds; any centre finds all
    pairs. So pairs stay within GROUP / 2 times the meetings."""
    found: list[DataFrame] = []
    while True:
        pairs, hot = _meetings(members, split, sets, percent)
        found.append(pairs)
        if hot is None:
            return materialize(reduce(DataFrame.unionByName, found).distinct(), "mh-pair")
        members = hot
        split = materialize(hot.groupBy("family").agg(F.count("*").alias("m")), "mh-split")


def _meetings(members: DataFrame, split: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """(a, b) of the pairs of small groups, and the members (family, id, part) of families that large groups make.

    C: the shingles that more than half of a family has. A member is C without r of its shingles and with e others, and
    its difference D is both. For members x, y that share s of their differences, intersection and union are
    |C| - rx - ry + s and |C| + ex + ey - s, so they are linked exactly if W(x) + W(y) <= (100 - p) |C| + (100 + p) s with
    W = 100 r + p e. Hence a pair is linked (1) with s = 0, and then both are linked with the member z of least W, or (2)
    shares s >= (W(x) + W(y) - (100 - p) |C|) / (100 + p) differences, and then one among the |D| - s + 1 rarest ones of
    each (prefix filter). For (2) members are put in levels of W, so that s is bounded for each pair of levels: the more
    both differ from the family, the more of it they must share. Independent edits are rare differences, so members
    that only have the family in common don't meet."""
    p, q = percent, 100 - percent
    open_ = materialize(members.join(sets, "id"), "mh-open")
    count = open_.select("family", F.explode("set").alias("x")).groupBy("family", "x").agg(F.count("*").alias("c"))
    common = count.join(split, "family").where(F.col("c") * 2 > F.col("m")).groupBy("family").agg(F.collect_list("x").alias("common"))
    common = materialize(split.join(common, "family", "left").select("family", F.coalesce("common", F.array().cast("array<bigint>")).alias("common")), "mh-common")
    d = open_.join(common, "family").select("id", "family", "part", F.size("set").alias("n"), F.size("common").alias("c"), F.array_except("common", "set").alias("r"), F.array_except("set", "common").alias("e"))
    d = d.select("id", "family", "part", "n", "c", F.concat("r", "e").alias("d"), (F.size("r") * 100 + F.size("e") * p).cast("long").alias("w"))
    d = materialize(d, "mh-delta")
    release(open_)
    low = d.groupBy("family").agg(F.min(F.struct("w", "id", "part")).alias("z"), F.max("w").alias("top"), F.max("c").alias("c"))
    low = materialize(low.select("family", "z", "top", F.greatest(F.col("c") * (q / 4), F.lit(1.0)).alias("unit")), "mh-low")
    dz = d.drop("d").join(low, "family")
    star = dz.where((F.col("part") != F.col("z.part")) & (F.col("w") + F.col("z.w") <= F.col("c") * q)).select(F.col("z.id").alias("a"), F.col("id").alias("b"))
    level = lambda w: F.log2(F.greatest(w, F.lit(0)) / F.col("unit") + 1) * LEVELS
    rows = d.select("id", "family", "part", "n", "w", "c", F.size("d").alias("m"), F.explode("d").alias("x"))
    df = materialize(rows.groupBy("family", "x").agg(F.count("*").alias("df"), F.min("part").alias("lo"), F.max("part").alias("hi")), "mh-df")
    ranked = rows.join(df, ["family", "x"]).withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("df", "x"))).where("lo < hi")
    ranked = ranked.join(low.select("family", "top", "unit"), "family")
    # partners of which level the k-th difference may be needed for, and which can have enough of them
    most = F.col("c") * q + (F.col("m") - F.col("k") + 1) * (100 + p) - F.col("w")
    least = (F.col("w") - F.col("c") * q) * (p / 100)
    ranked = ranked.where(most >= 0).select("family", "x", "id", "part", "n", F.floor(level(F.col("w"))).alias("own"), F.floor(level(least) - 1e-6).alias("from"), F.floor(level(F.least(most, F.col("top"))) + 1e-6).alias("to"))
    meet = materialize(ranked.where("from <= to").withColumn("other", F.explode(F.sequence("from", "to"))).drop("from", "to"), "mh-meet")
    release(df)
    pair_of = lambda lo, hi: [F.least(lo, hi).alias("l1"), F.greatest(lo, hi).alias("l2")]
    meet = meet.select("family", "x", "id", "part", "n", "own", "other", *pair_of("own", "other"))
    by = ["family", "x", "l1", "l2"]
    mixed = meet.groupBy(*by).agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("size")).where("lo < hi").select(*by, "size")
    mixed = materialize(mixed, "mh-mixed")
    large = materialize(mixed.where(F.col("size") > GROUP).select("family", "x").distinct(), "mh-large")
    some_large = not large.isEmpty()
    hot = materialize(meet.join(large, ["family", "x"]).select(F.xxhash64("family", "x").alias("family"), "id", "part").distinct(), "mh-hot") if some_large else None
    small = mixed.join(large, ["family", "x"], "left_anti") if some_large else mixed
    both = materialize(meet.join(small.drop("size"), by), "mh-mixed")
    release(meet, mixed)
    meet = both
    left = meet.select("family", "x", F.col("own").alias("l1"), F.col("other").alias("l2"), F.col("id").alias("a"), F.col("part").alias("pa"), F.col("n").alias("na"))
    right = meet.select("family", "x", F.col("other").alias("l1"), F.col("own").alias("l2"), F.col("id").alias("b"), F.col("part").alias("pb"), F.col("n").alias("nb"))
    pairs = left.join(right, by).where((F.col("a") < F.col("b")) & (F.col("pa") != F.col("pb")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * p))
    pairs = materialize(pairs.select("a", "b").unionByName(star).distinct(), "mh-pair")
    release(d, meet)
    return pairs, hot


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with a similarity of ``percent`` on their full sets. A set that very many pairs need is on the
    other side of the join, whose hot partition adaptive execution splits."""
    x = materialize(pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b"), "mh-pair-set")
    y = x.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    inter = F.size(F.array_intersect("sa", "sb"))
    y = y.select("a", "b", inter.alias("i"), (F.size("sa") + F.size("sb")).alias("n"))
    return y.where(F.col("i") * 100 >= (F.col("n") - F.col("i")) * percent).select("a", "b")


def drop_near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which none with a smaller doc_id is in the same component."""
    kept = _searched(docs, text, key, k, percent).where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id"), F.col("t").alias("_kept_t")).distinct()
    doc_id, t = _rows(docs, text, key)
    return docs.join(kept, (doc_id == kept["_kept_id"]) & (t == kept["_kept_t"]), "left_semi")

"""Mixing sources to target weights: repetition rates from token totals, whole copies plus one seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions, word_count

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size, so no document repeats more often.
MAX_REPEATS = 3
SEED = "mix-1"


def source_targets(sized: DataFrame, source: str = "source", size: str = "size", weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target): the sum of all sizes shared by weight; a target stops at ``cap`` times
    its source's size and the excess is shared again by weight until none is above.

    That fixed point is min(cap * size, L * weight) for one level L. L is the first, in order of cap * size / weight,
    at which the sources from there on can take what those before leave: one running sum over one row a source. The
    rank that gives the weight, and that running sum, are taken over ranges of the key, so no task sees all sources."""
    totals = materialize(sized.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size")), "mix-sources")
    ranked = _running(totals, [F.col("source").isNull(), F.col("source")], {"rank": F.lit(1)})
    w = F.lit(0)
    for i, x in enumerate(weights):
        w = F.when((F.col("rank") - 1) % len(weights) == i, F.lit(x)).otherwise(w)
    ranked = ranked.select("source", "source_size", w.cast("long").alias("weight"))
    limit = F.col("source_size") * cap
    run = _running(ranked.withColumn("limit", limit), [F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source")], {"limits": F.col("limit"), "weights": F.col("weight")})
    run = materialize(run, "mix-run")
    whole = run.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w"))
    # what is left for a source and those after it, and their weights, if all before are at their limits
    left = run.crossJoin(F.broadcast(whole)).withColumn("rest", F.col("s") - (F.col("limits") - F.col("limit"))).withColumn("rest_w", F.col("w") - (F.col("weights") - F.col("weight")))
    wide = lambda a, b: F.col(a).cast("decimal(19,0)") * F.col(b).cast("decimal(18,0)")  # noqa: E731 - beyond 64 bits
    above = wide("limit", "rest_w") > wide("rest", "weight")
    level = left.where(above).agg(F.min(F.struct((F.col("rest_w") * -1).alias("neg"), F.col("rest").alias("rest"))).alias("l"))
    level = level.select(F.col("l.rest").alias("rest"), (F.col("l.neg") * -1).alias("rest_w"))
    share = F.col("rest").cast("double") * F.col("weight") / F.col("rest_w")
    target = F.when(above, share).otherwise(F.col("limit").cast("double"))
    return run.crossJoin(F.broadcast(level)).select("source", "source_size", "weight", target.alias("target"))


def _running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Running sums in a total order: ranges of the order are summed apart, then shifted by the sums of those before
    (one row a range)."""
    names = [f"_o{i}" for i in range(len(order))]
    df = df.withColumns(dict(zip(names, order, strict=True))).repartitionByRange(partitions(df.sparkSession), *names)
    df = materialize(df.withColumn("_range", F.spark_partition_id()).withColumns({f"_{k}": v.cast("long") for k, v in sums.items()}), "mix-ranges")
    w = Window.partitionBy("_range").orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({k: F.sum(f"_{k}").over(w) for k in sums})
    per = df.groupBy("_range").agg(*(F.sum(f"_{k}").alias(f"_{k}") for k in sums))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_range", *(F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_b{k}") for k in sums))
    out = local.join(F.broadcast(per), "_range")
    return out.withColumns({k: F.col(k) + F.col(f"_b{k}") for k in sums}).drop("_range", *names, *(f"_{k}" for k in sums), *(f"_b{k}" for k in sums))


def uniform(key: Column, seed: str = SEED) -> Column:
    """In [0, 1), from the first 32 bits of an MD5: the same in every run and in every engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 8), 16, 10).cast("double") / 4294967296.0


def _drawn(docs: DataFrame, text: str, key: str, seed: str) -> Column:
    """The number that a row draws: by its id, and where it has none by its text, so that such rows draw apart."""
    return uniform(F.coalesce(F.col(key).cast("string"), F.concat(F.lit("-"), F.md5(F.coalesce(F.col(text), F.lit(""))))), seed)


def _copies(target: Column, size: Column, draw: Column) -> Column:
    rate = F.when(size > 0, target / size).otherwise(0.0)
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), a row for each row of ``docs``: how often the mix takes it.

    The rate of a source is target / size; a document is taken floor(rate) times, and once more if its seeded uniform
    number is below the rest. A null text has size 0; null sources are one source, the last. Where all sizes of a source
    are 0 its target is 0 and its documents are not taken. Rows that repeat a doc_id are taken alike, rows without one by
    their text; an empty table gives an empty mix; the names of other columns don't matter. Texts are read once, for a
    table of their sizes."""
    sized, targets = _measured(docs, text, key, source, weights, cap, seed)
    out = sized.join(targets, F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "source", "size", "source_size", "target", _copies(F.col("target"), F.col("source_size"), F.col("draw")).alias("copies"))


def _measured(docs: DataFrame, text: str, key: str, source: str, weights: tuple[int, ...], cap: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The sizes and draws of all rows, and the targets (of, source_size, target) of their sources, as tables."""
    sized = materialize(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), _drawn(docs, text, key, seed).alias("draw")), "mix-sized")
    targets = materialize(source_targets(sized.select("source", "size"), weights=weights, cap=cap), "mix-targets")
    return sized, targets.select(F.col("source").alias("of"), "source_size", "target")


def mix_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken (see ``mix``), with the columns of ``docs``. How often
    follows from the row's source and draw, so rows meet the table of sources only."""
    _, targets = _measured(docs, text, key, source, weights, cap, seed)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(source).alias("source"), _drawn(docs, text, key, seed).alias("draw"))
    taken = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", _copies(F.col("target"), F.col("source_size"), F.col("draw"))).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")

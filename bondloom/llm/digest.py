"""Percentiles by merging centroid digests, with a counted bound on their rank error.

A digest is a set of centroids (mean, weight, least, most). Sorted values are clustered
where a function of their quantile steps to its next whole number: clusters are single
values in the tails and hold most in the middle. Digests merge by clustering their
centroids again, so summaries of days make those of months. All of it runs in the engine's
own operators: a sort per group, running sums, and an aggregation per cluster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.session import broadcast_if_small, checkpointed

#: Clusters of a digest at most. The rank error is of the order of 1 / SIZE in the middle.
SIZE = 500
QUANTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
#: Parts that a group's rows are counted in, so that a hot group is not one task's.
PARTS = 8
#: Groups whose quantiles, under 100 bytes each, may be broadcast.
FEW_GROUPS = 100_000
#: Rows that one part of a group is sorted with.
PART_ROWS = 1 << 20
#: Share of the values on each side of a quantile that its exact value is looked for among.
BRACKET = 0.006
CENTROID = ["mean", "weight", "least", "most"]


def _scale(q: Column, size: int) -> Column:
    """Rises by 1 over each cluster that may be formed at quantile ``q``."""
    return F.lit(size / (2 * math.pi)) * F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * q - 1)))


def _cluster(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Clusters rows of CENTROID, already exchanged by ``keys``."""
    order = Window.partitionBy(*keys).orderBy("mean", "least", "weight")
    total = F.sum("weight").over(Window.partitionBy(*keys))
    df = df.withColumns({"_total": total, "_upto": F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    at = lambda part: _scale((F.col("_upto") - F.col("weight") * part) / F.col("_total"), size)
    # A value that is wider than a cluster stays by itself, so that a heavy tie is answered exactly.
    heavy = F.when((F.col("least") == F.col("most")) & (at(0) - at(1) >= 1), F.col("mean"))
    df = df.withColumns({"_k": F.floor(at(0.5)), "_heavy": heavy})
    merged = df.groupBy(*keys, "_k", "_heavy").agg(
        # Equal values keep their value to the last bit, else the counts would miss the tie.
        F.when(F.min("least") == F.max("most"), F.min("least")).otherwise(F.sum(F.col("mean") * F.col("weight")) / F.sum("weight")).alias("mean"),
        F.sum("weight").alias("_w"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )
    return merged.select(*keys, "mean", F.col("_w").alias("weight"), "least", "most")


def build_digests(df: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """A digest per ``keys``: rows of keys and CENTROID. Null and NaN values are left out.

    Only keys and values are exchanged; equal values become one there. Null keys form a
    group of their own. An empty table gives no rows.
    """
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("mean")).repartition(*keys)
    rows = rows.groupBy(*keys, "mean").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return _cluster(rows.withColumns({"least": F.col("mean"), "most": F.col("mean")}), keys, size)


def merge_digests(digests: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """Digests of coarser ``keys`` from those of finer ones."""
    same = digests.select(*keys, *CENTROID).repartition(*keys).groupBy(*keys, "mean", "least", "most").agg(F.sum("weight").alias("weight"))
    return _cluster(same, keys, size)


def name_of(q: float) -> str:
    return f"p{round(q * 100):02d}"


def digest_quantiles(digests: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """keys, n and a column per quantile, named by ``name_of``."""
    return _read_off(digests, keys, quantiles, [name_of(q) for q in quantiles])


def _read_off(digests: DataFrame, keys: Sequence[str], quantiles: Sequence[float], names: Sequence[str]) -> DataFrame:
    """keys, n and a column per quantile, read between the centroids.

    A centroid stands at its middle rank, one of equal values at all its ranks. Between
    two of them the value is interpolated; outside it is the least or the most.
    """
    order = Window.partitionBy(*keys).orderBy("mean", "least", "weight")
    upto = F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0))
    half = F.when(F.col("least") == F.col("most"), F.lit(0.5)).otherwise(F.col("weight") / 2)
    df = digests.withColumns({"_n": F.sum("weight").over(Window.partitionBy(*keys)), "_from": upto - F.col("weight") + half, "_to": upto - half})
    df = df.withColumns({"_next": F.lead("mean").over(order), "_next_from": F.lead("_from").over(order), "_first": F.lag("_to").over(order).isNull()})
    picked = []
    for q, name in zip(quantiles, names):
        rank = F.lit(float(q)) * F.col("_n")
        share = (rank - F.col("_to")) / (F.col("_next_from") - F.col("_to"))
        here = (
            F.when(rank < F.col("_from"), F.when(F.col("_first"), F.col("least")))
            .when(rank <= F.col("_to"), F.col("mean"))
            .when(F.col("_next").isNull(), F.col("most"))
            .when(rank < F.col("_next_from"), F.col("mean") + share * (F.col("_next") - F.col("mean")))
        )
        picked.append(F.max(here).alias(name))
    return df.groupBy(*keys).agg(F.max("_n").cast("long").alias("n"), *picked)


def split_hot(df: DataFrame, sizes: DataFrame, keys: Sequence[str], row: str, target: int = PART_ROWS) -> DataFrame:
    """``df`` with a column ``part``: groups whose counted ``size`` in ``sizes`` is over
    ``target`` are split evenly by a hash of ``row``. Only those groups meet the rows; there is
    at most one for every ``target`` rows."""
    hot = sizes.where(F.col("size") > target).select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("size") / target).cast("int").alias("_parts"))
    met = df.join(broadcast_if_small(hot), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    return met.withColumn("part", F.coalesce(F.pmod(F.xxhash64(row), F.col("_parts")), F.lit(0)).cast("int")).drop("_parts", *[f"_{k}" for k in keys])


def exact_quantiles(df: DataFrame, digests: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """keys, n and per quantile q the exact value of rank ceil(q * n), at least 1.

    The digest gives two values that should enclose each; a counting pass finds how many rows
    lie under the lower one and whether the rank does lie between; where it does not the
    bracket is all values. Then only the rows inside, a few in a hundred, are counted by value
    and the rank is read off. Null and NaN values are left out; null keys are a group.
    """
    names = [name_of(q) for q in quantiles]
    wide = [min(1.0, max(0.0, q + side * BRACKET)) for q in quantiles for side in (-1, 1)]
    read = _read_off(digests, keys, wide, [f"_b{i}" for i in range(len(wide))])
    ends = digests.groupBy(*keys).agg(F.min("least").alias("_least"), F.max("most").alias("_most"))
    same = lambda k: F.col(k).eqNullSafe(F.col(f"_{k}"))
    aside = lambda df: df.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in df.columns if c not in keys])
    box = lambda i: F.struct(F.lit(i).alias("i"), F.col(f"_b{2 * i}").alias("lo"), F.col(f"_b{2 * i + 1}").alias("hi"))
    boxes = checkpointed(read.join(aside(ends), [same(k) for k in keys]).select(*keys, F.col("n"), "_least", "_most", F.array(*[box(i) for i in range(len(names))]).alias("_box")))
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))
    few = boxes.count() <= FEW_GROUPS
    side = lambda b: F.broadcast(aside(b)) if few else aside(b)
    at = lambda i, part: F.get("_box", F.lit(i))[part]
    met = rows.join(side(boxes.select(*keys, "_box")), [same(k) for k in keys])
    counts = [f(i).alias(f"_{name}{i}") for i in range(len(names)) for name, f in (("lt", lambda i: F.count_if(F.col("_v") < at(i, "lo"))), ("le", lambda i: F.count_if(F.col("_v") <= at(i, "hi"))))]
    counted = met.groupBy(*keys).agg(*counts)
    rank = lambda q: F.greatest(F.lit(1), F.ceil(F.round(F.lit(float(q)) * F.col("n"), 6)))
    sure = lambda i, q: (F.col(f"_lt{i}") < rank(q)) & (rank(q) <= F.col(f"_le{i}"))
    firm = lambda i, q: F.struct(F.lit(i).alias("i"), F.when(sure(i, q), at(i, "lo")).otherwise(F.col("_least")).alias("lo"), F.when(sure(i, q), at(i, "hi")).otherwise(F.col("_most")).alias("hi"), (rank(q) - F.when(sure(i, q), F.col(f"_lt{i}")).otherwise(0)).alias("rank"))
    joined = boxes.join(aside(counted), [same(k) for k in keys])
    final = checkpointed(joined.select(*keys, "n", F.array(*[firm(i, q) for i, q in enumerate(quantiles)]).alias("_box")))
    inside = rows.join(side(final.select(*keys, "_box")), [same(k) for k in keys])
    hits = inside.select(*keys, "_v", F.explode(F.filter("_box", lambda b: (F.col("_v") >= b["lo"]) & (F.col("_v") <= b["hi"]))).alias("_b"))
    # Copies of a value are summed where they are; a bracket's values, not a group's, are sorted.
    values = hits.groupBy(*keys, F.col("_b.i").alias("_i"), "_v").agg(F.count(F.lit(1)).alias("_c"), F.first("_b.rank").alias("_rank"))
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    picked = values.withColumn("_upto", upto).where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank")))
    wide_rows = picked.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(name) for i, name in enumerate(names)])
    return final.select(*keys, "n").join(aside(wide_rows), [same(k) for k in keys]).select(*keys, "n", *names)


def certify(df: DataFrame, quantile_rows: DataFrame, keys: Sequence[str], value: str, part: Column, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``quantile_rows`` with ``rank_error``: the largest distance, as a share of n, between
    a quantile and the ranks that its value has in ``df``, found by counting again.

    The quantiles of up to FEW_GROUPS groups are sent to the rows. Beyond that both sides
    are exchanged: ``part`` spreads the rows of a group, each of PARTS parts meets a copy of
    the group's quantiles. Counts are summed where the rows are before they are exchanged.
    """
    quantile_rows = checkpointed(quantile_rows)  # a row per group, read twice
    names = [name_of(q) for q in quantiles]
    side = quantile_rows.select(*[F.col(k).alias(f"_{k}") for k in keys], F.array(*names).alias("_q"))
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"), F.pmod(part, F.lit(PARTS)).cast("int").alias("_p"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    if quantile_rows.count() <= FEW_GROUPS:
        met = rows.join(F.broadcast(side), same)
    else:
        met = rows.join(side.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))), [*same, F.col("_p") == F.col("_part")])
    counts = [c for i in range(len(names)) for c in (F.count_if(F.col("_v") < F.get("_q", F.lit(i))).alias(f"_lt{i}"), F.count_if(F.col("_v") <= F.get("_q", F.lit(i))).alias(f"_le{i}"))]
    counted = met.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
    off = [F.greatest(F.lit(0.0), F.col(f"_lt{i}") / F.col("_n") - q, q - F.col(f"_le{i}") / F.col("_n")) for i, q in enumerate(quantiles)]
    errors = counted.select(*[F.col(k).alias(f"_{k}") for k in keys], F.greatest(*off).alias("rank_error"))
    return quantile_rows.join(errors, same).select(*quantile_rows.columns, "rank_error")

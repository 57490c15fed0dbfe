"""Totals over trailing calendar windows, days without activity included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days per block: a hot entity is spread over its blocks, and a block's totals meet
#: in one task before the exchange, so each output day is sent about twice, not 30 times.
BLOCK_DAYS = 128


def latest_rows(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str], part: Sequence[str | Column] = ()) -> DataFrame:
    """The row of greatest ``order`` for each key, as ``keys`` and ``values``.

    Rows with a null key are left out. ``part`` names coarser columns to exchange on.
    """
    df = df.dropna(subset=list(keys))
    if part:
        df = df.repartition(*part)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order)).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[v].alias(v) for v in values])


def trailing_totals(
    df: DataFrame,
    entity: str,
    day: str,
    order: str,
    measures: Sequence[str],
    windows: Sequence[int] = (7, 30),
) -> DataFrame:
    """Sum and daily mean of ``measures`` over the trailing ``windows``, per entity and day.

    ``df`` may hold several arrivals for one (entity, day): the one of greatest ``order``
    is valid. There is a row for each calendar day from the entity's first to its last
    day. Each valid row is exploded onto the days that it influences, summed per entity
    and day, and joined to the calendar.

    Nulls: a null measure counts as 0; rows with a null entity or day are left out. An
    empty table gives no rows. The mean divides by the window's length, also near the
    first day. Other columns of ``df``, whatever their names, are ignored.
    """
    longest = max(windows)
    slim = df.select(F.col(entity).alias("_e"), F.col(day).alias("_d"), F.col(order).alias("_o"), *[F.col(m).cast("long").alias(f"_m{i}") for i, m in enumerate(measures)])
    slim = slim.dropna(subset=["_e", "_d"]).withColumn("_b", F.floor(F.unix_date("_d") / BLOCK_DAYS))
    cells = [f"_m{i}" for i in range(len(measures))]
    # One exchange on (entity, block) serves the choice of valid rows and the local sums.
    valid = latest_rows(slim, ["_e", "_b", "_d"], "_o", cells, ["_e", "_b"])
    spread = valid.select("_e", "_d", *cells, F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("_lag"))
    sums = [
        F.sum(F.when(F.col("_lag") < w, F.coalesce(c, F.lit(0))).otherwise(F.lit(0))).alias(f"{c}_{w}")
        for c in cells
        for w in windows
    ]
    totals = spread.groupBy("_e", F.date_add("_d", F.col("_lag")).alias("_out")).agg(*sums)
    bounds = slim.groupBy("_e").agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
    calendar = bounds.select("_e", F.explode(F.sequence("_lo", "_hi")).alias("_out"))
    joined = calendar.join(totals, ["_e", "_out"], "left")
    out: list[Column] = [F.col("_e").alias(entity), F.col("_out").alias(day)]
    for c, m in zip(cells, measures):
        for w in windows:
            total = F.coalesce(F.col(f"{c}_{w}"), F.lit(0).cast("long"))
            out += [total.alias(f"{m}_sum_{w}d"), (total / F.lit(float(w))).alias(f"{m}_mean_{w}d")]
    return joined.select(*out)

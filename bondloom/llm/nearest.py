"""Pairing each left record with the right record nearest in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    *,
    entity: str,
    left_time: str,
    right_time: str,
    left_id: str,
    right_id: str,
    tolerance_s: int,
) -> DataFrame:
    """(left_id, right_id, gap_s) of the right row nearest to each left row.

    Both tables are unioned, sorted per entity and time, and the last and next right
    rows are carried onto each left row. The nearer one within ``tolerance_s`` seconds
    (inclusive) wins; of equally near ones that of smaller ``right_id``.

    The sort runs within (entity, slot): slots are at least twice the tolerance long and
    a day at least, and a right row also enters the slot that its tolerance reaches
    into, so a hot entity is spread over its days and no pair is lost.

    Left rows without a partner are left out, as are rows of either side with a null
    entity, time or id. Repeated rows are all answered; empty tables give no rows. Only
    the named columns are read, so further columns may clash.
    """
    slot = max(2 * tolerance_s, 86_400) * 1_000_000
    reach = tolerance_s * 1_000_000
    lhs = left.select(F.col(entity).alias("_e"), F.unix_micros(F.col(left_time).cast("timestamp")).alias("_t"), F.col(left_id).cast("long").alias("_l"))
    rhs = right.select(F.col(entity).alias("_e"), F.unix_micros(F.col(right_time).cast("timestamp")).alias("_t"), F.col(right_id).cast("long").alias("_r"))
    lhs = lhs.dropna().withColumn("_s", F.floor(F.col("_t") / slot))
    ends = F.array_distinct(F.array(F.floor((F.col("_t") - reach) / slot), F.floor((F.col("_t") + reach) / slot)))
    rhs = rhs.dropna().withColumn("_s", F.explode(ends))
    both = lhs.withColumn("_r", F.lit(None).cast("long")).unionByName(rhs.withColumn("_l", F.lit(None).cast("long")))
    # Running frames only: each direction streams over its own sort. Right rows precede
    # left ones of the same instant; of right rows at one instant the smallest id is last.
    ahead = Window.partitionBy("_e", "_s").orderBy(F.col("_t"), F.col("_l").asc_nulls_first(), F.col("_r").desc())
    back = Window.partitionBy("_e", "_s").orderBy(F.col("_t").desc(), F.col("_l").asc_nulls_first(), F.col("_r").desc())
    here = F.when(F.col("_r").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_r").alias("r")))
    both = both.withColumn("_prev", F.last(here, True).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    both = both.withColumn("_next", F.last(here, True).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    gaps = [F.struct(F.abs(F.col("_t") - F.col(c)["t"]).alias("g"), F.col(c)["r"].alias("r")) for c in ("_prev", "_next")]
    best = F.least(*[F.when(F.col(c).isNotNull(), g) for c, g in zip(("_prev", "_next"), gaps)])
    found = both.where(F.col("_l").isNotNull()).select("_l", best.alias("_best")).where(F.col("_best")["g"] <= reach)
    return found.select(F.col("_l").alias(left_id), F.col("_best")["r"].alias(right_id), (F.col("_best")["g"] / 1e6).alias("gap_s"))

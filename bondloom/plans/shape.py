"""Curve points, spreads between them, and their signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondloom.functions.curve import predict
from bondloom.plans.curve import LAMBDA
from bondloom.plans.relative_value import rolling_z

# Fixed values of the shape signals.
POINTS, SHORT, LONGS = (2, 5, 8, 10, 12), 2, (5, 8, 10, 12)
KERNEL, BAND, SIGNAL_Z, HORIZON, LEAST_EVENTS = 0.75, 1.0, 1.5, 10, 20


def points(residual: DataFrame) -> DataFrame:
    """Yield of each day at POINTS years: the curve plus the kernel mean of near residuals.

    A quote is exploded onto the points it is near to, then summed per day and point.
    """
    at = F.explode(F.array(*[F.lit(float(p)) for p in POINTS])).alias("point")
    days = residual.groupBy("obs_date").agg(*[F.first(c).alias(c) for c in ("beta0", "beta1", "beta2")]).select("*", at)
    near = residual.select("obs_date", "tau", "residual_bp", "weight", "spread_bp", at)
    far = (F.col("tau") - F.col("point")) / KERNEL
    near = near.withColumn("k", F.when(F.abs(far) <= 3, F.coalesce("weight", F.lit(1.0)) * F.exp(-0.5 * far * far)).otherwise(0.0))
    in_band = F.abs(F.col("tau") - F.col("point")) <= BAND
    sums = near.groupBy("obs_date", "point").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("residual_bp")).alias("kr"), (F.percentile(F.when(in_band, F.col("spread_bp")), F.lit(0.5)) / 2).alias("half_bp"))
    level = predict(F.col("point"), F.lit(LAMBDA), F.col("beta0"), F.col("beta1"), F.col("beta2"))
    lift = F.when(F.col("k") > 0, F.col("kr") / F.col("k") / 100).otherwise(0.0)
    return days.join(sums, ["obs_date", "point"]).select("obs_date", "point", level.alias("curve_yield"), (level + lift).alias("point_yield"), "half_bp")


def spreads(pts: DataFrame) -> DataFrame:
    """Long less short point of each pair and day, with the cost of trading it."""
    short = pts.where(F.col("point") == SHORT).select("obs_date", *[F.col(c).alias(f"s_{c}") for c in ("curve_yield", "point_yield", "half_bp")])
    both = pts.where(F.col("point") != SHORT).join(short, "obs_date")
    name = F.concat(F.lit(f"{SHORT}s"), F.col("point").cast("int").cast("string"), F.lit("s"))
    bp = lambda c: (F.col(c) - F.col(f"s_{c}")) * 100
    return both.select("obs_date", name.alias("pair"), bp("point_yield").alias("spread_bp"), bp("curve_yield").alias("curve_only_bp"), (F.col("half_bp") + F.col("s_half_bp")).alias("cost_bp"))


def spread_signals(s: DataFrame) -> DataFrame:
    """Scored spreads; days without a score yet are kept."""
    return rolling_z(s, ["pair"], "spread_bp")


def reversion(signals: DataFrame) -> DataFrame:
    """Gain of fading a stretched spread from the day after, by rows; null if too few."""
    rows = Window.partitionBy("pair").orderBy("obs_date")
    df = signals.withColumn("fwd", F.lead("spread_bp", HORIZON + 1).over(rows) - F.lead("spread_bp", 1).over(rows))
    df = df.where((F.abs("zscore") >= SIGNAL_Z) & F.col("fwd").isNotNull())
    agg = df.groupBy("pair").agg(F.count(F.lit(1)).alias("n"), F.avg(-F.signum("zscore") * F.col("fwd")).alias("_g"))
    return agg.select("pair", "n", F.when(F.col("n") >= LEAST_EVENTS, F.col("_g")).alias("reversion_bp"))


def as_of(signals: DataFrame, gave_back: DataFrame) -> DataFrame:
    """Each spread in its history so far, and whether reversion clears its cost."""
    upto = Window.partitionBy("pair").orderBy("obs_date").rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("pair").orderBy("obs_date")
    df = signals.withColumns({"low_bp": F.min("spread_bp").over(upto), "high_bp": F.max("spread_bp").over(upto), "change_20d_bp": F.col("spread_bp") - F.lag("spread_bp", 20).over(order)})
    df = df.join(gave_back.select("pair", "reversion_bp"), "pair", "left")
    verdict = F.when(F.col("reversion_bp").isNull(), "not measured yet").when(F.col("cost_bp").isNull(), "cost unknown").when(F.col("reversion_bp") > F.col("cost_bp"), "clears costs").otherwise("below costs")
    return df.select("obs_date", "pair", "spread_bp", "low_bp", "high_bp", "change_20d_bp", verdict.alias("verdict"))

"""The daily curve: usable quotes and trades, weights, fit, residuals, trade check, decay."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondloom.functions.codecs import steps
from bondloom.functions.curve import loadings, predict
from bondloom.session import table

# Fixed values of the curve.
LAMBDA, MIN_TAU, MIN_BONDS = 2.5, 0.08, 6
LEAST_SPREAD, MOST_SPREAD, USUAL_SPREAD = 1.0, 300.0, 20.0
GRID = [0.3 * math.exp(k * math.log(12.0 / 0.3) / 79) for k in range(80)]
TOLERANCE, STALE_DAYS = 0.02, 3


def valid_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivered quote row of each day and bond."""
    rows = table(spark, sf_dir, "observations").where("source = 'pdmo_daily' and (bid_yield is not null or offer_yield is not null)")
    best = rows.groupBy("obs_date", "isin").agg(F.max_by(F.struct("bid_yield", "offer_yield", "mid_yield"), "obs_seq").alias("r"))
    return best.select("obs_date", "isin", F.col("r.bid_yield").alias("bid"), F.col("r.offer_yield").alias("offer"), F.col("r.mid_yield").alias("mid"))


def valid_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid trade row of each day and security."""
    values = ("security_type", "wavg_yield", "volume_lkr", "n_trades")
    best = table(spark, sf_dir, "trade_summary").groupBy("obs_date", "isin").agg(F.max_by(F.struct(*values), "trade_seq").alias("r"))
    return best.select("obs_date", "isin", "r.*")


def _with_tau(df: DataFrame, bonds: DataFrame) -> DataFrame:
    held = bonds.where("maturity_date is not null").where(F.size(steps(F.col("series_label"))) <= 1).select("isin", "maturity_date", "coupon_pct")
    joined = df.join(held, "isin").withColumn("tau", F.date_diff("maturity_date", "obs_date") / F.lit(365.25))
    return joined.where(F.col("tau") >= MIN_TAU)


def usable_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = _with_tau(valid_quotes(spark, sf_dir).where("mid is not null"), table(spark, sf_dir, "bonds"))
    return quotes.select("obs_date", "isin", "tau", "bid", "offer", "mid", ((F.col("bid") - F.col("offer")) * 100).alias("spread_bp"))


def usable_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = valid_trades(spark, sf_dir).where("security_type = 'TBond' and wavg_yield is not null")
    return _with_tau(trades, table(spark, sf_dir, "bonds")).select("obs_date", "isin", "tau", F.col("wavg_yield").alias("traded"), "volume_lkr", "n_trades")


def weighed(quotes: DataFrame) -> DataFrame:
    """Weights by the inverse square of the spread; a day's mean weight is 1."""
    day = Window.partitionBy("obs_date")
    wide = F.abs("spread_bp")
    usual = F.coalesce(wide, F.percentile(wide, F.lit(0.5)).over(day), F.lit(USUAL_SPREAD))
    s = F.least(F.lit(MOST_SPREAD), F.greatest(F.lit(LEAST_SPREAD), usual))
    df = quotes.withColumn("raw", 1 / (s * s))
    return df.withColumn("weight", F.col("raw") / F.avg("raw").over(day)).drop("raw")


def _solve(df: DataFrame, keys: list[str], lam: Column) -> DataFrame:
    """Weighted least squares per key as nine sums and Cramer's rule."""
    f1, f2 = loadings(F.col("tau"), lam)
    df = df.withColumns({"f1": f1, "f2": f2})
    w, y, a, b = (F.col(c) for c in ("weight", "mid", "f1", "f2"))
    sums = {"s0": w, "s1": w * a, "s2": w * b, "s11": w * a * a, "s12": w * a * b, "s22": w * b * b, "y0": w * y, "y1": w * a * y, "y2": w * b * y, "yy": w * y * y}
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(v).alias(k) for k, v in sums.items()])
    s0, s1, s2, s11, s12, s22, y0, y1, y2 = (F.col(c) for c in ("s0", "s1", "s2", "s11", "s12", "s22", "y0", "y1", "y2"))
    det = s0 * (s11 * s22 - s12 * s12) - s1 * (s1 * s22 - s12 * s2) + s2 * (s1 * s12 - s11 * s2)
    b0 = (y0 * (s11 * s22 - s12 * s12) - s1 * (y1 * s22 - s12 * y2) + s2 * (y1 * s12 - s11 * y2)) / det
    b1 = (s0 * (y1 * s22 - s12 * y2) - y0 * (s1 * s22 - s12 * s2) + s2 * (s1 * y2 - y1 * s2)) / det
    b2 = (s0 * (s11 * y2 - y1 * s12) - s1 * (s1 * y2 - y1 * s2) + y0 * (s1 * s12 - s11 * s2)) / det
    # The guard is free of scale: the determinant against the product of the diagonal.
    solved = agg.where((F.col("n") >= MIN_BONDS) & (F.abs(det) > 1e-12 * s0 * s11 * s22))
    return solved.select(*keys, "n", "yy", "y0", "y1", "y2", b0.alias("beta0"), b1.alias("beta1"), b2.alias("beta2"))


def residuals(quotes: DataFrame, lam: float = LAMBDA) -> DataFrame:
    """Quotes of fitted days with betas, fitted yield, residual in bp and weight."""
    w = weighed(quotes)
    fits = _solve(w, ["obs_date"], F.lit(lam)).select("obs_date", "n", "beta0", "beta1", "beta2")
    df = w.join(fits, "obs_date")
    fitted = predict(F.col("tau"), F.lit(lam), F.col("beta0"), F.col("beta1"), F.col("beta2"))
    return df.withColumn("fitted", fitted).withColumn("residual_bp", (F.col("mid") - F.col("fitted")) * 100)


def fits(quotes: DataFrame, lam: float = LAMBDA) -> DataFrame:
    """A row per fitted day: betas and the weighted error."""
    return fits_of(residuals(quotes, lam))


def fits_of(residual: DataFrame) -> DataFrame:
    """The fits that ``residuals`` were taken from."""
    error = F.sqrt(F.sum(F.col("weight") * F.pow(F.col("residual_bp") / 100, 2)) / F.sum("weight")) * 100
    once = [F.first(c).alias(c) for c in ("beta0", "beta1", "beta2")]
    return residual.groupBy("obs_date").agg(*once, F.count(F.lit(1)).alias("n_quotes"), error.alias("rmse_bp"))


def trade_residuals(trades: DataFrame, fitted: DataFrame, lam: float = LAMBDA) -> DataFrame:
    """Trades, never fitted, against the curve of their day."""
    df = trades.join(fitted.select("obs_date", "beta0", "beta1", "beta2"), "obs_date")
    level = predict(F.col("tau"), F.lit(lam), F.col("beta0"), F.col("beta1"), F.col("beta2"))
    return df.withColumn("residual_bp", (F.col("traded") - level) * 100)


def trade_check(trades: DataFrame, fitted: DataFrame) -> DataFrame:
    """Per day: number, error and median of the held-out trades."""
    r = trade_residuals(trades, fitted)
    return r.groupBy("obs_date").agg(F.count(F.lit(1)).alias("n_trades"), F.sqrt(F.avg(F.pow("residual_bp", F.lit(2)))).alias("trade_rmse_bp"), F.percentile("residual_bp", F.lit(0.5)).alias("trade_bias_bp"))


def day_errors(quotes: DataFrame) -> DataFrame:
    """(obs_date, lam, rss): the weighted error of each day with enough quotes at each decay of the grid.

    Under short decays both loadings are nearly multiples of each other and sums of squares
    lose the error, so a day's 80 small systems are solved by singular values, in Python.
    Directions under the rounding error are left out, as lstsq does; no day is.
    """
    grid, least = GRID, MIN_BONDS

    def solve(day: pd.DataFrame) -> pd.DataFrame:
        if len(day) < least:
            return pd.DataFrame({"obs_date": [], "lam": [], "rss": []})
        lam, root = np.array(grid), np.sqrt(day["weight"].to_numpy())
        x = day["tau"].to_numpy()[None, :] / lam[:, None]
        decay = np.exp(-x)
        slope = (1 - decay) / x  # tau is at least MIN_TAU
        u, s, _ = np.linalg.svd(np.stack([np.ones_like(x), slope, slope - decay], axis=2) * root[None, :, None], full_matrices=False)
        u = u * (s > np.finfo(float).eps * max(len(day), 3) * s[:, :1])[:, None, :]
        y = day["mid"].to_numpy() * root
        rest = y - np.einsum("gnk,gk->gn", u, np.einsum("gnk,n->gk", u, y))
        return pd.DataFrame({"obs_date": day["obs_date"].iloc[0], "lam": lam, "rss": (rest**2).sum(axis=1)})

    slim = weighed(quotes).select("obs_date", "tau", "mid", "weight")
    return slim.groupBy("obs_date").applyInPandas(solve, "obs_date date, lam double, rss double")


def best_decays(errors: DataFrame) -> DataFrame:
    """The decay of least error of each day; of equal ones the shortest."""
    return errors.groupBy("obs_date").agg(F.min(F.struct("rss", "lam")).alias("b")).select("obs_date", F.col("b.lam").alias("lambda_years"))


def decay_errors(quotes: DataFrame) -> DataFrame:
    """Weighted residual sum of squares over all days for each decay of the grid."""
    return day_errors(quotes).groupBy("lam").agg(F.sum("rss").alias("rss"), F.count(F.lit(1)).alias("n_days"))


def calibrated(errors: DataFrame) -> DataFrame:
    """The smallest decay whose error is within TOLERANCE of the least."""
    least = F.min("rss").over(Window.partitionBy())  # 80 rows
    return errors.withColumn("least", least).where(F.col("rss") <= F.col("least") * (1 + TOLERANCE)).agg(F.min("lam").alias("lambda_years"))


def check_age(fitted: DataFrame, check: DataFrame) -> DataFrame:
    """For each fitted day the last day with a trade check, its age, and whether it is stale."""
    df = fitted.select("obs_date").join(check.select("obs_date", F.col("obs_date").alias("checked")), "obs_date", "left")
    month = F.trunc("obs_date", "month")
    # Days are few (one row each), still they are carried month by month.
    inside = Window.partitionBy("month").orderBy("obs_date").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("month", month).withColumn("own", F.last("checked", True).over(inside))
    tops = df.groupBy("month").agg(F.max("checked").alias("top"))
    tops = tops.withColumn("before", F.max("top").over(Window.partitionBy().orderBy("month").rowsBetween(Window.unboundedPreceding, -1)))
    last = F.coalesce("own", "before")
    df = df.join(tops.select("month", "before"), "month").withColumn("checked_on", last)
    age = F.date_diff("obs_date", "checked_on")
    return df.select("obs_date", "checked_on", age.alias("age_days"), (age > STALE_DAYS).alias("stale"))

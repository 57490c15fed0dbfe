"""Queries of the curve and relative-value plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.plans import curve, relative_value
from bondloom.queries.sql import BASE, rounded
from bondloom.session import checkpointed, table


def r4(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Doubles rounded for the comparison of two engines."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def _residuals(spark: SparkSession, d: str) -> DataFrame:
    return curve.residuals(curve.usable_quotes(spark, d))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Residuals written once: pairs read them twice."""
    return checkpointed(_residuals(spark, d).select("obs_date", "isin", "tau", "residual_bp"))


def curve_quotes(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.usable_quotes(spark, d), "tau", "spread_bp")


def curve_trades(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.usable_trades(spark, d), "tau")


def quote_weights(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.weighed(curve.usable_quotes(spark, d)).select("obs_date", "isin", "weight"), "weight")


def curve_fit(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.fits(curve.usable_quotes(spark, d)), "beta0", "beta1", "beta2", "rmse_bp")


def curve_residuals(spark: SparkSession, d: str) -> DataFrame:
    return r4(_residuals(spark, d).select("obs_date", "isin", "tau", "fitted", "residual_bp"), "tau", "fitted", "residual_bp")


def curve_trade_check(spark: SparkSession, d: str) -> DataFrame:
    fitted = curve.fits(curve.usable_quotes(spark, d))
    return r4(curve.trade_check(curve.usable_trades(spark, d), fitted), "trade_rmse_bp", "trade_bias_bp")


def trade_check_age(spark: SparkSession, d: str) -> DataFrame:
    fitted = curve.fits(curve.usable_quotes(spark, d))
    return curve.check_age(fitted, curve.trade_check(curve.usable_trades(spark, d), fitted))


def lambda_grid_rss(spark: SparkSession, d: str) -> DataFrame:
    errors = curve.decay_errors(curve.usable_quotes(spark, d))
    return errors.select(F.round("lam", 6).alias("lam"), (F.round("rss", 2) + F.lit(0.0)).alias("rss"), "n_days")


def lambda_per_day(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.best_decays(curve.day_errors(curve.usable_quotes(spark, d))), "lambda_years")


def lambda_calibrated(spark: SparkSession, d: str) -> DataFrame:
    return r4(curve.calibrated(curve.decay_errors(curve.usable_quotes(spark, d))), "lambda_years")


def bond_zscores(spark: SparkSession, d: str) -> DataFrame:
    z = relative_value.bond_signals(_residuals(spark, d)).where("zscore is not null")
    return r4(z.select("obs_date", "isin", "residual_bp", "mean_bp", "sd_bp", "dislocation_bp", "zscore", "n_window"), "residual_bp", "mean_bp", "sd_bp", "dislocation_bp", "zscore")


def _pair_bonds(spark: SparkSession, d: str, residual: DataFrame) -> DataFrame:
    return checkpointed(relative_value.pair_bonds(residual, table(spark, d, "auctions")))


def switch_pairs(spark: SparkSession, d: str) -> DataFrame:
    return r4(relative_value.pairs(relative_value.pair_bonds(_stored(spark, d), table(spark, d, "auctions"))), "tau_a", "tau_b")


def _switches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Residuals and the bonds of the pairs."""
    residual = _stored(spark, d)
    return residual, _pair_bonds(spark, d, residual)


def switch_zscores(spark: SparkSession, d: str) -> DataFrame:
    residual, bonds = _switches(spark, d)
    # Bonds are named once a pair, before its days become rows.
    z = relative_value.daily(relative_value.named(relative_value.switch_series(residual, bonds, digits=3), bonds))
    return z.select("obs_date", "isin_a", "isin_b", "spread_bp", "zscore", "n_window")


def switch_reversion(spark: SparkSession, d: str) -> DataFrame:
    return r4(relative_value.switch_reversion(*_switches(spark, d)), "capture_bp")


NAMES: Sequence[str] = (
    "curve_quotes", "curve_trades", "quote_weights", "curve_fit", "curve_residuals", "curve_trade_check", "trade_check_age",
    "lambda_grid_rss", "lambda_per_day", "lambda_calibrated", "bond_zscores", "switch_pairs", "switch_zscores", "switch_reversion",
)
QUERIES = {name: globals()[name] for name in NAMES}

SQL = {
    "curve_quotes": f"{BASE} select obs_date, isin, {rounded('tau', 'spread_bp')}, bid, offer, mid from q",
    "curve_trades": f"{BASE} select obs_date, isin, {rounded('tau')}, traded, volume_lkr, n_trades from t",
    "quote_weights": f"{BASE} select obs_date, isin, {rounded('weight')} from w",
    "curve_fit": f"{BASE} select obs_date, {rounded('beta0', 'beta1', 'beta2', 'rmse_bp')}, n_quotes from fit",
    "curve_residuals": f"{BASE} select obs_date, isin, {rounded('tau', 'fitted', 'residual_bp')} from res",
    "curve_trade_check": f"{BASE} select obs_date, n_trades, {rounded('trade_rmse_bp', 'trade_bias_bp')} from chk",
    "trade_check_age": f"""{BASE} select f.obs_date, max(c.obs_date) checked_on, cast(f.obs_date - max(c.obs_date) as int) age_days, f.obs_date - max(c.obs_date) > 3 stale
from fit f left join chk c on c.obs_date <= f.obs_date group by f.obs_date""",
    "lambda_grid_rss": f"{BASE} select round(lam, 6) lam, round(rss, 2) + 0 rss, n_days from grid",
    "lambda_per_day": f"{BASE} select obs_date, round(arg_min(lam, rss), 4) + 0 as lambda_years from gday group by 1",
    "lambda_calibrated": f"{BASE} select {rounded('lambda_years')} from (select min(lam) lambda_years from grid where rss <= (select min(rss) from grid) * 1.02e0)",
    "bond_zscores": f"{BASE} select obs_date, isin, {rounded('residual_bp', 'mean_bp', 'sd_bp', 'dislocation_bp', 'zscore')}, n_window from z where zscore is not null",
    "switch_pairs": f"{BASE} select isin_a, isin_b, {rounded('tau_a', 'tau_b')} from pr",
    "switch_zscores": f"{BASE} select obs_date, isin_a, isin_b, {rounded('spread_bp', 'zscore', digits=3)}, n_window from sz",
    "switch_reversion": f"""{BASE}, fw as (select s.*, (select arg_min(x.spread_bp, x.obs_date) from sz x where x.isin_a = s.isin_a and x.isin_b = s.isin_b and x.obs_date - s.obs_date - (case isodow(s.obs_date) when 6 then 13 when 7 then 12 else 14 end) between 0 and 4) - spread_bp fwd from sz s)
select threshold, n, {rounded('capture_bp')} from (select threshold, count(*) n, case when count(*) >= 30 then avg(-sign(zscore) * fwd) end capture_bp
from fw, (values (2.0e0), (3.0e0)) v(threshold) where fwd is not null and abs(zscore) >= threshold group by 1)""",
}

"""Queries of the shape, market and validation plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.functions.curve import price_and_duration
from bondloom.plans import curve, market, relative_value, shape, validation
from bondloom.queries.curve import r4
from bondloom.queries.sql import _ROLL, BASE, MARKET, rounded
from bondloom.session import broadcast_if_small, checkpointed, table


def _res(spark: SparkSession, d: str) -> DataFrame:
    return curve.residuals(curve.usable_quotes(spark, d))


def _once(spark: SparkSession, d: str) -> DataFrame:
    """Residuals written once, for plans that read them several times."""
    columns = ("obs_date", "isin", "tau", "mid", "beta0", "beta1", "beta2", "residual_bp")
    return checkpointed(_res(spark, d).select(*columns))


def _days(spark: SparkSession, d: str, residual: DataFrame | None = None) -> DataFrame:
    """A row per day, written once: the plans read it several times."""
    return broadcast_if_small(checkpointed(market.scoring_days(_res(spark, d) if residual is None else residual)))


def _trades_once(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(curve.usable_trades(spark, d))


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    return market.gaps(_res(spark, d), curve.usable_trades(spark, d))


def _spreads(spark: SparkSession, d: str) -> DataFrame:
    return shape.spread_signals(shape.spreads(shape.points(_res(spark, d))))


def curve_points(spark: SparkSession, d: str) -> DataFrame:
    return r4(shape.points(_res(spark, d)), "curve_yield", "point_yield", "half_bp")


def curve_spread_z(spark: SparkSession, d: str) -> DataFrame:
    s = _spreads(spark, d).select("obs_date", "pair", "spread_bp", "curve_only_bp", "cost_bp", "zscore")
    return r4(s, "spread_bp", "curve_only_bp", "cost_bp", "zscore", digits=3)


def curve_spread_reversion(spark: SparkSession, d: str) -> DataFrame:
    return r4(shape.reversion(_spreads(spark, d)), "reversion_bp")


def curve_spread_asof(spark: SparkSession, d: str) -> DataFrame:
    s = checkpointed(_spreads(spark, d))
    return r4(shape.as_of(s, shape.reversion(s)), "spread_bp", "low_bp", "high_bp", "change_20d_bp", digits=3)


def spread_monthly_pivot(spark: SparkSession, d: str) -> DataFrame:
    s = shape.spreads(shape.points(_res(spark, d))).withColumn("month", F.trunc("obs_date", "month"))
    names = [f"2s{k}s" for k in shape.LONGS]
    wide = s.groupBy("month").pivot("pair", names).agg(F.avg("spread_bp"))
    return r4(wide.select("month", *[F.col(n).alias(f"m{n}") for n in names]), *[f"m{n}" for n in names], digits=3)


def liquidity_tiers(spark: SparkSession, d: str) -> DataFrame:
    return r4(market.liquidity(curve.valid_trades(spark, d), market.valid_auctions(spark, d), _days(spark, d)), "bid_to_cover", "last_trade_yield", digits=8)


def funding_rate(spark: SparkSession, d: str) -> DataFrame:
    return r4(market.funding(curve.valid_trades(spark, d), _days(spark, d)), "bill_pct", "rate_pct")


def bond_price_duration(spark: SparkSession, d: str) -> DataFrame:
    q = curve.usable_quotes(spark, d).join(table(spark, d, "bonds").where("coupon_pct is not null").select("isin", "coupon_pct"), "isin")
    price, duration = price_and_duration(F.col("mid"), F.col("coupon_pct"), F.col("tau"))
    return r4(q.select("obs_date", "isin", price.alias("price"), duration.alias("duration")), "price", "duration")


def roll_down(spark: SparkSession, d: str) -> DataFrame:
    c = market.roll_down(_res(spark, d), table(spark, d, "bonds"))
    return r4(c.select("obs_date", "isin", "duration", "roll_bp"), "duration", "roll_bp")


def _forecasts(res: DataFrame, trades: DataFrame) -> DataFrame:
    return market.forecast(res, trades, checkpointed(market.accuracy(market.backtest(res, trades))))


def carry_profile(spark: SparkSession, d: str) -> DataFrame:
    """Carry entered where trades are expected to print: the quote plus the day's entry gap."""
    res, trades = _once(spark, d), _trades_once(spark, d)
    days = _days(spark, d, res)
    entry = market.entry_gaps(_forecasts(res, trades), market.execution_gap(market.gaps(res, trades), days))
    rates = checkpointed(market.funding(curve.valid_trades(spark, d), days))  # like entry, a row per day
    c = market.carry(res, table(spark, d, "bonds"), rates, checkpointed(entry))
    return r4(r4(c, "price", "duration", "roll_bp", "total_bp", "per_duration_bp", digits=3), "entry_yield", "carry_bp", digits=9)


def execution_gap(spark: SparkSession, d: str) -> DataFrame:
    res = _once(spark, d)
    return r4(market.execution_gap(market.gaps(res, curve.usable_trades(spark, d)), _days(spark, d, res)), "gap_bp")


def execution_gap_by_tenor(spark: SparkSession, d: str) -> DataFrame:
    res = _once(spark, d)
    return r4(market.gap_by_tenor(market.gaps(res, curve.usable_trades(spark, d)), _days(spark, d, res)), "gap_bp")


def entry_gap(spark: SparkSession, d: str) -> DataFrame:
    res, trades = _once(spark, d), _trades_once(spark, d)
    e = market.entry_gaps(_forecasts(res, trades), market.execution_gap(market.gaps(res, trades), _days(spark, d, res)))
    return r4(e, "entry_gap_bp")


def dealing_forecast(spark: SparkSession, d: str) -> DataFrame:
    f = _forecasts(_once(spark, d), _trades_once(spark, d))
    return r4(f, "expected_yield", "adjustment_bp", "own_gap_bp", "market_gap_bp", "band50_bp", "band80_bp", "screen_band50_bp", digits=11)


def dealing_market_gap(spark: SparkSession, d: str) -> DataFrame:
    res = _once(spark, d)
    days = checkpointed(market.day_numbers(res))
    numbered = market.gaps(res, curve.usable_trades(spark, d)).join(days, "obs_date")
    return r4(market.market_gaps(numbered, days), "market_bp", "old_bp", digits=8)


def dealing_adjustments(spark: SparkSession, d: str) -> DataFrame:
    """The rule for each quoted bond and day: what `forecast` would add to the screen."""
    res = _once(spark, d)
    days = checkpointed(market.day_numbers(res))
    numbered = market.gaps(res, curve.usable_trades(spark, d)).join(days, "obs_date")
    asks = res.join(days, "obs_date").select("isin", "idx", "obs_date", "mid")
    a = market.adjusted(asks, numbered, market.market_gaps(numbered, days))
    out = a.select("obs_date", "isin", "own_age", "own_gap_bp", "adjustment_bp", (F.col("mid") + F.col("adjustment_bp") / 100).alias("expected_yield"))
    return r4(out, "own_gap_bp", "adjustment_bp", "expected_yield", digits=11)


def dealing_backtest(spark: SparkSession, d: str) -> DataFrame:
    return r4(market.backtest(_once(spark, d), _trades_once(spark, d)), "screen_error", "old_error", "market_error", "error", digits=8)


def dealing_accuracy(spark: SparkSession, d: str) -> DataFrame:
    a = market.accuracy(market.backtest(_once(spark, d), _trades_once(spark, d)))
    return r4(a, *[c for c in a.columns if c not in ("lag", "n")])


def _signals(spark: SparkSession, d: str) -> DataFrame:
    return relative_value.bond_signals(_res(spark, d))


def z_bucket_reversion(spark: SparkSession, d: str) -> DataFrame:
    return r4(validation.z_bucket_reversion(_signals(spark, d)), "fwd5", "fwd10", "fwd20")


def z_correlation(spark: SparkSession, d: str) -> DataFrame:
    return r4(validation.z_correlation(_signals(spark, d)), "corr", "capture_bp", "hit_rate")


def residual_dispersion(spark: SparkSession, d: str) -> DataFrame:
    return r4(validation.dispersion(_once(spark, d)), "across_bp", "own_bp", "ratio", "rho", "half_life")


def gap_by_month(spark: SparkSession, d: str) -> DataFrame:
    return r4(validation.gap_by_month(_gaps(spark, d)), "q25", "median", "q75")


def auction_cycle(spark: SparkSession, d: str) -> DataFrame:
    return r4(validation.auction_cycle(_signals(spark, d), market.valid_auctions(spark, d)), "mean_gap_bp")


def screen_lag(spark: SparkSession, d: str) -> DataFrame:
    res = _once(spark, d)
    return r4(validation.screen_lag(res, market.gaps(res, curve.usable_trades(spark, d))), "next_day_bp", "five_days_bp", "rose")


NAMES: Sequence[str] = (
    "curve_points", "curve_spread_z", "curve_spread_reversion", "curve_spread_asof", "spread_monthly_pivot", "liquidity_tiers", "funding_rate",
    "bond_price_duration", "roll_down", "carry_profile", "execution_gap", "execution_gap_by_tenor", "entry_gap", "dealing_forecast",
    "dealing_market_gap", "dealing_adjustments", "dealing_backtest",
    "dealing_accuracy", "z_bucket_reversion", "z_correlation", "residual_dispersion", "gap_by_month", "auction_cycle", "screen_lag",
)
QUERIES = {name: globals()[name] for name in NAMES}

M = BASE + MARKET
SQL = {
    "curve_points": f"{M} select obs_date, point, {rounded('curve_yield', 'point_yield', 'half_bp')} from pt",
    "curve_spread_z": f"{M} select obs_date, pair, {rounded('spread_bp', 'curve_only_bp', 'cost_bp', 'zscore', digits=3)} from cz",
    "curve_spread_reversion": f"{M} select pair, n, {rounded('reversion_bp')} from cr",
    "curve_spread_asof": f"""{M} select obs_date, pair, {rounded('spread_bp', 'low_bp', 'high_bp', 'change_20d_bp', digits=3)}, verdict from (
select cz.*, min(spread_bp) over u low_bp, max(spread_bp) over u high_bp, spread_bp - lag(spread_bp, 20) over (partition by pair order by obs_date) change_20d_bp,
case when reversion_bp is null then 'not measured yet' when cost_bp is null then 'cost unknown' when reversion_bp > cost_bp then 'clears costs' else 'below costs' end verdict
from cz left join cr using (pair) window u as (partition by pair order by obs_date rows unbounded preceding))""",
    "spread_monthly_pivot": f"""{M} select cast(date_trunc('month', obs_date) as date) as month, {', '.join(f"round(avg(spread_bp) filter (pair = '2s{k}s'), 3) + 0 as m2s{k}s" for k in (5, 8, 10, 12))} from cz group by 1""",
    "liquidity_tiers": f"{M} select asof_day as asof, isin, turnover_lkr, n_trades, days_traded, is_benchmark, days_since_auction, post_auction, {rounded('bid_to_cover', digits=8)}, days_since_trade, {rounded('last_trade_yield', digits=8)}, tier from liq",
    "funding_rate": f"{M} select asof_day as asof, {rounded('bill_pct')}, round(bill_pct + 0.05e0, 4) + 0 as rate_pct, stale_days, n_bills from fund",
    "bond_price_duration": f"{M} select obs_date, isin, {rounded('price', 'duration')} from pd",
    "roll_down": f"{M} select p.obs_date, p.isin, round(duration, 4) + 0 as duration, round({_ROLL}, 4) + 0 as roll_bp from pd p join fit using (obs_date)",
    "carry_profile": f"""{M} select obs_date, isin, {rounded('price', 'duration', 'roll_bp', digits=3)}, {rounded('entry_yield', 'carry_bp', digits=9)}, round(carry_bp + roll_bp, 3) + 0 as total_bp,
round(case when duration > 0 then (carry_bp + roll_bp) / duration else 0 end, 3) + 0 as per_duration_bp from car""",
    "execution_gap": f"{M} select d as asof, n, {rounded('gap_bp')} from eg",
    "execution_gap_by_tenor": f"""{M} select d as asof, case when tau < 2 then '0-2y' when tau < 4 then '2-4y' when tau < 7 then '4-7y' when tau < 10 then '7-10y' else '10y+' end bucket, round(median(gap_bp), 4) + 0 as gap_bp, count(*) n
from sd join gp on obs_date <= d and obs_date > d - 365 group by 1, 2""",
    "entry_gap": f"{M} select asof_day as asof, {rounded('entry_gap_bp')} from eb",
    "dealing_forecast": f"{M} select obs_date, isin, quote_yield, {rounded('expected_yield', 'adjustment_bp', 'own_gap_bp', digits=11)}, own_age_days, {rounded('market_gap_bp', digits=11)}, market_window, trades_through, fresh, {rounded('band50_bp', 'band80_bp', 'screen_band50_bp', digits=11)} from fc",
    "dealing_market_gap": f"{M} select idx, {rounded('market_bp', digits=8)}, market_rows, {rounded('old_bp', digits=8)} from mk",
    "dealing_adjustments": f"""{M}, asks as (select r.isin, r.obs_date, r.mid, di.idx from res r join di using (obs_date)),
ad as (select a.*, g.idx gi, g.gap_bp from asks a asof left join gx g on a.isin = g.isin and a.idx >= g.idx),
ae as (select ad.*, m.market_bp, ad.idx - gi own_age, m.market_bp + greatest(-40, least(40, gap_bp - m.market_bp)) own_gap_bp from ad join mk m on m.idx = ad.idx where m.market_bp is not null),
af as (select *, coalesce(0.5e0 ** (own_age / 2e0), 0) wt, case when gap_bp is null then null else own_gap_bp end own2 from ae)
select obs_date, isin, own_age, round(own2, 11) + 0 as own_gap_bp, round(wt * coalesce(own2, 0) + (1 - wt) * market_bp, 11) + 0 as adjustment_bp,
round(mid + (wt * coalesce(own2, 0) + (1 - wt) * market_bp) / 100, 11) + 0 as expected_yield from af""",
    "dealing_backtest": f"{M} select obs_date, isin, lag, {rounded('screen_error', 'old_error', 'market_error', 'error', digits=8)}, own_age from bk",
    "dealing_accuracy": f"""{M} select lag, count(*) n, {', '.join(f'round({e}, 4) + 0 as {n}' for n, e in (('mae_bp', 'avg(abs(error))'), ('band50_bp', 'quantile_cont(abs(error), 0.5)'), ('band80_bp', 'quantile_cont(abs(error), 0.8)'), ('bias_bp', 'avg(error)'), ('screen_mae_bp', 'avg(abs(screen_error))'), ('screen_band50_bp', 'quantile_cont(abs(screen_error), 0.5)'), ('old_mae_bp', 'avg(abs(old_error))'), ('market_mae_bp', 'avg(abs(market_error))')))}
from bk group by lag having count(*) >= 100""",
    "z_bucket_reversion": f"""{M}, zf as (select zscore, lead(residual_bp, 5) over w1 - residual_bp f5, lead(residual_bp, 10) over w1 - residual_bp f10, lead(residual_bp, 20) over w1 - residual_bp f20
from z where zscore is not null window w1 as (partition by isin order by obs_date))
select case when zscore <= -3 then 'z<-3' when zscore <= -2 then '-3..-2' when zscore <= -1 then '-2..-1' when zscore <= 1 then '-1..1' when zscore <= 2 then '1..2' when zscore <= 3 then '2..3' else 'z>3' end bucket,
round(avg(f5), 4) + 0 as fwd5, round(avg(f10), 4) + 0 as fwd10, round(avg(f20), 4) + 0 as fwd20, count(*) n from zf group by 1""",
    "z_correlation": f"""{M}, zf as (select zscore, unnest([5, 10, 20]) as horizon, unnest([lead(residual_bp, 5) over w1 - residual_bp, lead(residual_bp, 10) over w1 - residual_bp, lead(residual_bp, 20) over w1 - residual_bp]) fwd
from z where zscore is not null window w1 as (partition by isin order by obs_date))
select horizon, round(corr(zscore, fwd), 4) + 0 as corr, round(avg(-sign(zscore) * fwd) filter (abs(zscore) > 2), 4) + 0 as capture_bp,
round(avg(case when -sign(zscore) * fwd > 0 then 1e0 else 0e0 end) filter (abs(zscore) > 2), 4) + 0 as hit_rate, count(*) filter (abs(zscore) > 2) n from zf where fwd is not null group by 1""",
    "residual_dispersion": f"""{M}, ac as (select avg(sd) a from (select stddev_samp(residual_bp) sd from res group by obs_date)), ow as (select avg(sd) o from (select stddev_samp(residual_bp) sd from res group by isin)),
lg as (select isin, residual_bp x, lag(residual_bp) over (partition by isin order by obs_date) b from res),
ar as (select avg(rho) rho, count(rho) n_bonds from (select corr(b, x) rho from lg group by isin having count(*) > 40))
select round(a, 4) + 0 as across_bp, round(o, 4) + 0 as own_bp, round(a / o, 4) + 0 as ratio, round(rho, 4) + 0 as rho, round(case when rho > 0 and rho < 1 then ln(0.5e0) / ln(rho) end, 4) + 0 as half_life, n_bonds from ac, ow, ar""",
    "gap_by_month": f"""{M} select cast(date_trunc('month', obs_date) as date) as month, round(quantile_cont(gap_bp, 0.25), 4) + 0 as q25, round(quantile_cont(gap_bp, 0.5), 4) + 0 as median, round(quantile_cont(gap_bp, 0.75), 4) + 0 as q75, count(*) n from gp group by 1""",
    "auction_cycle": f"""{M}, ev as (select distinct isin, auction_date from av where kind = 'auction'),
of as (select z.obs_date - e.auction_date off_days, dislocation_bp from z join ev e using (isin) where zscore is not null)
select days_from_auction, round(avg(dislocation_bp), 4) + 0 as mean_gap_bp, count(*) n from of
join (values (-10, -6, '-10..-6'), (-5, -1, '-5..-1'), (0, 0, '0..0'), (1, 7, '1..7'), (8, 14, '8..14'), (15, 30, '15..30')) v(lo, hi, days_from_auction) on off_days between lo and hi group by 1""",
    "screen_lag": f"""{M}, dg as (select obs_date, median(gap_bp) g from gp group by 1 having count(*) >= 3),
rc as (select idx, (select median(g) from di x join dg using (obs_date) where x.idx between di.idx - 1 and di.idx) recent from di),
qx as (select isin, idx, mid from res join di using (obs_date)),
c1 as (select a.idx, avg(b.mid - a.mid) * 100 c from qx a join qx b on a.isin = b.isin and b.idx = a.idx + 1 group by 1),
c5 as (select a.idx, avg(b.mid - a.mid) * 100 c from qx a join qx b on a.isin = b.isin and b.idx = a.idx + 5 group by 1)
select case when recent >= 15 then '+15bp or more' when recent <= -15 then '-15bp or less' else 'within 15bp' end trade_gap,
round(avg(c1.c), 4) + 0 as next_day_bp, round(avg(c5.c), 4) + 0 as five_days_bp, round(avg(case when c5.c > 0 then 1e0 else 0e0 end), 4) + 0 as rose, count(*) n
from rc join c5 using (idx) left join c1 using (idx) where recent is not null group by 1""",
}

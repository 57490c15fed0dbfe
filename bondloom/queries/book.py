"""Queries of the as-of book and the stored statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.plans import book, curve, market, relative_value, shape, validation
from bondloom.queries.curve import r4
from bondloom.queries.sql import BASE, MARKET, rounded
from bondloom.session import broadcast_if_small, checkpointed, table


def facts(spark: SparkSession, d: str) -> book.Facts:
    """The parts of the book, each worked out and written once."""
    residual = checkpointed(curve.residuals(curve.usable_quotes(spark, d)))
    days = broadcast_if_small(checkpointed(market.scoring_days(residual)))
    profile = checkpointed(market.liquidity(curve.valid_trades(spark, d), market.valid_auctions(spark, d), days))
    quotes = curve.valid_quotes(spark, d).join(days.select(F.col("asof").alias("obs_date")), "obs_date")
    return book.Facts(residual, checkpointed(relative_value.bond_signals(residual)), checkpointed(quotes), profile, table(spark, d, "bonds"))


def book_core(spark: SparkSession, d: str) -> DataFrame:
    return r4(r4(book.core(facts(spark, d)), "residual_bp", "dislocation_bp", "zscore", "bar_pct"), "cost_bp", "bid_to_cover", digits=8)


def book_also_trading(spark: SparkSession, d: str) -> DataFrame:
    return r4(r4(book.also_trading(facts(spark, d)), "residual_bp", "dislocation_bp", "zscore", "bar_pct"), "cost_bp", digits=8)


def book_waiting(spark: SparkSession, d: str) -> DataFrame:
    return book.waiting(facts(spark, d))


def switches(spark: SparkSession, d: str, f: book.Facts, top: int = book.SWITCHES) -> DataFrame:
    bonds = checkpointed(relative_value.pair_bonds(f.residual, table(spark, d, "auctions")))
    legs = checkpointed(book.switch_legs(f))
    found = checkpointed(relative_value.switch_book(f.residual, bonds, legs, top))
    return book.switches(legs, found.where("obs_date is not null"), bonds, relative_value.captured(found.where("obs_date is null")))


def book_switches(spark: SparkSession, d: str) -> DataFrame:
    """Only what the core book's switches need: the parts are read once, so none but the residuals is written."""
    residual = checkpointed(curve.residuals(curve.usable_quotes(spark, d)).select("obs_date", "isin", "tau", "residual_bp"))
    days = broadcast_if_small(checkpointed(market.scoring_days(residual)))
    quotes = curve.valid_quotes(spark, d).join(days.select(F.col("asof").alias("obs_date")), "obs_date")
    core = market.core_bonds(curve.valid_trades(spark, d), market.valid_auctions(spark, d), days)
    f = book.Facts(residual, relative_value.bond_signals(residual), quotes, core, table(spark, d, "bonds"))
    return r4(r4(switches(spark, d, f), "gap_bp", "zscore", digits=3), "cost_bp", "capture_bp", digits=6)


def book_carried_trades(spark: SparkSession, d: str) -> DataFrame:
    return r4(book.carried_trades(facts(spark, d), curve.usable_trades(spark, d)), "tau")


def book_tiles(spark: SparkSession, d: str) -> DataFrame:
    f = facts(spark, d)
    fitted = checkpointed(curve.fits_of(f.residual))
    t = book.tiles(f, fitted, checkpointed(curve.trade_check(curve.usable_trades(spark, d), fitted)), curve.valid_trades(spark, d))
    return r4(t, "rmse_bp", "trade_bias_bp")


def signal_stats(spark: SparkSession, d: str) -> DataFrame:
    """(key, value, n) of every measured statistic that has enough events."""
    columns = ("obs_date", "isin", "tau", "mid", "spread_bp", "weight", "beta0", "beta1", "beta2", "residual_bp")
    residual = checkpointed(curve.residuals(curve.usable_quotes(spark, d)).select(*columns))
    trades = checkpointed(curve.usable_trades(spark, d))
    bonds = checkpointed(relative_value.pair_bonds(residual, table(spark, d, "auctions")))
    switch = relative_value.switch_reversion(residual, bonds).where("capture_bp is not null")
    switch = switch.select(F.concat(F.lit("switch_reversion_10d_z"), F.col("threshold").cast("int").cast("string")).alias("key"), F.col("capture_bp").alias("value"), "n")
    shapes = shape.reversion(shape.spread_signals(shape.spreads(shape.points(residual)))).where("reversion_bp is not null")
    shapes = shapes.select(F.concat(F.lit("curve_reversion_10d_"), F.col("pair")).alias("key"), F.col("reversion_bp").alias("value"), "n")
    figures = market.accuracy(market.backtest(residual, trades))
    names = ("mae_bp", "band50_bp", "band80_bp", "screen_mae_bp", "screen_band50_bp", "old_mae_bp")
    suffix = F.when(F.col("lag") == 1, "fresh").otherwise("lagged")
    each = F.explode(F.array(*[F.struct(F.concat(F.lit(f"dealing_{c}_"), suffix).alias("key"), F.col(c).alias("value")) for c in names])).alias("s")
    return r4(switch.unionByName(shapes).unionByName(figures.select(each, "n").select("s.key", "s.value", "n")), "value", digits=3)


def dealing_by_age(spark: SparkSession, d: str) -> DataFrame:
    res, trades = checkpointed(curve.residuals(curve.usable_quotes(spark, d))), checkpointed(curve.usable_trades(spark, d))
    return r4(validation.error_by_age(market.backtest(res, trades)), "mean_bp", "band50_bp", "band80_bp")


def switch_bucket_reversion(spark: SparkSession, d: str) -> DataFrame:
    f = checkpointed(curve.residuals(curve.usable_quotes(spark, d)).select("obs_date", "isin", "tau", "residual_bp"))
    bonds = checkpointed(relative_value.pair_bonds(f, table(spark, d, "auctions")))
    return r4(validation.switch_bucket_reversion(f, bonds), "fwd5", "fwd10", "fwd20")


def spread_chance_test(spark: SparkSession, d: str) -> DataFrame:
    return validation.chance_test(shape.spreads(shape.points(curve.residuals(curve.usable_quotes(spark, d)))))


QUERIES = {f.__name__: f for f in (book_core, book_also_trading, book_waiting, book_switches, book_carried_trades, book_tiles, signal_stats, dealing_by_age, switch_bucket_reversion, spread_chance_test)}

_BOOK = f"""{BASE}{MARKET},
sp as (select bq.obs_date, bq.isin, (r.b - r.o) * 100 cost_bp from bq join fit on fit.obs_date = bq.obs_date where r.b is not null and r.o is not null),
dl as (select sp.obs_date, sp.isin, cost_bp, tier = 'core' is_core, liq.* exclude (asof_day, isin) from sp join liq on asof_day = sp.obs_date and liq.isin = sp.isin where cost_bp <= 50 and tier in ('core', 'active')),
sc as (select dl.*, residual_bp, dislocation_bp, zscore, coalesce(series_label, z.isin) as label from z join dl using (obs_date, isin) join bonds using (isin) where zscore is not null),
szd as (select obs_date, isin_a, isin_b, spread_bp - m dislocation_bp, (spread_bp - m) / s zscore from sz1 where n_window >= 30 and s > 0.5e0),
fw as (select s.*, (select arg_min(x.spread_bp, x.obs_date) from sz x where x.isin_a = s.isin_a and x.isin_b = s.isin_b and x.obs_date - s.obs_date - (case isodow(s.obs_date) when 6 then 13 when 7 then 12 else 14 end) between 0 and 4) - spread_bp fwd from sz s),
cap as (select threshold, count(*) n, avg(-sign(zscore) * fwd) capture_bp from fw, (values (2.0e0), (3.0e0)) v(threshold) where fwd is not null and abs(zscore) >= threshold group by 1 having count(*) >= 30)"""
_BAR = "least(abs(dislocation_bp) / max(abs(dislocation_bp)) over (partition by obs_date), 1) * 50"
_AGE = "case when own_age is null or own_age > 5 then 'older or never' when own_age <= 0 then 'latest day' when own_age <= 2 then '1-2 days' else '3-5 days' end"
SQL = {
    "book_core": f"""{_BOOK} select obs_date, row_number() over (partition by obs_date order by zscore desc, isin) place, isin, label, {rounded('residual_bp', 'dislocation_bp', 'zscore')}, {rounded('cost_bp', 'bid_to_cover', digits=8)}, turnover_lkr, days_traded, days_since_auction, post_auction,
last_trade_yield, days_since_trade, round({_BAR}, 4) + 0 as bar_pct, case when dislocation_bp >= 0 then 'cheap' else 'rich' end side from sc where is_core""",
    "book_also_trading": f"""{_BOOK}, x as (select *, {_BAR} bar_pct, case when zscore >= 0 then 'cheap' else 'rich' end side from sc where not is_core)
select obs_date, side, row_number() over (partition by obs_date, side order by abs(zscore) desc, isin) place, isin, label, {rounded('residual_bp', 'dislocation_bp', 'zscore', 'bar_pct')}, {rounded('cost_bp', digits=8)}, turnover_lkr, days_traded from x qualify place <= 4""",
    "book_waiting": f"""{_BOOK}, x as (select asof_day obs_date, liq.* exclude (asof_day) from liq where tier in ('core', 'active') and (asof_day, isin) in (select (obs_date, isin) from bq where r.b is not null) and (asof_day, isin) not in (select (obs_date, isin) from z where zscore is not null))
select x.obs_date, row_number() over (partition by x.obs_date order by turnover_lkr desc, x.isin) place, x.isin, coalesce(any_value(series_label), x.isin) as label, turnover_lkr, days_traded, is_benchmark, count(res.isin) as days
from x left join bonds on bonds.isin = x.isin left join res on res.isin = x.isin and res.obs_date <= x.obs_date group by x.obs_date, x.isin, turnover_lkr, days_traded, is_benchmark""",
    "book_switches": f"""{_BOOK}, x as (select s.obs_date, isin_a, isin_b, a.label la, b.label lb, s.dislocation_bp, s.zscore, (a.cost_bp + b.cost_bp) / 2 cost_bp,
case when (select count(*) from cap) > 0 then coalesce((select arg_max(capture_bp, threshold) from cap where threshold <= abs(s.zscore)), 0) end capture_bp
from szd s join sc a on a.obs_date = s.obs_date and a.isin = isin_a and a.is_core join sc b on b.obs_date = s.obs_date and b.isin = isin_b and b.is_core)
select obs_date, row_number() over (partition by obs_date order by abs(zscore) desc, isin_a, isin_b) place, isin_a, isin_b, case when zscore >= 0 then la else lb end buy, case when zscore >= 0 then lb else la end sell, round(abs(dislocation_bp), 3) + 0 as gap_bp, {rounded('zscore', digits=3)}, {rounded('cost_bp', 'capture_bp', digits=6)},
case when capture_bp is null then 'not measured yet' when capture_bp > cost_bp then 'clears costs' when capture_bp <> 0 then 'below costs' else 'weak signal' end verdict from x qualify place <= 6""",
    "book_carried_trades": f"""{_BOOK} select r.obs_date, r.isin, round(tau, 4) + 0 as tau, last_trade_yield, r.obs_date - days_since_trade traded_on, days_since_trade days_ago from res r join liq on asof_day = r.obs_date and liq.isin = r.isin
where last_trade_yield is not null and days_since_trade between 1 and 10 and (r.obs_date, r.isin) not in (select (obs_date, isin) from t)""",
    "book_tiles": f"""{_BOOK}, la as (select f.obs_date, max(c.obs_date) checked_on from fit f left join chk c on c.obs_date <= f.obs_date group by 1),
lp as (select f.obs_date, max(t.obs_date) published_through from fit f left join tb t on t.obs_date <= f.obs_date group by 1),
n1 as (select obs_date, count(*) c from z where zscore is not null group by 1), n2 as (select obs_date, count(*) c, sum(turnover_lkr) filter (is_core) tu, count(*) filter (is_core) k from sc group by 1), n3 as (select obs_date, count(*) c from sp group by 1), n4 as (select obs_date, count(*) c from dl group by 1)
select f.obs_date, n_quotes, round(rmse_bp, 4) + 0 as rmse_bp, round(trade_bias_bp, 4) + 0 as trade_bias_bp, n_trades checked_trades, checked_on, cast(f.obs_date - checked_on as int) age_days, f.obs_date - checked_on > 3 stale, published_through, cast(f.obs_date - published_through as int) feed_lag_days,
case when f.obs_date = published_through then 'no trade on ' else 'not yet published for ' end || f.obs_date no_print, cast(coalesce(n2.tu, 0) as bigint) core_turnover_lkr, coalesce(n2.k, 0) n_core, coalesce(n1.c, 0) - coalesce(n2.c, 0) hidden_scored, coalesce(n3.c, 0) - coalesce(n4.c, 0) hidden_quoted
from fit f join la on la.obs_date = f.obs_date join lp on lp.obs_date = f.obs_date left join chk on chk.obs_date = checked_on left join n1 on n1.obs_date = f.obs_date left join n2 on n2.obs_date = f.obs_date left join n3 on n3.obs_date = f.obs_date left join n4 on n4.obs_date = f.obs_date""",
    "signal_stats": f"""{_BOOK}, ac as (select lag, count(*) n, avg(abs(error)) mae_bp, quantile_cont(abs(error), 0.5) band50_bp, quantile_cont(abs(error), 0.8) band80_bp, avg(abs(screen_error)) screen_mae_bp, quantile_cont(abs(screen_error), 0.5) screen_band50_bp, avg(abs(old_error)) old_mae_bp from bk group by lag having count(*) >= 100)
select 'switch_reversion_10d_z' || cast(threshold as int) as key, round(capture_bp, 3) + 0 as value, n from cap union all select 'curve_reversion_10d_' || pair, round(reversion_bp, 3) + 0, n from cr where reversion_bp is not null
{' '.join(f"union all select 'dealing_{c}_' || case lag when 1 then 'fresh' else 'lagged' end, round({c}, 3) + 0, n from ac" for c in ('mae_bp', 'band50_bp', 'band80_bp', 'screen_mae_bp', 'screen_band50_bp', 'old_mae_bp'))}""",
    "dealing_by_age": f"""{BASE}{MARKET} select {_AGE} age, round(avg(abs(error)), 4) + 0 as mean_bp, round(quantile_cont(abs(error), 0.5), 4) + 0 as band50_bp, round(quantile_cont(abs(error), 0.8), 4) + 0 as band80_bp, count(*) n from bk where lag = 1 group by 1""",
    "switch_bucket_reversion": f"""{BASE}, zf as (select zscore, lead(spread_bp, 5) over w1 - spread_bp f5, lead(spread_bp, 10) over w1 - spread_bp f10, lead(spread_bp, 20) over w1 - spread_bp f20 from sz window w1 as (partition by isin_a, isin_b order by obs_date))
select case when zscore <= -3 then 'z<-3' when zscore <= -2 then '-3..-2' when zscore <= -1 then '-2..-1' when zscore <= 1 then '-1..1' when zscore <= 2 then '1..2' when zscore <= 3 then '2..3' else 'z>3' end bucket,
round(avg(f5), 4) + 0 as fwd5, round(avg(f10), 4) + 0 as fwd10, round(avg(f20), 4) + 0 as fwd20, count(*) n from zf group by 1""",
}

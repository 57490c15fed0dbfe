"""Liquidity tiers, funding, carry, execution gaps and the dealing forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondloom.functions.codecs import isin_maturity
from bondloom.functions.curve import predict, price_and_duration
from bondloom.plans import curve
from bondloom.session import table

# Fixed values.
TRADE_DAYS, ACTIVE, BENCH_TRADES, BENCH_DAYS, POST_DAYS, LAG_CAP = 60, 10, 8, 120, 14, 7
FUNDING_BP, BILL_LEAST, BILL_MOST, BILL_WINDOW, BILL_LOOKBACK = 5.0, 240, 380, 5, 30
AGE_YEARS, AGED_LEAST = 0.25, 0.02
GAP_DAYS, GAP_LEAST, TENOR_DAYS = 20, 8, 365
MARKET_ROWS, MARKET_LEAST, HALF_LIFE, OWN_CAP, FIRST_TARGET, STAT_LEAST = (2, 5, 20), 5, 2.0, 40.0, 60, 100


def scoring_days(fitted: DataFrame) -> DataFrame:
    """Every fitted day."""
    return fitted.select(F.col("obs_date").alias("asof")).distinct()


def influenced(df: DataFrame, day: str, days: DataFrame, reach: int) -> DataFrame:
    """``df`` joined to the scoring days from ``day`` to ``reach`` days after it.

    An equi-join on the month: a row is exploded onto the months that it reaches.
    """
    months = F.sequence(F.trunc(day, "month"), F.trunc(F.date_add(day, reach), "month"), F.expr("interval 1 month"))
    far = df.withColumn("_m", F.explode(months)).join(days.withColumn("_m", F.trunc("asof", "month")), "_m")
    return far.where((F.col(day) <= F.col("asof")) & (F.date_diff("asof", day) <= reach)).drop("_m")


def valid_auctions(spark: SparkSession, d: str) -> DataFrame:
    values = ("offered_lkr", "bids_lkr", "accepted_lkr", "way_pct")
    best = table(spark, d, "auctions").groupBy("auction_date", "isin", "kind").agg(F.max_by(F.struct(*values), "auction_seq").alias("r"))
    return best.select("auction_date", "isin", "kind", "r.*")


def _last_before(facts: DataFrame, day: str, value: Column, days: DataFrame) -> DataFrame:
    """(isin, asof, day, value): the last fact of each bond up to each scoring day.

    A bond's facts and its scoring days from its first fact on are put in one order, and the
    last fact is carried along.
    """
    fact = F.struct(F.col(day).alias("d"), value.alias("v"))
    known = facts.groupBy("isin", F.col(day).alias("_d")).agg(F.max(fact).alias("_f"))
    # Rows of the result: bonds times days, found by an equi-join on the month.
    first = known.groupBy("isin").agg(F.min("_d").alias("_from"))
    last = days.agg(F.max("asof").alias("asof")).scalar()
    months = F.sequence(F.trunc("_from", "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    slots = first.where(F.col("_from") <= last).withColumn("_m", F.explode(months)).join(days.withColumn("_m", F.trunc("asof", "month")), "_m")
    slots = slots.where(F.col("asof") >= F.col("_from")).select("isin", F.col("asof").alias("_d"), "asof")
    rows = known.withColumn("_asks", F.lit(False)).unionByName(slots.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
    upto = Window.partitionBy("isin").orderBy("_d", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_f", F.last("_f", True).over(upto)).where("_asks")
    return rows.select("isin", "asof", F.col("_f.d").alias("day"), F.col("_f.v").alias("value"))


def traded(trades: DataFrame, days: DataFrame) -> DataFrame:
    """(asof, isin, turnover_lkr, n_trades, days_traded) of the trailing days as of each scoring day."""
    bonds = trades.where("security_type = 'TBond'")
    dates = bonds.select("obs_date").distinct()
    last = influenced(dates, "obs_date", days, LAG_CAP).groupBy("asof").agg(F.max("obs_date").alias("through"))
    anchors = days.join(last, "asof", "left").withColumn("through", F.coalesce("through", "asof"))
    seen = influenced(bonds, "obs_date", days, TRADE_DAYS + LAG_CAP).join(anchors, "asof")
    seen = seen.where((F.col("obs_date") <= F.col("through")) & (F.date_diff("through", "obs_date") < TRADE_DAYS))
    return seen.groupBy("asof", "isin").agg(F.coalesce(F.sum("volume_lkr"), F.lit(0)).alias("turnover_lkr"), F.coalesce(F.sum("n_trades"), F.lit(0)).alias("n_trades"), F.count(F.lit(1)).alias("days_traded"))


def auctioned(auctions: DataFrame, days: DataFrame) -> DataFrame:
    """(asof, isin, days_since_auction) of the bonds auctioned not long before each scoring day."""
    return influenced(auctions.select("isin", "auction_date"), "auction_date", days, BENCH_DAYS).groupBy("asof", "isin").agg(F.min(F.date_diff("asof", "auction_date")).alias("days_since_auction"))


def core_bonds(trades: DataFrame, auctions: DataFrame, days: DataFrame) -> DataFrame:
    """(asof, isin, tier): the core tier of ``liquidity`` alone, which needs no last prints."""
    often = traded(trades, days).where(F.col("days_traded") >= BENCH_TRADES).select("asof", "isin")
    return often.join(auctioned(auctions, days).select("asof", "isin"), ["asof", "isin"]).withColumn("tier", F.lit("core"))


def liquidity(trades: DataFrame, auctions: DataFrame, days: DataFrame) -> DataFrame:
    """Trading and auction facts of each bond as of each scoring day, and its tier."""
    bonds = trades.where("security_type = 'TBond'")
    flow, sold = traded(trades, days), auctioned(auctions, days)
    known = _last_before(bonds.where("wavg_yield is not null"), "obs_date", F.col("wavg_yield"), days)
    known = known.select("asof", "isin", F.date_diff("asof", "day").alias("days_since_trade"), F.col("value").alias("last_trade_yield"))
    cover = _last_before(auctions.where("kind = 'auction' and bids_lkr is not null and offered_lkr > 0"), "auction_date", F.col("bids_lkr") / F.col("offered_lkr"), days)
    df = flow.join(sold, ["asof", "isin"], "full").join(known, ["asof", "isin"], "full")
    df = df.join(cover.select("asof", "isin", F.col("value").alias("bid_to_cover")), ["asof", "isin"], "left")
    df = df.fillna(0, ["turnover_lkr", "n_trades", "days_traded"])
    bench = F.col("days_since_auction").isNotNull()
    tier = F.when(bench & (F.col("days_traded") >= BENCH_TRADES), "core").when(F.col("days_traded") >= ACTIVE, "active").otherwise("wider")
    return df.select("asof", "isin", "turnover_lkr", "n_trades", "days_traded", bench.alias("is_benchmark"), "days_since_auction", F.coalesce(F.col("days_since_auction") <= POST_DAYS, F.lit(False)).alias("post_auction"), "bid_to_cover", "days_since_trade", "last_trade_yield", tier.alias("tier"))


def funding(trades: DataFrame, days: DataFrame) -> DataFrame:
    """Volume-weighted one-year bill of the newest prints, plus the desk's spread."""
    left = F.date_diff(isin_maturity(F.col("isin")), "obs_date")
    bills = trades.where("security_type = 'Tbill' and wavg_yield is not null and volume_lkr > 0").where(left.between(BILL_LEAST, BILL_MOST))
    seen = influenced(bills, "obs_date", days, BILL_LOOKBACK - 1)
    newest = seen.groupBy("asof").agg(F.max("obs_date").alias("as_of"))
    taken = seen.join(newest, "asof").where(F.date_diff("as_of", "obs_date") < BILL_WINDOW)
    agg = taken.groupBy("asof").agg((F.sum(F.col("wavg_yield") * F.col("volume_lkr")) / F.sum("volume_lkr")).alias("bill_pct"), F.first("as_of").alias("bill_date"), F.count(F.lit(1)).alias("n_bills"))
    return agg.select("asof", "bill_pct", (F.col("bill_pct") + FUNDING_BP / 100).alias("rate_pct"), F.date_diff("asof", "bill_date").alias("stale_days"), "n_bills")


def roll_down(residual: DataFrame, bonds: DataFrame, gap_bp: Column | None = None) -> DataFrame:
    """Entry yield (mid plus ``gap_bp``), price, duration and roll of each quoted bond with a coupon."""
    df = residual.join(bonds.where("coupon_pct is not null").select("isin", "coupon_pct"), "isin")
    df = df.withColumn("entry_yield", F.col("mid") + (F.lit(0.0) if gap_bp is None else gap_bp) / 100)
    price, duration = price_and_duration(F.col("entry_yield"), F.col("coupon_pct"), F.col("tau"))
    df = df.withColumns({"price": price, "duration": duration})
    at = lambda tau: predict(tau, F.lit(curve.LAMBDA), F.col("beta0"), F.col("beta1"), F.col("beta2"))
    roll = F.col("duration") * (at(F.col("tau")) - at(F.greatest(F.col("tau") - AGE_YEARS, F.lit(AGED_LEAST)))) * 100 / AGE_YEARS
    return df.withColumn("roll_bp", roll)


def entry_gaps(forecasts: DataFrame, gap: DataFrame) -> DataFrame:
    """(asof, entry_gap_bp): the market's part of the day's forecast, else the trailing gap, else 0."""
    market = forecasts.groupBy("obs_date").agg(F.first("market_gap_bp").alias("_m")).withColumnRenamed("obs_date", "asof")
    both = gap.select("asof", F.col("gap_bp").alias("_g")).join(market, "asof", "full")
    return both.select("asof", F.coalesce("_m", "_g", F.lit(0.0)).alias("entry_gap_bp"))


def carry(residual: DataFrame, bonds: DataFrame, rates: DataFrame, entry: DataFrame | None = None) -> DataFrame:
    """Carry and roll of each quoted bond on the days that have a funding rate.

    ``entry`` (asof, entry_gap_bp) shifts the entry yield of a day's bonds; without it they
    are entered at the quote.
    """
    days = rates.select(F.col("asof").alias("obs_date"), "rate_pct")
    if entry is None:
        days = days.withColumn("entry_gap_bp", F.lit(0.0))
    else:
        days = days.join(entry.withColumnRenamed("asof", "obs_date"), "obs_date", "left").fillna(0.0, ["entry_gap_bp"])
    df = roll_down(residual.join(days, "obs_date"), bonds, F.col("entry_gap_bp"))
    df = df.withColumn("carry_bp", (F.col("entry_yield") - F.col("rate_pct")) * 100)
    df = df.withColumn("total_bp", F.col("carry_bp") + F.col("roll_bp"))
    return df.select("obs_date", "isin", "entry_yield", "price", "duration", "carry_bp", "roll_bp", "total_bp", F.when(F.col("duration") > 0, F.col("total_bp") / F.col("duration")).otherwise(0.0).alias("per_duration_bp"))


def day_numbers(residual: DataFrame) -> DataFrame:
    """(obs_date, idx): quote days numbered from 0; one row per day of the whole history."""
    return residual.select("obs_date").distinct().withColumn("idx", F.row_number().over(Window.partitionBy().orderBy("obs_date")) - 1)


def gaps(residual: DataFrame, trades: DataFrame) -> DataFrame:
    """Executed yield less quoted mid where a bond did both, in bp."""
    quotes = residual.select("obs_date", "isin", "tau", "mid")
    return quotes.join(trades.select("obs_date", "isin", "traded"), ["obs_date", "isin"]).select("obs_date", "isin", "tau", "traded", ((F.col("traded") - F.col("mid")) * 100).alias("gap_bp"))


def execution_gap(gap: DataFrame, days: DataFrame) -> DataFrame:
    """Median gap of the trailing calendar days; null under GAP_LEAST."""
    agg = influenced(gap, "obs_date", days, GAP_DAYS - 1).groupBy("asof").agg(F.count(F.lit(1)).alias("n"), F.percentile("gap_bp", F.lit(0.5)).alias("_g"))
    return agg.select("asof", "n", F.when(F.col("n") >= GAP_LEAST, F.col("_g")).alias("gap_bp"))


def gap_by_tenor(gap: DataFrame, days: DataFrame) -> DataFrame:
    """Median gap of the trailing year by tenor, as of each scoring day."""
    seen = influenced(gap.select("obs_date", "gap_bp", tenor_bucket(F.col("tau")).alias("bucket")), "obs_date", days, TENOR_DAYS - 1)
    return seen.groupBy("asof", "bucket").agg(F.percentile("gap_bp", F.lit(0.5)).alias("gap_bp"), F.count(F.lit(1)).alias("n"))


def tenor_bucket(tau: Column) -> Column:
    return F.when(tau < 2, "0-2y").when(tau < 4, "2-4y").when(tau < 7, "4-7y").when(tau < 10, "7-10y").otherwise("10y+")


def market_gaps(numbered: DataFrame, days: DataFrame) -> DataFrame:
    """(idx, market_bp, market_rows, old_bp): median gap of the rows up to each day, over
    the shortest of MARKET_ROWS with enough gaps. A gap is exploded onto the days it counts for."""
    spread = numbered.select("gap_bp", F.col("idx").alias("at"), F.explode(F.sequence(F.col("idx"), F.col("idx") + MARKET_ROWS[-1] - 1)).alias("idx"))
    spread = spread.join(days.select("idx"), "idx")
    inside = [F.when(F.col("idx") - F.col("at") < rows, F.col("gap_bp")) for rows in MARKET_ROWS]
    agg = spread.groupBy("idx").agg(*[f for rows, v in zip(MARKET_ROWS, inside) for f in (F.count(v).alias(f"n{rows}"), F.percentile(v, F.lit(0.5)).alias(f"g{rows}"))])
    value, used = F.lit(None).cast("double"), F.lit(None).cast("int")
    for rows in reversed(MARKET_ROWS):
        enough = F.col(f"n{rows}") >= MARKET_LEAST
        value, used = F.when(enough, F.col(f"g{rows}")).otherwise(value), F.when(enough, F.lit(rows)).otherwise(used)
    return agg.select("idx", value.alias("market_bp"), used.alias("market_rows"), F.col(f"g{MARKET_ROWS[-1]}").alias("old_bp"))


def adjusted(asks: DataFrame, numbered: DataFrame, market: DataFrame) -> DataFrame:
    """``asks`` (isin, idx, ...) with the dealing adjustment known at row idx.

    The bond's own last gap is carried along its rows, then shrunk to the market's by age.
    """
    events = numbered.select("isin", "idx", F.struct(F.col("idx").alias("i"), F.col("gap_bp").alias("g")).alias("own"))
    extra = [c for c in asks.columns if c not in ("isin", "idx")]
    rows = asks.withColumn("own", F.lit(None).cast(events.schema["own"].dataType)).withColumn("ask", F.lit(True))
    rows = rows.unionByName(events.withColumn("ask", F.lit(False)), allowMissingColumns=True)
    upto = Window.partitionBy("isin").orderBy("idx", "ask").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("own", F.last("own", True).over(upto)).where("ask")
    rows = rows.join(market, "idx").where("market_bp is not null")
    age = F.col("idx") - F.col("own.i")
    # least and greatest pass over nulls, so a bond that never traded is set apart.
    off = F.greatest(F.lit(-OWN_CAP), F.least(F.lit(OWN_CAP), F.col("own.g") - F.col("market_bp")))
    own = F.when(F.col("own").isNotNull(), F.col("market_bp") + off)
    weight = F.coalesce(F.pow(F.lit(0.5), age / HALF_LIFE), F.lit(0.0))
    blend = weight * F.coalesce(own, F.lit(0.0)) + (1 - weight) * F.col("market_bp")
    return rows.select("isin", "idx", *extra, age.alias("own_age"), own.alias("own_gap_bp"), "market_bp", "market_rows", "old_bp", blend.alias("adjustment_bp"))


def forecast(residual: DataFrame, trades: DataFrame, figures: DataFrame) -> DataFrame:
    """Where each quoted bond should deal on the next day, for every quoted day.

    The rule is read at the last row that holds any gap, which may lie before the day; then
    the forecast is not fresh and takes the error bands of ``accuracy`` of the longer lag.
    Days without a market gap have no forecast.
    """
    days = day_numbers(residual)
    numbered = gaps(residual, trades).join(days, "obs_date")
    market = market_gaps(numbered, days)
    traded = numbered.select("idx", F.col("obs_date").alias("through")).distinct().withColumn("at", F.col("idx"))
    upto = Window.partitionBy().orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)  # a row per day
    last = days.join(traded, "idx", "left")
    last = last.withColumns({"at": F.last("at", True).over(upto), "through": F.last("through", True).over(upto)}).where("at is not null")
    asks = residual.select("obs_date", "isin", "mid").join(last.select("obs_date", F.col("at").alias("idx"), "through"), "obs_date")
    made = adjusted(asks, numbered, market)
    fresh = F.col("through") == F.col("obs_date")
    bands = figures.select(F.col("lag").alias("_lag"), "band50_bp", "band80_bp", "screen_band50_bp")
    made = made.withColumn("_lag", F.when(fresh, 1).otherwise(2)).join(F.broadcast(bands), "_lag", "left")  # two rows
    return made.select(
        "obs_date", "isin", F.col("mid").alias("quote_yield"), (F.col("mid") + F.col("adjustment_bp") / 100).alias("expected_yield"), "adjustment_bp", "own_gap_bp", F.col("own_age").alias("own_age_days"),
        F.col("market_bp").alias("market_gap_bp"), F.col("market_rows").alias("market_window"), F.col("through").alias("trades_through"), fresh.alias("fresh"), "band50_bp", "band80_bp", "screen_band50_bp",
    )


def backtest(residual: DataFrame, trades: DataFrame) -> DataFrame:
    """Every forecast the rule would have made against the trade that followed."""
    days = day_numbers(residual)
    numbered = gaps(residual, trades).join(days, "obs_date")
    market = market_gaps(numbered, days)
    traded = trades.join(days, "obs_date").where(F.col("idx") >= FIRST_TARGET).select("isin", "obs_date", F.col("idx").alias("target"), "traded")
    quoted = residual.join(days, "obs_date").select("isin", (F.col("idx") + 1).alias("target"), "mid")
    scored = traded.join(quoted, ["isin", "target"]).select("isin", "obs_date", "target", ((F.col("traded") - F.col("mid")) * 100).alias("missed"), F.explode(F.array(F.lit(1), F.lit(2))).alias("lag"))
    df = adjusted(scored.withColumn("idx", F.col("target") - F.col("lag")), numbered, market)
    return df.select("obs_date", "isin", "lag", F.col("missed").alias("screen_error"), (F.col("missed") - F.coalesce("old_bp", F.lit(0.0))).alias("old_error"), (F.col("missed") - F.col("market_bp")).alias("market_error"), (F.col("missed") - F.col("adjustment_bp")).alias("error"), "own_age")


def accuracy(scored: DataFrame) -> DataFrame:
    """Error figures per lag; null under STAT_LEAST."""
    size = F.abs("error")
    agg = scored.groupBy("lag").agg(
        F.count(F.lit(1)).alias("n"), F.avg(size).alias("mae_bp"), F.percentile(size, F.lit(0.5)).alias("band50_bp"), F.percentile(size, F.lit(0.8)).alias("band80_bp"),
        F.avg("error").alias("bias_bp"), F.avg(F.abs("screen_error")).alias("screen_mae_bp"), F.percentile(F.abs("screen_error"), F.lit(0.5)).alias("screen_band50_bp"), F.avg(F.abs("old_error")).alias("old_mae_bp"), F.avg(F.abs("market_error")).alias("market_mae_bp"),
    )
    return agg.where(F.col("n") >= STAT_LEAST)

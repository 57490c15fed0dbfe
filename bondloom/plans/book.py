"""The book as of each day: what is scored and can be dealt in, and what it would cost.

Every frame holds all scoring days; a report of one day is a filter on ``obs_date``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.plans import curve, relative_value

# Fixed values.
MOST_SPREAD, MOST_CARRIED, ENDS, SWITCHES = 50.0, 10, 4, 6
TRADEABLE = ("core", "active")


@dataclass(frozen=True)
class Facts:
    """What the book is made of: residuals with mids, scores, last quotes, liquidity, labels."""

    residual: DataFrame
    signals: DataFrame
    quotes: DataFrame
    liquidity: DataFrame
    bonds: DataFrame


def spreads(quotes: DataFrame) -> DataFrame:
    """(obs_date, isin, cost_bp): bid less offer of two-way quotes, in bp; negative if inverted."""
    return quotes.where("bid is not null and offer is not null").select("obs_date", "isin", ((F.col("bid") - F.col("offer")) * 100).alias("cost_bp"))


def profiles(facts: Facts) -> DataFrame:
    return facts.liquidity.withColumnRenamed("asof", "obs_date")


def dealable(facts: Facts) -> DataFrame:
    """(obs_date, isin, cost_bp, is_core, ...): bonds in a tier that trades whose quote is at
    most MOST_SPREAD wide."""
    near = spreads(facts.quotes).where(F.col("cost_bp") <= MOST_SPREAD)
    return near.join(profiles(facts).where(F.col("tier").isin(*TRADEABLE)), ["obs_date", "isin"]).withColumn("is_core", F.col("tier") == "core")


def scored(facts: Facts) -> DataFrame:
    """Scored bonds one can deal in, with their label."""
    z = facts.signals.where("zscore is not null").select("obs_date", "isin", "residual_bp", "dislocation_bp", "zscore")
    return z.join(dealable(facts), ["obs_date", "isin"]).join(facts.bonds.select("isin", "series_label"), "isin")


def _bar(over: list[str]) -> Column:
    """Half the width of a bar: the size of a dislocation against the widest, in percent."""
    widest = F.max(F.abs("dislocation_bp")).over(Window.partitionBy(*over))
    return F.least(F.abs("dislocation_bp") / F.when(widest > 0, widest).otherwise(1.0), F.lit(1.0)) * 50


def core(facts: Facts) -> DataFrame:
    """The core book in full, cheapest first. A day's core is a handful of bonds."""
    place = F.row_number().over(Window.partitionBy("obs_date").orderBy(F.desc("zscore"), "isin"))
    rows = scored(facts).where("is_core")
    side = F.when(F.col("dislocation_bp") >= 0, "cheap").otherwise("rich")
    return rows.select("obs_date", place.alias("place"), "isin", F.coalesce("series_label", "isin").alias("label"), "residual_bp", "dislocation_bp", "zscore", "cost_bp", "turnover_lkr", "days_traded", "days_since_auction", "post_auction", "bid_to_cover", "last_trade_yield", "days_since_trade", _bar(["obs_date"]).alias("bar_pct"), side.alias("side"))


def also_trading(facts: Facts, ends: int = ENDS) -> DataFrame:
    """The cheap and the rich end of the other bonds that trade, ``ends`` of each, split by the
    sign of the score so that no bond is in both; 0 is cheap."""
    rows = scored(facts).where("not is_core")
    cheap = F.col("zscore") >= 0
    rows = rows.withColumns({"bar_pct": _bar(["obs_date"]), "side": F.when(cheap, "cheap").otherwise("rich")})
    place = F.row_number().over(Window.partitionBy("obs_date", "side").orderBy(F.desc(F.abs("zscore")), "isin"))
    rows = rows.withColumn("place", place).where(F.col("place") <= ends)
    return rows.select("obs_date", "side", "place", "isin", F.coalesce("series_label", "isin").alias("label"), "residual_bp", "dislocation_bp", "zscore", "cost_bp", "turnover_lkr", "days_traded", "bar_pct")


def waiting(facts: Facts) -> DataFrame:
    """Bonds that trade and are bid for but have no score yet, most traded first, with the days
    of residuals they have so far."""
    bid = facts.quotes.where("bid is not null").select("obs_date", "isin")
    rows = profiles(facts).where(F.col("tier").isin(*TRADEABLE)).join(bid, ["obs_date", "isin"], "left_semi")
    rows = rows.join(facts.signals.where("zscore is not null").select("obs_date", "isin"), ["obs_date", "isin"], "left_anti")
    # A bond's residuals up to a day are carried to the days that ask.
    asks = rows.select("isin", "obs_date", F.lit(0).alias("one")).unionByName(facts.residual.select("isin", "obs_date", F.lit(1).alias("one")))
    upto = Window.partitionBy("isin").orderBy("obs_date").rangeBetween(Window.unboundedPreceding, 0)
    counted = asks.withColumn("days", F.sum("one").over(upto)).where("one = 0").select("isin", "obs_date", "days")
    rows = rows.join(counted, ["obs_date", "isin"]).join(facts.bonds.select("isin", "series_label"), "isin", "left")
    place = F.row_number().over(Window.partitionBy("obs_date").orderBy(F.desc("turnover_lkr"), "isin"))
    return rows.select("obs_date", place.alias("place"), "isin", F.coalesce("series_label", "isin").alias("label"), "turnover_lkr", "days_traded", "is_benchmark", "days")


def capture_steps(captures: DataFrame) -> DataFrame:
    """One row: the measured capture per threshold as an array of (threshold, value), highest first."""
    known = captures.where("capture_bp is not null")
    return known.agg(F.sort_array(F.collect_list(F.struct("threshold", F.col("capture_bp").alias("value"))), asc=False).alias("steps"))  # two thresholds


def expected_capture(zscore: Column, steps: Column) -> Column:
    """What a score of this size has given back: the value of the highest threshold it
    reaches, 0 under all of them, null if nothing was measured."""
    reached = F.get(F.filter(steps, lambda s: F.abs(zscore) >= s["threshold"]), F.lit(0))
    return F.when(F.size(steps) > 0, F.coalesce(reached["value"], F.lit(0.0)))


def switch_verdict(capture: Column, cost: Column) -> Column:
    return F.when(capture.isNull(), "not measured yet").when(capture > cost, "clears costs").when(capture != 0, "below costs").otherwise("weak signal")


def switch_legs(facts: Facts) -> DataFrame:
    """(obs_date, isin, cost, label): the core book, whose bonds are switched."""
    return scored(facts).where("is_core").select("obs_date", "isin", F.col("cost_bp").alias("cost"), F.coalesce("series_label", "isin").alias("label"))


def switches(legs: DataFrame, pairs: DataFrame, named_bonds: DataFrame, captures: DataFrame) -> DataFrame:
    """The widest switches of each day, both legs in the core book.

    ``pairs`` are the placed rows of ``relative_value.switch_book`` for these ``legs``. A trade
    costs half of each leg's spread; a leg without a two-way quote counts as nothing.
    """
    rows = relative_value.named(pairs.select("obs_date", "pair", "place", "dislocation_bp", "zscore"), named_bonds)
    for x in "ab":
        rows = rows.join(legs.select("obs_date", *[F.col(c).alias(f"{c}_{x}") for c in ("isin", "cost", "label")]), ["obs_date", f"isin_{x}"])
    cheap_a = F.col("zscore") >= 0
    cost = (F.coalesce("cost_a", F.lit(0.0)) + F.coalesce("cost_b", F.lit(0.0))) / 2
    rows = rows.withColumn("steps", capture_steps(captures).scalar())
    rows = rows.withColumns({"buy": F.when(cheap_a, F.col("label_a")).otherwise(F.col("label_b")), "sell": F.when(cheap_a, F.col("label_b")).otherwise(F.col("label_a")), "cost_bp": cost, "capture_bp": expected_capture(F.col("zscore"), F.col("steps"))})
    return rows.select("obs_date", "place", "isin_a", "isin_b", "buy", "sell", F.abs("dislocation_bp").alias("gap_bp"), "zscore", "cost_bp", "capture_bp", switch_verdict(F.col("capture_bp"), F.col("cost_bp")).alias("verdict"))


def carried_trades(facts: Facts, trades: DataFrame) -> DataFrame:
    """Last prints of the bonds quoted but not traded on a day, up to MOST_CARRIED days old. A
    print of the day itself is no carried one."""
    quoted = facts.residual.select("obs_date", "isin", "tau")
    quiet = quoted.join(trades.select("obs_date", "isin"), ["obs_date", "isin"], "left_anti")
    rows = quiet.join(profiles(facts), ["obs_date", "isin"]).where(F.col("last_trade_yield").isNotNull() & F.col("days_since_trade").between(1, MOST_CARRIED))
    return rows.select("obs_date", "isin", "tau", "last_trade_yield", F.date_sub("obs_date", F.col("days_since_trade")).alias("traded_on"), F.col("days_since_trade").alias("days_ago"))


def tiles(facts: Facts, fitted: DataFrame, check: DataFrame, all_trades: DataFrame) -> DataFrame:
    """A row per fitted day: the fit, its last trade check, the newest trade file, the core
    book's turnover, and how many bonds are hidden by either count: scored less shown, and
    quoted both ways less dealable."""
    per_day = lambda df, **aggs: df.groupBy("obs_date").agg(*[v.alias(k) for k, v in aggs.items()])
    n = F.count(F.lit(1))
    shown = scored(facts)
    out = fitted.select("obs_date", "n_quotes", "rmse_bp")
    last = curve.check_age(fitted, check)
    bias = check.select(F.col("obs_date").alias("checked_on"), F.col("n_trades").alias("checked_trades"), "trade_bias_bp")
    out = out.join(last.join(bias, "checked_on", "left"), "obs_date", "left")
    parts = [
        per_day(facts.signals.where("zscore is not null"), n_scored=n), per_day(shown, n_shown=n, core_turnover_lkr=F.sum(F.when(F.col("is_core"), F.col("turnover_lkr"))), n_core=F.count_if("is_core")),
        per_day(spreads(facts.quotes), n_quoted=n), per_day(dealable(facts), n_dealable=n),
    ]
    for part in parts:
        out = out.join(part, "obs_date", "left")
    out = out.fillna(0, ["n_scored", "n_shown", "core_turnover_lkr", "n_core", "n_quoted", "n_dealable"])
    # The newest trade file up to each day, however old: days of either kind in one order.
    files = all_trades.where("security_type = 'TBond'").select("obs_date").distinct().select(F.col("obs_date").alias("d"), F.col("obs_date").alias("f"))
    order = out.select(F.col("obs_date").alias("d")).join(files, "d", "full")
    upto = Window.partitionBy().orderBy("d").rowsBetween(Window.unboundedPreceding, 0)  # a row per day
    order = order.select(F.col("d").alias("obs_date"), F.last("f", True).over(upto).alias("published_through"))
    out = out.join(order, "obs_date", "left")
    lag = F.date_diff("obs_date", "published_through")
    reason = F.when(lag == 0, F.concat(F.lit("no trade on "), F.col("obs_date").cast("string"))).otherwise(F.concat(F.lit("not yet published for "), F.col("obs_date").cast("string")))
    return out.select(
        "obs_date", "n_quotes", "rmse_bp", "trade_bias_bp", "checked_trades", "checked_on", "age_days", "stale", "published_through", lag.alias("feed_lag_days"), reason.alias("no_print"),
        "core_turnover_lkr", "n_core", (F.col("n_scored") - F.col("n_shown")).alias("hidden_scored"), (F.col("n_quoted") - F.col("n_dealable")).alias("hidden_quoted"),
    )


def latest(df: DataFrame) -> DataFrame:
    """The rows of the newest day."""
    return df.where(F.col("obs_date") == df.agg(F.max("obs_date").alias("d")).scalar())

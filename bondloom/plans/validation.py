"""What the signals were worth: reversion, dispersion, auction cycle, screen lag."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bondloom.operators import switches
from bondloom.plans import market, relative_value, shape

# Fixed values.
HORIZONS, AR_ROWS = (5, 10, 20), 40
EDGES, LAST_BUCKET = ((-3, "z<-3"), (-2, "-3..-2"), (-1, "-2..-1"), (1, "-1..1"), (2, "1..2"), (3, "2..3")), "z>3"
CYCLE = ((-10, -6), (-5, -1), (0, 0), (1, 7), (8, 14), (15, 30))


def z_bucket(z):  # noqa: ANN001, ANN201
    out = None
    for edge, name in EDGES:
        out = F.when(z <= edge, name) if out is None else out.when(z <= edge, name)
    return out.otherwise(LAST_BUCKET)


def z_bucket_reversion(signals: DataFrame, key: str = "isin", value: str = "residual_bp") -> DataFrame:
    """Mean change by rows after a score, per bucket of the score."""
    rows = Window.partitionBy(key).orderBy("obs_date")
    df = signals.where("zscore is not null")
    for h in HORIZONS:
        df = df.withColumn(f"fwd{h}", F.lead(value, h).over(rows) - F.col(value))
    return df.groupBy(z_bucket(F.col("zscore")).alias("bucket")).agg(*[F.avg(f"fwd{h}").alias(f"fwd{h}") for h in HORIZONS], F.count(F.lit(1)).alias("n"))


def switch_bucket_reversion(residual: DataFrame, bonds: DataFrame) -> DataFrame:
    """``z_bucket_reversion`` of all switches: sums of each block of pairs, then their means."""
    edges, names = np.array([edge for edge, _ in EDGES], float), [*[name for _, name in EDGES], LAST_BUCKET]
    horizons = HORIZONS

    def take(blocks: Iterator[switches.Scored]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(names), "int64")
        moves, counts = np.zeros((len(horizons), len(names))), np.zeros((len(horizons), len(names)), "int64")
        for x in blocks:
            bucket = np.searchsorted(edges, x.z)
            n += np.bincount(bucket, minlength=len(names))
            for k, h in enumerate(horizons):
                same = x.at[h:] == x.at[:-h]
                of, move = bucket[:-h][same], (x.spread[h:] - x.spread[:-h])[same]
                moves[k] += np.bincount(of, move, len(names))
                counts[k] += np.bincount(of, minlength=len(names))
        made = {"bucket": names, "n": n, **{f"s{h}": moves[k] for k, h in enumerate(horizons)}, **{f"c{h}": counts[k] for k, h in enumerate(horizons)}}
        yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in made.items()})

    schema = ", ".join(["bucket string", "n long", *[f"s{h} double" for h in HORIZONS], *[f"c{h} long" for h in HORIZONS]])
    sums = switches.swept(residual, bonds, relative_value.RULE, take, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", *[f"{x}{h}" for x in "sc" for h in HORIZONS])])
    means = [F.when(F.col(f"c{h}") > 0, F.col(f"s{h}") / F.col(f"c{h}")).alias(f"fwd{h}") for h in HORIZONS]
    return sums.where("n > 0").select("bucket", *means, "n")


def z_correlation(signals: DataFrame) -> DataFrame:
    """Per horizon: correlation of score and change, capture and hit rate beyond 2."""
    rows = Window.partitionBy("isin").orderBy("obs_date")
    df = signals.where("zscore is not null")
    pairs = [F.struct(F.lit(h).alias("horizon"), (F.lead("residual_bp", h).over(rows) - F.col("residual_bp")).alias("fwd")) for h in HORIZONS]
    df = df.select("zscore", F.array(*pairs).alias("a")).select("zscore", F.inline("a")).where("fwd is not null")
    far, gain = F.abs("zscore") > 2, -F.signum("zscore") * F.col("fwd")
    return df.groupBy("horizon").agg(F.corr("zscore", "fwd").alias("corr"), F.avg(F.when(far, gain)).alias("capture_bp"), F.avg(F.when(far, (gain > 0).cast("double"))).alias("hit_rate"), F.count_if(far).alias("n"))


def dispersion(residual: DataFrame) -> DataFrame:
    """Spread across bonds, of a bond's own, their ratio, and the mean lag-1 correlation."""
    across = residual.groupBy("obs_date").agg(F.stddev_samp("residual_bp").alias("sd")).agg(F.avg("sd").alias("across_bp"))
    own = residual.groupBy("isin").agg(F.stddev_samp("residual_bp").alias("sd")).agg(F.avg("sd").alias("own_bp"))
    lagged = residual.withColumn("_b", F.lag("residual_bp").over(Window.partitionBy("isin").orderBy("obs_date")))
    per_bond = lagged.groupBy("isin").agg(F.count(F.lit(1)).alias("n"), F.corr("_b", "residual_bp").alias("rho"))
    ar = per_bond.where(F.col("n") > AR_ROWS).agg(F.avg("rho").alias("rho"), F.count("rho").alias("n_bonds"))
    one = across.withColumn("_", F.lit(1)).join(own.withColumn("_", F.lit(1)), "_").join(ar.withColumn("_", F.lit(1)), "_")
    half = F.when((F.col("rho") > 0) & (F.col("rho") < 1), F.log(F.lit(0.5)) / F.log("rho"))
    return one.select("across_bp", "own_bp", (F.col("across_bp") / F.col("own_bp")).alias("ratio"), "rho", half.alias("half_life"), "n_bonds")


def gap_by_month(gap: DataFrame) -> DataFrame:
    q = F.percentile("gap_bp", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    agg = gap.groupBy(F.trunc("obs_date", "month").alias("month")).agg(q.alias("q"), F.count(F.lit(1)).alias("n"))
    return agg.select("month", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(("q25", "median", "q75"))], "n")


def auction_cycle(signals: DataFrame, auctions: DataFrame) -> DataFrame:
    """Mean dislocation by days from a bond's auctions. An auction is exploded onto the
    days around it, so the join is on bond and day."""
    events = auctions.where("kind = 'auction'").select("isin", "auction_date").distinct()
    around = events.select("isin", F.explode(F.sequence(F.lit(CYCLE[0][0]), F.lit(CYCLE[-1][1]))).alias("offset"), "auction_date").withColumn("obs_date", F.date_add("auction_date", F.col("offset")))
    df = signals.where("zscore is not null").join(around, ["isin", "obs_date"])
    label = F.coalesce(*[F.when(F.col("offset").between(a, b), f"{a}..{b}") for a, b in CYCLE])
    return df.groupBy(label.alias("days_from_auction")).agg(F.avg("dislocation_bp").alias("mean_gap_bp"), F.count(F.lit(1)).alias("n"))


def screen_lag(residual: DataFrame, gap: DataFrame) -> DataFrame:
    """Mean change of quotes over the next rows, by the trade gap of the last two rows."""
    days = market.day_numbers(residual)
    daily = gap.groupBy("obs_date").agg(F.count(F.lit(1)).alias("n"), F.percentile("gap_bp", F.lit(0.5)).alias("g")).where("n >= 3").select("obs_date", "g")
    two = Window.partitionBy().orderBy("idx").rowsBetween(-1, 0)  # a row per day
    recent = days.join(daily, "obs_date", "left").withColumn("recent", F.percentile("g", F.lit(0.5)).over(two)).select("idx", "recent")
    quotes = residual.join(days, "obs_date").select("isin", "idx", "mid")
    moved = None
    for h in (1, 5):
        later = quotes.select("isin", (F.col("idx") - h).alias("idx"), F.col("mid").alias("_l"))
        change = quotes.join(later, ["isin", "idx"]).groupBy("idx").agg((F.avg(F.col("_l") - F.col("mid")) * 100).alias(f"change{h}"))
        moved = change if moved is None else moved.join(change, "idx", "full")
    df = recent.join(moved, "idx").where("recent is not null and change5 is not null")
    label = F.when(F.col("recent") >= 15, "+15bp or more").when(F.col("recent") <= -15, "-15bp or less").otherwise("within 15bp")
    return df.groupBy(label.alias("trade_gap")).agg(F.avg("change1").alias("next_day_bp"), F.avg("change5").alias("five_days_bp"), F.avg((F.col("change5") > 0).cast("double")).alias("rose"), F.count(F.lit(1)).alias("n"))


def error_by_age(scored: DataFrame) -> DataFrame:
    """Forecast errors with the day's trades at hand, by the age of the bond's own last gap in rows."""
    age = F.col("own_age")
    name = F.when(age.isNull() | (age > 5), "older or never").when(age <= 0, "latest day").when(age <= 2, "1-2 days").otherwise("3-5 days")
    size = F.abs("error")
    return scored.where("lag = 1").groupBy(name.alias("age")).agg(F.avg(size).alias("mean_bp"), F.percentile(size, F.lit(0.5)).alias("band50_bp"), F.percentile(size, F.lit(0.8)).alias("band80_bp"), F.count(F.lit(1)).alias("n"))


#: Random walks that each spread is set against, and events that a figure needs.
RUNS, LEAST_SCORED = 500, 10


def _came_back(series: np.ndarray, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """(correlation of score and next move, mean gain of fading stretched scores) of each row of
    ``series``; the move starts the day after. NaN where too little is scored."""
    n = series.shape[1]
    first = np.zeros((len(series), 1))
    sums, squares = (np.hstack([first, np.cumsum(x, axis=1)]) for x in (series, series**2))
    at = np.arange(n)
    since = np.maximum(at - relative_value.ROWS, 0)
    count = at - since
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = (sums[:, at] - sums[:, since]) / count
        sd = np.sqrt(np.maximum((squares[:, at] - squares[:, since] - count * mean**2) / (count - 1), 0))
        z = np.where((count >= relative_value.LEAST_ROWS) & (sd > relative_value.LEAST_SD), (series - mean) / sd, np.nan)
    move = np.full_like(series, np.nan)
    if n > horizon + 1:
        move[:, : n - horizon - 1] = series[:, horizon + 1 :] - series[:, 1 : n - horizon]
    valid = ~np.isnan(z) & ~np.isnan(move)
    far = valid & (np.abs(np.nan_to_num(z)) >= shape.SIGNAL_Z)
    enough = (valid.sum(axis=1) >= LEAST_SCORED) & far.any(axis=1)
    x, y = np.where(valid, z, 0), np.where(valid, move, 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        k = valid.sum(axis=1)
        dx, dy = (np.where(valid, v - (v.sum(axis=1) / k)[:, None], 0) for v in (x, y))
        corr = (dx * dy).sum(axis=1) / np.sqrt((dx**2).sum(axis=1) * (dy**2).sum(axis=1))
        gain = np.where(far, -np.sign(x) * y, 0).sum(axis=1) / far.sum(axis=1)
    return np.where(enough, corr, np.nan), np.where(enough, gain, np.nan)


def chance_test(spreads: DataFrame, runs: int = RUNS, seed: int = 0) -> DataFrame:
    """(pair, horizon, n_days, corr, comes_back_bp, chance, cost_bp): whether stretched spreads come back by more
    than random walks of the same daily moves and persistence do; ``chance`` is the share of
    ``runs`` walks that come back at least as far.

    Pairs and horizons are tested side by side; a series is a number a day. The seed is the
    pair's and horizon's, so a lost task gives the same again.
    """

    def test(key: tuple, days: pd.DataFrame) -> pd.DataFrame:
        pair, horizon = key
        days = days.sort_values("obs_date")
        values = days["spread_bp"].dropna().to_numpy()
        moves = np.diff(values)
        corr, gain = (float(x[0]) for x in _came_back(values[None, :], horizon)) if len(values) else (np.nan, np.nan)
        chance = np.nan
        if len(moves) > 2 and not np.isnan(gain):
            lag = np.corrcoef(moves[1:], moves[:-1])[0, 1]
            shocks = np.random.default_rng([seed, horizon, zlib.crc32(pair.encode())]).normal(size=(runs, len(values)))
            steps = np.empty_like(shocks)
            steps[:, 0] = shocks[:, 0]
            for i in range(1, shocks.shape[1]):
                steps[:, i] = lag * steps[:, i - 1] + shocks[:, i]
            walks = np.cumsum(steps * moves.std(ddof=1) / steps.std(axis=1, keepdims=True), axis=1)
            chance = float((_came_back(walks, horizon)[1] >= gain).mean())
        cost = days["cost_bp"].median()
        return pd.DataFrame({"pair": [pair], "horizon": [horizon], "n_days": [len(values)], "corr": [corr], "comes_back_bp": [gain], "chance": [chance], "cost_bp": [cost]})

    each = spreads.select("pair", F.explode(F.array(*[F.lit(h) for h in HORIZONS])).alias("horizon"), "obs_date", "spread_bp", "cost_bp")
    return each.groupBy("pair", "horizon").applyInPandas(test, "pair string, horizon int, n_days long, corr double, comes_back_bp double, chance double, cost_bp double")

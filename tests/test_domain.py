import datetime as dt
import random

import numpy as np
import pandas as pd
import math

import pytest
from pyspark.sql import functions as F

from bondloom.functions import codecs
from bondloom.functions.curve import loadings, predict, price_and_duration
from bondloom.plans import curve, market, relative_value, shape
from bondloom.session import checkpointed
from bondloom.sources import state
from bondloom.streaming.update import follow


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("body,digit", [("LKB00934F15", 4), ("LKA36427H27", 9), ("LKB00530C01", 7)])
def test_isin(spark, body, digit):
    assert one(spark, codecs.isin_check_digit(F.lit(body))) == digit
    assert one(spark, codecs.isin_maturity(F.lit(f"{body}{digit}"))) is not None
    assert one(spark, codecs.isin_maturity(F.lit(f"{body}{(digit + 1) % 10}"))) is None


def test_dates_labels_money(spark):
    assert one(spark, codecs.day_first(F.lit(" 28. 08 .2026 x"))) == dt.date(2026, 8, 28)
    assert one(spark, codecs.day_first(F.lit("01.13.2026"))) is None
    assert one(spark, codecs.spelled(F.lit("on 3rd March 2030"))) == dt.date(2030, 3, 3)
    assert one(spark, codecs.serial_day(F.lit("46262"))) == dt.date(2026, 8, 28)
    assert one(spark, codecs.canonical_label(F.lit("12.4%7.5%5%2029A"))) == "12.40%7.50%5.00%2029A"
    assert one(spark, codecs.steps(F.lit(None).cast("string"))) == []
    assert one(spark, codecs.rupees_from_millions(F.lit(232.825))) == 232_825_000
    assert one(spark, codecs.synthetic_key(F.lit("2034-06-15").cast("date"), F.lit(None).cast("double"))) is None


def test_loadings_and_par_price(spark):
    slope, hump = loadings(F.lit(0.0), F.lit(2.5))
    assert (one(spark, slope), one(spark, hump)) == (1.0, 0.0)
    price, duration = price_and_duration(F.lit(10.0), F.lit(10.0), F.lit(5.0))
    assert one(spark, price) == pytest.approx(100)
    assert one(spark, duration) == pytest.approx(3.8609, abs=1e-3)


def quotes(spark, betas=(12.0, -3.0, 1.0), lam=2.5):
    day, out = dt.date(2026, 8, 28), []
    for k, tau in enumerate((0.5, 1, 2, 3, 4, 6, 8, 10, 12)):
        x = tau / lam
        y = betas[0] + betas[1] * (1 - math.exp(-x)) / x + betas[2] * ((1 - math.exp(-x)) / x - math.exp(-x))
        out.append((day, f"b{k}", float(tau), y + 0.08, y - 0.08, y, 16.0))
    return spark.createDataFrame(out, "obs_date date, isin string, tau double, bid double, offer double, mid double, spread_bp double")


def test_curve_recovers_its_parameters(spark):
    row = curve.fits(quotes(spark)).first()
    assert (row["beta0"], row["beta1"], row["beta2"]) == pytest.approx((12, -3, 1), abs=1e-8)
    assert row["rmse_bp"] < 1e-5 and row["n_quotes"] == 9
    few = quotes(spark).where("tau < 3")
    assert curve.fits(few).count() == 0


def test_weights(spark):
    df = quotes(spark).limit(3).withColumn("spread_bp", F.when(F.col("isin") == "b0", 10.0).when(F.col("isin") == "b1", 20.0))
    w = {r["isin"]: r["weight"] for r in curve.weighed(df).collect()}
    assert w["b0"] / w["b1"] == pytest.approx(4) and sum(w.values()) / len(w) == pytest.approx(1)


def series(spark, values, isin="b"):
    return [(dt.date(2026, 1, 5) + dt.timedelta(k), isin, 3.0, float(v)) for k, v in enumerate(values)]


RES = "obs_date date, isin string, tau double, residual_bp double"


def test_score_leaves_its_own_day_out(spark):
    z = relative_value.bond_signals(spark.createDataFrame(series(spark, [9, 11] * 20 + [40]), RES)).orderBy(F.desc("obs_date")).first()
    assert z["mean_bp"] == 10 and z["dislocation_bp"] == 30 and z["zscore"] > 25
    flat = relative_value.bond_signals(spark.createDataFrame(series(spark, [10.0] * 40 + [10.2]), RES))
    assert flat.where("zscore is not null").count() == 0


def test_pairs_by_median_tenor(spark):
    data = [(dt.date(2026, 1, 5), n, t, 0.0) for n, t in (("a", 2.0), ("b", 3.5), ("c", 13.0))]
    residual = spark.createDataFrame(data, RES)
    pairs = lambda sold: {tuple(r)[:2] for r in relative_value.pairs(relative_value.pair_bonds(residual, spark.createDataFrame([(i,) for i in sold], "isin string"))).collect()}
    assert pairs([]) == {("a", "b")} and pairs(["c", "a", "x", None]) == {("a", "b"), ("a", "c")}


def test_switches_equal_their_definition(spark):
    """Spreads of pairs against pandas' own rolling figures, and the change by date."""
    rng = random.Random(2)
    day = lambda k: dt.date(2026, 1, 5) + dt.timedelta(k // 5 * 7 + k % 5 + (1 if k == 49 else 0))
    data = [(day(k), n, t, rng.gauss(0, 20)) for n, t in (("a", 2.0), ("b", 3.5), ("c", 30.0)) for k in range(100) if rng.random() < 0.9]
    residual = spark.createDataFrame(data, RES)
    bonds = checkpointed(relative_value.pair_bonds(residual, spark.createDataFrame([], "isin string")))
    signals = relative_value.switch_signals(residual, bonds)
    got = relative_value.named(signals.withColumn("fwd", relative_value.forward_by_date(["pair"], "spread_bp")), bonds).toPandas().set_index("obs_date").sort_index()
    wide = residual.toPandas().pivot(index="obs_date", columns="isin", values="residual_bp")
    spread = (wide.a - wide.b).dropna()
    past = spread.shift(1).rolling(60, min_periods=30)
    z = ((spread - past.mean()) / past.std()).dropna()
    assert (got.isin_a == "a").all() and (got.isin_b == "b").all() and list(got.index) == list(z.index)
    assert np.allclose(got.zscore, z) and np.allclose(got.spread_bp, spread[z.index])
    scored = spread[z.index]
    for when, value in scored.items():
        target = (pd.Timestamp(when) + pd.tseries.offsets.BDay(10)).date()
        later = next((scored[target + dt.timedelta(k)] for k in range(5) if target + dt.timedelta(k) in scored.index), None)
        assert (later is None and pd.isna(got.fwd[when])) or got.fwd[when] == pytest.approx(later - value)


def test_kinked_points(spark):
    data = [(dt.date(2026, 1, 5), t, r, 1.0, 10.0, 10.0, 0.0, 0.0) for t, r in ((1.9, 20.0), (2.1, 20.0), (4.9, -20.0), (5.1, -20.0))]
    df = spark.createDataFrame(data, "obs_date date, tau double, residual_bp double, weight double, spread_bp double, beta0 double, beta1 double, beta2 double")
    got = {r["pair"]: r["spread_bp"] for r in shape.spreads(shape.points(df)).collect()}
    assert got["2s5s"] == pytest.approx(-40, abs=1)


def test_dealing_rule(spark):
    market_row = spark.createDataFrame([(9, 10.0, 2, 10.0)], "idx int, market_bp double, market_rows int, old_bp double")
    events = spark.createDataFrame([("a", 5, 30.0), ("b", 9, -58.0)], "isin string, idx int, gap_bp double")
    asks = spark.createDataFrame([("a", 9), ("b", 9), ("never", 9)], "isin string, idx int")
    got = {r["isin"]: r["adjustment_bp"] for r in market.adjusted(asks, events, market_row).collect()}
    assert got == pytest.approx({"a": 15.0, "b": -30.0, "never": 10.0})


def test_benchmark_boundary(spark):
    day = dt.date(2026, 9, 1)
    trades = spark.createDataFrame([(day - dt.timedelta(k), "b", "TBond", 11.0, 10**9, 2) for k in range(1, 10)], "obs_date date, isin string, security_type string, wavg_yield double, volume_lkr long, n_trades int")
    days = spark.createDataFrame([(day,)], "asof date")
    for back, tier in ((119, "core"), (120, "core"), (121, "wider")):
        auctions = spark.createDataFrame([(day - dt.timedelta(back), "b", "auction", 5, 10)], "auction_date date, isin string, kind string, offered_lkr long, bids_lkr long")
        assert market.liquidity(trades, auctions, days).first()["tier"] == tier


def test_state_reductions(spark):
    rows = spark.createDataFrame([("k", 1, 5, None), ("k", 2, None, 7)], "k string, seq int, a int, b int")
    assert tuple(state.replace_rows(rows, ["k"], "seq", ["a", "b"]).first()) == ("k", None, 7)
    assert tuple(state.first_known(rows, ["k"], "seq", ["a", "b"]).first()) == ("k", 5, 7)
    new, old = spark.createDataFrame([("x", 1)], "key string, v int"), spark.createDataFrame([("x", 0), ("y", 2)], "key string, v int")
    assert {tuple(r) for r in state.keep_or_replace(new, old, "key").collect()} == {("x", 1), ("y", 2)}


def test_resolution_ladder(spark):
    bonds = spark.createDataFrame([("LKB1", "11.00%2033A", dt.date(2033, 1, 1), 11.0), ("LKB2", None, dt.date(2034, 1, 1), 9.0), ("LKB3", None, dt.date(2034, 1, 1), 8.0)], "isin string, series_label string, maturity_date date, coupon_pct double")
    quotes_ = spark.createDataFrame([(1, "11.00%2033A", None, None), (2, "11.00%2033", None, None), (3, None, dt.date(2034, 1, 1), 9.0), (4, None, dt.date(2034, 1, 1), None)], "line_key int, label string, maturity date, coupon double")
    got = {r["line_key"]: (r["isin"], r["method"]) for r in state.resolve_isin(quotes_, bonds).collect()}
    assert got == {1: ("LKB1", "label"), 2: ("LKB1", "label-no-letter"), 3: ("LKB2", "maturity+coupon"), 4: (None, "unresolved")}



def test_update_stream_takes_late_and_amended_rows(spark, tmp_path):
    schema = "obs_date date, isin string, seq long, v double"
    job = {"schema": schema, "keys": ["obs_date", "isin"], "order": "seq", "values": ["v"]}
    for part in ([(dt.date(2026, 1, 5), "a", 1, 1.0), (dt.date(2026, 2, 5), "a", 2, 2.0)], [(dt.date(2026, 1, 5), "a", 3, 9.0), (dt.date(2026, 1, 6), "b", 4, 4.0)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{tmp_path}/in")
        follow(spark, f"{tmp_path}/in", f"{tmp_path}/state", f"{tmp_path}/log", **job).awaitTermination()
    got = {(str(r["obs_date"]), r["isin"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/state").collect()}
    assert got == {("2026-01-05", "a", 9.0), ("2026-02-05", "a", 2.0), ("2026-01-06", "b", 4.0)}

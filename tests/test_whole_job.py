"""Queries do the whole job: nothing that the reference has is left out."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondloom.functions.codecs import isin_maturity
from bondloom.plans import curve
from bondloom.queries import curve as curve_queries
from bondloom.queries import market as market_queries

BONDS = "isin string, maturity_date date, series_label string, coupon_pct double"
OBSERVATIONS = "obs_seq long, obs_date date, isin string, source string, bid_yield double, offer_yield double, mid_yield double"
FIRST = dt.date(2026, 8, 3)
TERMS = (60, 120, 200, 330, 500, 800, 1300, 2000, 3000, 4200)


def held(spark, folder, days, lam, coupon=10.0, mids=None):
    """Writes bonds and their quotes of a curve of decay ``lam``; gives (tau, mid) by day."""
    bonds = [(f"b{k}", FIRST + dt.timedelta(t), "10%", coupon) for k, t in enumerate(TERMS)]
    rows, by_day = [], {}
    for n, day in enumerate(days):
        for k, (isin, ends, *_) in enumerate(bonds):
            tau = (ends - day).days / 365.25
            x = tau / lam
            f = (1 - math.exp(-x)) / x
            mid = 12 - 3 * f + 4 * (f - math.exp(-x)) + 0.002 * ((7 * k + 3 * n) % 5 - 2)
            mid = (mids or {}).get((n, k), mid)
            by_day.setdefault(day, []).append((tau, mid))
            rows.append((n * 100 + k, day, isin, "pdmo_daily", mid + 0.08, mid - 0.08, mid))
    spark.createDataFrame(bonds, BONDS).write.parquet(f"{folder}/bonds.parquet")
    spark.createDataFrame(rows, OBSERVATIONS).write.parquet(f"{folder}/observations.parquet")
    return by_day


def test_all_decays_are_tried(spark, tmp_path):
    by_day = held(spark, tmp_path, [FIRST, FIRST + dt.timedelta(1)], 0.6)
    totals = []
    for lam in curve.GRID:
        total = 0.0
        for pairs in by_day.values():
            tau, y = np.array(pairs).T
            slope = (1 - np.exp(-tau / lam)) / (tau / lam)
            x = np.column_stack([np.ones_like(tau), slope, slope - np.exp(-tau / lam)])
            total += float(np.sum((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2))
        totals.append(total)
    got = {r["lam"]: r for r in curve.decay_errors(curve.usable_quotes(spark, str(tmp_path))).collect()}
    assert sorted(got) == pytest.approx(curve.GRID) and all(r["n_days"] == 2 for r in got.values())
    assert [got[x]["rss"] for x in sorted(got)] == pytest.approx(totals, rel=1e-6)
    assert curve_queries.lambda_grid_rss(spark, str(tmp_path)).count() == 80
    chosen = curve_queries.lambda_calibrated(spark, str(tmp_path)).first()["lambda_years"]
    assert chosen == pytest.approx(min(x for x, t in zip(curve.GRID, totals) if t <= min(totals) * 1.02), abs=1e-4) and chosen < 1


def test_short_decays_keep_their_error_where_loadings_agree(spark):
    """All bonds are far beyond the decay: Cramer's rule drops the day or loses its error."""
    tau = np.array([4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 12.0])
    mid = 11 + 0.1 * np.sin(tau)
    rows = [(FIRST, f"b{k}", float(t), float(m), 16.0) for k, (t, m) in enumerate(zip(tau, mid))]
    df = spark.createDataFrame(rows, "obs_date date, isin string, tau double, mid double, spread_bp double")
    got = {r["lam"]: r["rss"] for r in curve.day_errors(df).collect()}
    assert len(got) == 80
    for lam, rss in got.items():
        slope = (1 - np.exp(-tau / lam)) / (tau / lam)
        x = np.column_stack([np.ones_like(tau), slope, slope - np.exp(-tau / lam)])
        assert rss == pytest.approx(float(np.sum((mid - x @ np.linalg.lstsq(x, mid, rcond=None)[0]) ** 2)), rel=1e-4)


def test_every_fitted_day_is_scored(spark, tmp_path):
    days = [FIRST + dt.timedelta(k) for k in (0, 1, 4, 30)]  # three of one month
    held(spark, tmp_path, days, 2.5)
    bill = next(x for k in range(10) if (x := f"LKA36427F04{k}") and spark.range(1).select(isin_maturity(F.lit(x)).alias("m")).first()["m"])
    rows = [(k, day, isin, kind, 12.0 + k, 100, 1) for k, (day, isin, kind) in enumerate([(days[0], bill, "Tbill"), (days[1], "b3", "TBond"), (days[1], bill, "Tbill"), (days[2], "b3", "TBond"), (days[2], "b4", "TBond")])]
    spark.createDataFrame(rows, "trade_seq long, obs_date date, isin string, security_type string, wavg_yield double, volume_lkr long, n_trades int").write.parquet(f"{tmp_path}/trade_summary.parquet")
    spark.createDataFrame([(0, days[1], "b3", "auction", 5, 10, 5, 12.0), (1, days[2], "b3", "auction", 5, 20, 5, 12.0)], "auction_seq long, auction_date date, isin string, kind string, offered_lkr long, bids_lkr long, accepted_lkr long, way_pct double").write.parquet(f"{tmp_path}/auctions.parquet")
    d = str(tmp_path)
    rates = {r["asof"]: r["bill_pct"] for r in market_queries.funding_rate(spark, d).collect()}
    assert rates == {days[0]: 12.0, days[1]: 13.0, days[2]: 13.0, days[3]: 14.0}  # the first print is 30 days old on the last day
    profile = {(r["obs_date"], r["isin"]) for r in market_queries.carry_profile(spark, d).collect()}
    assert len(profile) == 40 and {day for day, _ in profile} == set(days)
    assert {r["asof"]: r["n"] for r in market_queries.execution_gap(spark, d).collect()} == {days[1]: 1, days[2]: 3}
    tiers = {(r["asof"], r["isin"]): (r["n_trades"], r["days_since_trade"], r["last_trade_yield"], r["bid_to_cover"]) for r in market_queries.liquidity_tiers(spark, d).collect()}
    assert tiers == {
        (days[1], "b3"): (1, 0, 13.0, 2.0), (days[2], "b3"): (2, 0, 15.0, 4.0), (days[2], "b4"): (1, 0, 16.0, None),
        (days[3], "b3"): (2, 26, 15.0, 4.0), (days[3], "b4"): (1, 26, 16.0, None),
    }


def test_every_mid_is_priced(spark, tmp_path):
    held(spark, tmp_path, [FIRST], 2.5, mids={(0, 1): 0.5, (0, 2): 80.0, (0, 3): -200.0, (0, 4): -250.0})
    got = {r["isin"]: (r["price"], r["duration"]) for r in market_queries.bond_price_duration(spark, str(tmp_path)).collect()}
    assert len(got) == 10 and got["b3"] == got["b4"] == (None, None)
    for isin, days, mid in (("b1", 120, 0.5), ("b2", 200, 80.0)):
        tau = days / 365.25
        times = [t for t in (tau - 0.5, tau) if t > 0]
        flows = [(5 + 100 * (t == tau)) / (1 + mid / 200) ** (2 * t) for t in times]
        price = sum(flows)
        assert got[isin] == pytest.approx((price, sum(f * t for f, t in zip(flows, times)) / price / (1 + mid / 200)), abs=1e-4)

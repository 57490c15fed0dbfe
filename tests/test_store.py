"""Writers, refits, landing, and the surfaces over a small world of bonds."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bondloom import cli, surfaces
from bondloom.plans import book, curve, market, validation
from bondloom.sources import state, store
from bondloom.sources.landing import Fetcher, previewed
from bondloom.streaming.update import days_to_fit, refit

TRADES = "obs_date date, isin string, security_type string, wavg_yield double, volume_lkr long, n_trades int"
DAY = dt.date(2026, 9, 1)


def test_days_are_replaced_and_thin_days_stay(spark, tmp_path):
    path, staging = f"{tmp_path}/t", f"{tmp_path}/s"
    rows = lambda *r: spark.createDataFrame(list(r), "obs_date date, isin string, v int")
    store.replace_days(rows((dt.date(2026, 1, 5), "a", 1), (dt.date(2026, 1, 6), "a", 2), (dt.date(2026, 2, 2), "a", 3)), path, staging)
    store.replace_days(rows((dt.date(2026, 1, 5), "b", 9)), path, staging)
    store.replace_days(rows((dt.date(2026, 1, 5), "b", 9)), path, staging)
    assert {(str(r["obs_date"]), r["isin"], r["v"]) for r in spark.read.parquet(path).collect()} == {("2026-01-05", "b", 9), ("2026-01-06", "a", 2), ("2026-02-02", "a", 3)}


def test_a_failed_read_raises_and_loses_nothing(spark, tmp_path):
    path = tmp_path / "t"
    store.replace_days(spark.createDataFrame([(dt.date(2026, 1, 5), "a")], "obs_date date, isin string"), str(path), f"{tmp_path}/s")
    (path / "month=2026-01" / "broken.parquet").write_bytes(b"no parquet at all")
    before = sorted(p.name for p in path.rglob("*.parquet"))
    with pytest.raises(Exception):  # noqa: B017 - Spark's own kinds
        store.replace_days(spark.createDataFrame([(dt.date(2026, 1, 6), "b")], "obs_date date, isin string"), str(path), f"{tmp_path}/s")
    assert sorted(p.name for p in path.rglob("*.parquet")) == before


def test_stats_stay_until_measured_again(spark, tmp_path):
    path = f"{tmp_path}/stats"
    one = lambda *r: spark.createDataFrame(list(r), "key string, value double, n long")
    store.store_stats(one(("a", 1.0, 40), ("b", 2.0, 50)), path)
    store.store_stats(one(("a", 5.0, 60)), path)
    got = {r["key"]: (r["value"], r["n"], r["measured_at"] is not None) for r in spark.read.parquet(path).collect()}
    assert got == {"a": (5.0, 60, True), "b": (2.0, 50, True)}


def test_records_and_columns(spark):
    files = spark.createDataFrame([("u", 1)], "url string, seq int")
    assert store.file_changes(files, parse_status=F.lit("ok")).columns == ["url", "parse_status"]
    with pytest.raises(ValueError):
        store.file_changes(files, parse_state=F.lit("ok"))
    assert store.migrated(files, "url string, added double").columns == ["url", "added", "seq"]
    bonds = spark.createDataFrame([("x", 2, "10%2030A", "12%9%2027A", DAY), ("x", 1, None, None, DAY - dt.timedelta(9)), ("y", 1, "12%9%2027A", "12%9%2027A", None), (None, 1, None, None, None)], "isin string, ingest_seq int, series_label string, notes string, first_seen_date date")
    got = {r["isin"]: (r["series_label"], r["notes"], r["first_seen_date"]) for r in state.merge_bonds(bonds).collect()}
    assert got == {"x": ("10%2030A", None, DAY - dt.timedelta(9)), "y": ("12%9%2027A", "12%9%2027A", None)}
    auctions = spark.createDataFrame([(1, DAY, "x", "auction", 10.0, 5, "r"), (2, DAY, "x", "auction", 11.0, 6, "s"), (3, DAY, "x", "announced", 1.0, 1, "t")], "auction_seq long, auction_date date, isin string, kind string, way_pct double, accepted_lkr long, raw_ref string")
    assert [tuple(r) for r in state.auction_observations(auctions).collect()] == [(DAY, "x", "auction", 11.0, 6, True, "s")]


def world(days=40):
    """Quotes on a known curve and one trade 20 bp over it on every second day."""
    taus = (0.5, 1, 2, 3, 4, 5, 7, 9, 12)
    fitted = lambda tau, x: 12 - 3 * x + (x - math.exp(-tau / 2.5))
    quotes, trades = [], []
    for k in range(days):
        day = DAY - dt.timedelta(k)
        for i, tau in enumerate(taus):
            y = fitted(tau, (1 - math.exp(-tau / 2.5)) / (tau / 2.5))
            quotes.append((day, f"b{i}", float(tau), y + 0.05, y - 0.05, y, 10.0))
            if i == 3 and k % 2 == 0:
                trades.append((day, f"b{i}", float(tau), y + 0.2, 10**9, 2))
    return quotes, trades


QUOTES = "obs_date date, isin string, tau double, bid double, offer double, mid double, spread_bp double"
USED = "obs_date date, isin string, tau double, traded double, volume_lkr long, n_trades int"


def test_refit_takes_late_trades(spark, tmp_path):
    quotes, trades = (spark.createDataFrame(rows, schema) for rows, schema in zip(world(6), (QUOTES, USED)))
    first = trades.where(F.col("obs_date") < DAY)
    assert refit(spark, quotes, first, str(tmp_path)) == 6 and refit(spark, quotes, first, str(tmp_path)) == 0
    assert [r[0] for r in days_to_fit(quotes, trades, spark.read.parquet(f"{tmp_path}/curve_fits")).collect()] == [DAY]
    assert refit(spark, quotes, trades, str(tmp_path)) == 1
    fits = {r["obs_date"]: r for r in spark.read.parquet(f"{tmp_path}/curve_fits").collect()}
    assert len(fits) == 6 and fits[DAY]["n_trades"] == 1 and fits[DAY]["trade_bias_bp"] == pytest.approx(20) and fits[DAY - dt.timedelta(1)]["n_trades"] == 0
    lines = spark.read.parquet(f"{tmp_path}/curve_residuals").where(F.col("obs_date") == F.lit(DAY))
    assert {(r["source"], r["count"]) for r in lines.groupBy("source").count().collect()} == {("quote", 9), ("trade", 1)}
    # A day that became too thin keeps its fit.
    assert refit(spark, quotes.where("isin < 'b2'"), trades, str(tmp_path), only_new=False) == 0 and spark.read.parquet(f"{tmp_path}/curve_fits").count() == 6


def test_funding_is_the_weighted_bill_of_the_newest_prints(spark):
    bill = "LKA36427G024"  # matures 2027-07-02
    rows = [(DAY, bill, "Tbill", 10.0, 3 * 10**9, 1), (DAY - dt.timedelta(2), bill, "Tbill", 9.0, 10**9, 1), (DAY - dt.timedelta(9), bill, "Tbill", 1.0, 10**9, 1), (DAY, "LKA09126J015", "Tbill", 1.0, 10**9, 1), (DAY, bill, "TBond", 1.0, 10**9, 1)]
    days = spark.createDataFrame([(DAY + dt.timedelta(1),), (DAY + dt.timedelta(60),)], "asof date")
    got = market.funding(spark.createDataFrame(rows, TRADES), days).collect()
    assert [(r["bill_pct"], r["rate_pct"], r["stale_days"], r["n_bills"]) for r in got] == [(9.75, pytest.approx(9.8), 1, 2)]


def test_carry_enters_at_the_expected_gap(spark):
    residual = spark.createDataFrame([(DAY, "a", 5.0, 10.0, 10.0, 0.0, 0.0)], "obs_date date, isin string, tau double, mid double, beta0 double, beta1 double, beta2 double")
    bonds = spark.createDataFrame([("a", 10.0), ("n", None)], "isin string, coupon_pct double")
    rates = spark.createDataFrame([(DAY, 9.0)], "asof date, rate_pct double")
    plain = market.carry(residual, bonds, rates).first()
    assert plain["price"] == pytest.approx(100) and plain["carry_bp"] == pytest.approx(100) and plain["roll_bp"] == pytest.approx(0)
    moved = market.carry(residual, bonds, rates, spark.createDataFrame([(DAY, 20.0)], "asof date, entry_gap_bp double")).first()
    assert moved["entry_yield"] == pytest.approx(10.2) and moved["carry_bp"] == pytest.approx(120) and moved["price"] < 100
    gap = spark.createDataFrame([(DAY, 7.0), (DAY + dt.timedelta(1), 5.0), (DAY + dt.timedelta(2), None)], "asof date, gap_bp double")
    deals = spark.createDataFrame([(DAY, 3.0)], "obs_date date, market_gap_bp double")
    assert {r["asof"].day: r["entry_gap_bp"] for r in market.entry_gaps(deals, gap).collect()} == {1: 3.0, 2: 5.0, 3: 0.0}


def test_gap_needs_enough_trades(spark):
    days = spark.createDataFrame([(DAY,)], "asof date")
    rows = [(DAY - dt.timedelta(k), "a", 3.0, 10.0, 15.0) for k in range(12)] + [(DAY - dt.timedelta(20), "a", 3.0, 10.0, 99.0)]
    gap = spark.createDataFrame(rows, "obs_date date, isin string, tau double, traded double, gap_bp double")
    assert tuple(market.execution_gap(gap, days).first())[1:] == (12, 15.0)
    assert market.execution_gap(gap.limit(1), days).first()["gap_bp"] is None
    assert [(r["bucket"], r["n"]) for r in market.gap_by_tenor(gap, days).collect()] == [("2-4y", 13)]


def test_forecast_is_read_at_the_last_traded_row(spark):
    quotes, trades = (spark.createDataFrame(rows, schema) for rows, schema in zip(world(), (QUOTES, USED)))
    residual = curve.residuals(quotes)
    got = market.forecast(residual, trades.where(F.col("obs_date") < DAY), market.accuracy(market.backtest(residual, trades))).where(F.col("obs_date") == F.lit(DAY)).collect()
    assert len(got) == 9 and not any(r["fresh"] for r in got) and {r["trades_through"] for r in got} == {DAY - dt.timedelta(2)}
    own = next(r for r in got if r["isin"] == "b3")
    assert own["own_age_days"] == 0 and own["adjustment_bp"] == pytest.approx(20) and own["market_window"] == 20


def test_capture_steps_and_verdicts(spark):
    steps = lambda *r: book.capture_steps(spark.createDataFrame(list(r), "threshold double, n long, capture_bp double")).first()["steps"]
    rows = spark.createDataFrame([(0.5,), (-2.5,), (4.0,)], "z double")
    both = rows.withColumn("s", F.lit(None).cast("array<struct<threshold:double,value:double>>"))
    assert steps((2.0, 40, 6.9), (3.0, 30, 13.4), (4.0, 3, None)) == [(3.0, 13.4), (2.0, 6.9)] and steps() == []
    known = F.array(F.struct(F.lit(3.0).alias("threshold"), F.lit(13.4).alias("value")), F.struct(F.lit(2.0).alias("threshold"), F.lit(6.9).alias("value")))
    assert [r[0] for r in rows.select(book.expected_capture(F.col("z"), known)).collect()] == [0.0, 6.9, 13.4]
    assert [r[0] for r in both.select(book.expected_capture(F.col("z"), F.array().cast("array<struct<threshold:double,value:double>>"))).collect()] == [None] * 3
    verdicts = spark.createDataFrame([(None, 1.0), (2.0, 1.0), (1.0, 1.0), (0.0, 1.0), (0.0, -1.0)], "c double, k double").select(book.switch_verdict(F.col("c"), F.col("k")))
    assert [r[0] for r in verdicts.collect()] == ["not measured yet", "clears costs", "below costs", "weak signal", "clears costs"]


def test_chance_of_a_walk_and_of_a_tether(spark):
    rng = np.random.default_rng(3)
    walk, tether = np.cumsum(rng.normal(0, 5, 400)), np.zeros(400)
    for i in range(1, 400):
        tether[i] = 0.7 * tether[i - 1] + rng.normal(0, 5)
    rows = [(DAY + dt.timedelta(k), p, float(s[k]), 10.0) for p, s in (("walk", walk), ("tether", tether)) for k in range(400)] + [(DAY, "short", 1.0, None)]
    got = {(r["pair"], r["horizon"]): r for r in validation.chance_test(spark.createDataFrame(rows, "obs_date date, pair string, spread_bp double, cost_bp double"), runs=100).collect()}
    assert got["tether", 10]["chance"] < 0.1 and got["tether", 10]["comes_back_bp"] > 0 and got["walk", 10]["chance"] > 0.02 and got["short", 5]["chance"] is None
    series = pd.Series(walk)
    past = series.shift(1).rolling(60, min_periods=30)
    z, move = (series - past.mean()) / past.std(), series.shift(-11) - series.shift(-1)
    far = (z.abs() >= 1.5) & move.notna()
    assert got["walk", 10]["comes_back_bp"] == pytest.approx((-np.sign(z[far]) * move[far]).mean())


def test_landing_is_polite_and_whole(tmp_path):
    now, slept, answers = [0.0], [], [(503, b""), OSError("down"), (200, b"x sucuri_cloudproxy"), (200, b"content")]

    def opener(url):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    fetcher = Fetcher(opener, lambda: now[0], sleep)
    assert fetcher.land("u", tmp_path / "d" / "f") is not None and (tmp_path / "d" / "f").read_bytes() == b"content"
    assert fetcher.land("u", tmp_path / "d" / "f") is None and [s for s in slept if s >= 2] == [2, 4, 8]
    answers += [(307, b"")] * 4
    with pytest.raises(RuntimeError):
        fetcher.land("v", tmp_path / "g")
    assert [p.name for p in tmp_path.rglob("*") if p.is_file()] == ["f"]


def test_preview(spark, tmp_path):
    for name, head in (("a", b"PK\x03\x04"), ("b", b"%PDF-1"), ("c", b"<!DOCTYPE html>"), ("d", b"x")):
        (tmp_path / name).write_bytes(head)
    got = {r["path"][-1]: r["format"] for r in previewed(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {"a": "zipped workbook or archive", "b": "portable document", "c": "page", "d": "other"}


def test_ticks_and_charts():
    assert surfaces.ticks(0, 10, 5) == [0, 2, 4, 6, 8, 10] and surfaces.ticks(3, 3)[0] == 3 and len(surfaces.ticks(9.1, 13.2)) <= 8
    svg = surfaces.chart([("a<b", "line", [(0, 1), (1, None), (2, 3)]), ("x", "rings", [(1, 2)])], "x", "y")
    assert svg.count("<circle") == 1 and "a&lt;b" in svg and "no data" in surfaces.chart([], "x", "y")


def test_command_line_over_small_tables(spark, tmp_path, capsys):
    quotes, trades = world(3)
    data = tmp_path / "data"
    bonds = [(f"b{i}", 10.0, DAY + dt.timedelta(int(t * 365.25)), 5, f"10.00%20{30 + i}A") for i, t in enumerate((0.5, 1, 2, 3, 4, 5, 7, 9, 12))]
    spark.createDataFrame(bonds, "isin string, coupon_pct double, maturity_date date, tenor_years int, series_label string").write.parquet(f"{data}/bonds.parquet")
    spark.createDataFrame([(k, d, i, "pdmo_daily", b, o, m, None) for k, (d, i, _, b, o, m, _) in enumerate(quotes)], "obs_seq long, obs_date date, isin string, source string, bid_yield double, offer_yield double, mid_yield double, volume_lkr long").write.parquet(f"{data}/observations.parquet")
    spark.createDataFrame([(k, d, i, "TBond", y, v, n) for k, (d, i, _, y, v, n) in enumerate(trades)], "trade_seq long, obs_date date, isin string, security_type string, wavg_yield double, volume_lkr long, n_trades int").write.parquet(f"{data}/trade_summary.parquet")
    spark.createDataFrame([(1, DAY, "b3", "auction", 10.0, 10, 20, 10)], "auction_seq long, auction_date date, isin string, kind string, way_pct double, offered_lkr long, bids_lkr long, accepted_lkr long").write.parquet(f"{data}/auctions.parquet")
    frames = cli.frames(spark, str(data))
    day = surfaces.gather(frames)
    text, page = surfaces.report(day), surfaces.page(day)
    assert f"relative value, {DAY}" in text and "CORE BOOK: 0" in text and "bias +20" in text and "too few trades" in text
    assert page.startswith("<!doctype html>") and "<svg" in page and "src=" not in page and "http" not in page
    assert surfaces.page(day, fragment=True).startswith("<h1>") and surfaces.gather(frames, dt.date(1999, 1, 1)) is None
    assert cli.main(["history", "--data", str(data), "--isin", "b3", "--tail", "2", "--chart", f"{tmp_path}/h.svg"], spark) == 0
    assert capsys.readouterr().out.count("b3") == 2 and (tmp_path / "h.svg").read_text().startswith("<svg")
    assert cli.main(["update", "--data", f"{tmp_path}/state", "--landing", f"{tmp_path}/none"], spark) == 1

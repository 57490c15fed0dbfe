"""Scores of pairs by blocks: the same rows as pandas' own, and no pair rows on disk."""

import datetime as dt
import random
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bondloom.operators import switches
from bondloom.plans import relative_value, validation
from bondloom.queries import book as book_queries
from bondloom.session import checkpointed

BONDS, DAYS = 70, 100
RES = "obs_date date, isin string, tau double, residual_bp double"


def day(k):
    return dt.date(2026, 1, 5) + dt.timedelta(k // 5 * 7 + k % 5)


@pytest.fixture(scope="module")
def held(spark):
    """Residuals of auctioned bonds, enough for several groups, and the bonds."""
    rng = random.Random(5)
    data = [(day(k), f"b{n:02}", 1.0 + n % 30, rng.gauss(0, 20)) for n in range(BONDS) for k in range(DAYS) if rng.random() < 0.95 and k >= n % 7]
    residual = checkpointed(spark.createDataFrame(data, RES))
    sold = spark.createDataFrame([(f"b{n:02}",) for n in range(BONDS)], "isin string")
    return residual, checkpointed(relative_value.pair_bonds(residual, sold))


@pytest.fixture(scope="module")
def expected(held):
    """(isin_a, isin_b): a frame of scored rows by day."""
    wide = held[0].toPandas().pivot(index="obs_date", columns="isin", values="residual_bp")
    out = {}
    for i, a in enumerate(wide):
        for b in list(wide)[i + 1 :]:
            spread = (wide[a] - wide[b]).dropna()
            past = spread.shift(1).rolling(60, min_periods=30)
            z = (spread - past.mean()) / past.std()
            out[a, b] = pd.DataFrame({"spread": spread, "z": z})[z.notna()]
    return out


def shuffled(spark, work):
    """Bytes that ``work`` writes for exchanges."""
    spark.range(8).repartition(2).count()
    sc = spark.sparkContext._jsc.sc()

    def total():
        sc.listenerBus().waitUntilEmpty(30_000)
        found = sc.statusStore().executorList(False)
        return sum(found.apply(k).totalShuffleWrite() for k in range(found.size()))

    before = total()
    work()
    return total() - before


def test_captures_equal_their_definition_and_pair_rows_stay_in_memory(spark, held, expected):
    got = {}
    bytes_written = shuffled(spark, lambda: got.update({r["threshold"]: r for r in relative_value.switch_reversion(*held).collect()}))
    gains = {2.0: [], 3.0: []}
    for rows in expected.values():
        spread = rows["spread"].to_dict()
        for when, value, z in zip(rows.index, rows["spread"], rows["z"]):
            later = next((spread[x] for k in range(14, 19) if (x := when + dt.timedelta(k)) in spread), None)
            for threshold, of in gains.items():
                if later is not None and abs(z) >= threshold:
                    of.append(-np.sign(z) * (later - value))
    assert {t: got[t]["n"] for t in got} == {t: len(x) for t, x in gains.items()}
    assert all(got[t]["capture_bp"] == pytest.approx(np.mean(x)) for t, x in gains.items())
    pair_rows = BONDS * (BONDS - 1) / 2 * DAYS
    assert bytes_written < 5 * pair_rows  # a pair's number, day and spread take 20


def test_statistics_need_neither_the_book_nor_pair_rows(spark, monkeypatch):
    def unasked(*_):
        raise AssertionError

    monkeypatch.setattr(book_queries, "facts", unasked)
    monkeypatch.setattr(relative_value, "switch_signals", unasked)
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("observations", "trade_summary", "auctions", "bonds"):
        con.execute(f"create view {name} as select * from '{d}/{name}.parquet'")
    expected = {key: (value, n) for key, value, n in con.execute(book_queries.SQL["signal_stats"]).fetchall()}
    got = {r["key"]: (r["value"], r["n"]) for r in book_queries.signal_stats(spark, d).collect()}
    assert got == expected and got


def test_scores_equal_their_definition_and_pair_rows_stay_in_memory(spark, held, expected):
    got = []
    bytes_written = shuffled(spark, lambda: got.append(relative_value.named(relative_value.switch_signals(*held), held[1]).toPandas()))
    rows = got[0].set_index(["isin_a", "isin_b", "obs_date"]).sort_index()
    assert len(rows) == sum(len(x) for x in expected.values()) and rows.index.is_unique
    for pair, x in expected.items():
        mine = rows.loc[pair]
        assert list(mine.index) == list(x.index) and np.allclose(mine.zscore, x.z) and np.allclose(mine.spread_bp, x.spread)
    assert bytes_written < 5 * BONDS * (BONDS - 1) / 2 * DAYS


def test_a_faulty_spread_is_forgotten_after_its_window(spark):
    """A running sum would keep the rounding of 1e9 squared for good."""
    rng = random.Random(1)
    data = [(day(k), n, 2.0, 1e9 if n == "a" and k == 3 else rng.gauss(0, 2)) for n in "ab" for k in range(DAYS)]
    residual = checkpointed(spark.createDataFrame(data, RES))
    bonds = checkpointed(relative_value.pair_bonds(residual, spark.createDataFrame([], "isin string")))
    got = relative_value.switch_signals(residual, bonds).toPandas().set_index("obs_date").zscore
    wide = residual.toPandas().pivot(index="obs_date", columns="isin", values="residual_bp")
    spread = wide.a - wide.b
    for k in range(64, DAYS):
        past = spread.iloc[k - 60 : k]
        assert got[day(k)] == pytest.approx((spread.iloc[k] - past.mean()) / past.std(), abs=1e-9)


def test_buckets_equal_their_definition_and_pair_rows_stay_in_memory(spark, held, expected):
    got = {}
    bytes_written = shuffled(spark, lambda: got.update({r["bucket"]: r for r in validation.switch_bucket_reversion(*held).collect()}))
    names = ["z<-3", "-3..-2", "-2..-1", "-1..1", "1..2", "2..3", "z>3"]
    rows = pd.concat([x.assign(**{f"fwd{h}": x.spread.shift(-h) - x.spread for h in (5, 10, 20)}) for x in expected.values()])
    by = rows.groupby(pd.cut(rows.z, [-np.inf, -3, -2, -1, 1, 2, 3, np.inf], labels=names), observed=True)
    assert {b: r["n"] for b, r in got.items()} == by.size().to_dict()
    for h in (5, 10, 20):
        assert {b: r[f"fwd{h}"] for b, r in got.items()} == pytest.approx(by[f"fwd{h}"].mean().to_dict())
    assert bytes_written < 5 * BONDS * (BONDS - 1) / 2 * DAYS


def test_widest_switches_equal_their_definition_and_pair_rows_stay_in_memory(spark, held, expected):
    """The three widest of each day among bonds that are dealt in on it, and all captures beside them."""
    core = {(f"b{n:02}", day(k)) for n in range(BONDS) for k in range(DAYS) if (n * 7 + k) % 5 == 0}
    dealt = spark.createDataFrame([(when, isin) for isin, when in core], "obs_date date, isin string")
    got = []
    bytes_written = shuffled(spark, lambda: got.extend(relative_value.switch_book(*held, dealt, 3).collect()))
    ids = {r["isin"]: r["id"] for r in held[1].collect()}
    by_day = {}
    for (a, b), x in expected.items():
        for when, z in x.z.items():
            if (a, when) in core and (b, when) in core:
                by_day.setdefault(when, []).append((-abs(z), (ids[a] << 32) + ids[b]))
    wanted = {(when, k + 1): pair for when, found in by_day.items() for k, (_, pair) in enumerate(sorted(found)[:3])}
    assert {(r["obs_date"], r["place"]): r["pair"] for r in got if r["obs_date"]} == wanted and wanted
    sums = spark.createDataFrame([r for r in got if not r["obs_date"]], "pair long, obs_date date, dislocation_bp double, zscore double, threshold double, n long, total double, place int")
    captured, alone = ({r["threshold"]: r["capture_bp"] for r in df.collect()} for df in (relative_value.captured(sums), relative_value.switch_reversion(*held)))
    assert captured == pytest.approx(alone)
    assert bytes_written < 5 * BONDS * (BONDS - 1) / 2 * DAYS


def test_what_is_written_and_scored_is_the_same_however_many_groups_bonds_have(spark, held, monkeypatch):
    """Series sent once to each block would grow with the bonds' number times the groups'."""
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))

    def run():
        got = []
        kept = {p for p in folder.rglob("part-*")}
        written = shuffled(spark, lambda: got.append(relative_value.switch_signals(*held, digits=3).toPandas()))
        written += sum(p.stat().st_size for p in folder.rglob("part-*") if p not in kept)
        return written, got[0].sort_values(["pair", "obs_date"], ignore_index=True)

    few, expected = run()
    monkeypatch.setattr(switches, "MOST_BONDS", 5)
    many, got = run()
    pd.testing.assert_frame_equal(got, expected)
    assert many < 1.5 * few


def test_scores_are_named_once_a_pair(spark, held):
    """Bonds are joined to rows of pairs, of which each holds all its days."""
    residual, bonds = held
    series = relative_value.named(relative_value.switch_series(residual, bonds, digits=3), bonds)
    count, pairs = series.count(), series.select("isin_a", "isin_b").distinct().count()
    assert count == pairs == BONDS * (BONDS - 1) // 2
    columns = ["isin_a", "isin_b", "obs_date", "spread_bp", "zscore", "n_window"]
    one, other = (df.select(columns).toPandas().sort_values(columns[:3], ignore_index=True) for df in (relative_value.daily(series), relative_value.named(relative_value.switch_signals(residual, bonds, digits=3), bonds)))
    pd.testing.assert_frame_equal(one, other)

import datetime as dt

from bondloom.llm.queries import p5_months_from_days


def test_months_cover_trades_and_bonds(spark, tmp_path):
    days = [dt.date(2026, 8, 3), dt.date(2026, 8, 4), dt.date(2026, 9, 1)]
    quotes = [(10 * k + b, day, f"b{b}", "s", 10.0 + k + b, None if b else 9.0) for k, day in enumerate(days) for b in range(2)]
    trades = [(10 * k + b, day, f"b{b}", 20.0 + k + b) for k, day in enumerate(days) for b in range(3)]
    spark.createDataFrame(quotes, "obs_seq long, obs_date date, isin string, source string, bid_yield double, offer_yield double").write.parquet(f"{tmp_path}/observations.parquet")
    spark.createDataFrame(trades, "trade_seq long, obs_date date, isin string, wavg_yield double").write.parquet(f"{tmp_path}/trade_summary.parquet")
    got = {(r["reading"], r["isin"], r["source"], r["month"].month): r for r in p5_months_from_days(spark, str(tmp_path)).collect()}
    sizes = {("bid_yield", None, "s", 8): 4, ("bid_yield", None, "s", 9): 2, ("offer_yield", None, "s", 8): 2, ("offer_yield", None, "s", 9): 1, ("wavg_yield", None, None, 8): 6, ("wavg_yield", None, None, 9): 3}
    sizes |= {("bid_yield", f"b{b}", "s", m): n for b in range(2) for m, n in ((8, 2), (9, 1))} | {("offer_yield", "b0", "s", 8): 2, ("offer_yield", "b0", "s", 9): 1}
    sizes |= {("wavg_yield", f"b{b}", None, m): n for b in range(3) for m, n in ((8, 2), (9, 1))}
    assert {k: r["n"] for k, r in got.items()} == sizes
    assert (got["wavg_yield", "b2", None, 9]["p50"], got["wavg_yield", None, None, 9]["p50"]) == (24.0, 23.0)
    assert all(r["rank_error"] <= 1 / r["n"] for r in got.values())

"""The command line: ``python -m bondloom.cli COMMAND --data DIR``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom import surfaces
from bondloom.plans import book, curve, market, shape
from bondloom.queries import book as book_queries
from bondloom.queries import curve as curve_queries
from bondloom.queries import ingest as ingest_queries
from bondloom.queries import market as market_queries
from bondloom.session import checkpointed, local_session
from bondloom.sources import store
from bondloom.sources.landing import previewed
from bondloom.streaming.update import follow, refit

#: Arrivals that ``update`` follows: keys, order and values of each.
FOLLOWED = {
    "observations": (["obs_date", "isin", "source"], "obs_seq", ["bid_yield", "offer_yield", "mid_yield", "volume_lkr"]),
    "trade_summary": (["obs_date", "isin"], "trade_seq", ["security_type", "wavg_yield", "volume_lkr", "n_trades"]),
}


def frames(spark: SparkSession, d: str, top: int = 6) -> dict[str, DataFrame]:
    """The frames that a day's surfaces are made of."""
    f = book_queries.facts(spark, d)
    trades = checkpointed(curve.usable_trades(spark, d))
    fitted = checkpointed(curve.fits_of(f.residual))
    days = market.scoring_days(f.residual)
    gap = checkpointed(market.execution_gap(market.gaps(f.residual, trades), days))
    forecast = checkpointed(market.forecast(f.residual, trades, checkpointed(market.accuracy(market.backtest(f.residual, trades)))))
    rates = checkpointed(market.funding(curve.valid_trades(spark, d), days))
    spreads = checkpointed(shape.spread_signals(shape.spreads(shape.points(f.residual))))
    return {
        "tiles": book.tiles(f, fitted, checkpointed(curve.trade_check(trades, fitted)), curve.valid_trades(spark, d)), "core": book.core(f), "others": book.also_trading(f, max(top - 2, 3)), "waiting": book.waiting(f),
        "switches": book_queries.switches(spark, d, f, top), "shape": shape.as_of(spreads, shape.reversion(spreads)), "curve": f.residual, "carried": book.carried_trades(f, trades),
        "carry": market.carry(f.residual, f.bonds, rates, market.entry_gaps(forecast, gap)), "forecast": forecast, "gap": gap, "funding": rates,
    }


def update(spark: SparkSession, landing: str, state: str, only_new: bool) -> int:
    """Takes in landed arrivals and fits the days that are due; 1 if nothing was there to take."""
    taken = 0
    for name, (keys, order, values) in FOLLOWED.items():
        source = f"{landing}/{name}"
        if store.exists(spark, source):
            schema = spark.read.parquet(source).schema
            follow(spark, source, f"{state}/{name}.parquet", f"{state}/_log/{name}", schema=schema.simpleString()[7:-1].replace(":", " "), keys=keys, order=order, values=values).awaitTermination()
            taken += 1
    if store.exists(spark, f"{landing}/bonds"):
        store.rebuild(spark.read.parquet(f"{landing}/bonds"), f"{state}/bonds.parquet")
    if not taken:
        print(f"nothing landed in {landing}", file=sys.stderr)
        return 1
    n = refit(spark, curve.usable_quotes(spark, state), curve.usable_trades(spark, state), state, only_new)
    print(f"{n} days fitted")
    return 0


def printed(df: DataFrame | pd.DataFrame) -> None:
    rows = df if isinstance(df, pd.DataFrame) else df.toPandas()
    print(rows.to_string(index=False))


#: The validation reports by their queries, each a small table.
REPORTS = {
    "bonds: change after the score": market_queries.z_bucket_reversion, "bonds: score and next change": market_queries.z_correlation, "switches: change after the score": book_queries.switch_bucket_reversion,
    "dispersion": market_queries.residual_dispersion, "dealing": market_queries.dealing_accuracy, "dealing by age of the last trade": book_queries.dealing_by_age, "screen lag": market_queries.screen_lag,
    "curve shape by month": market_queries.spread_monthly_pivot, "curve shape against chance": book_queries.spread_chance_test, "auction cycle": market_queries.auction_cycle, "gap by month": market_queries.gap_by_month,
}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="bondloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--data", required=True, help="folder of the tables")
        return sub

    for name, text in (("backfill", "take in all landed files and fit every day"), ("update", "take in new files and fit the days that are due")):
        command(name, text).add_argument("--landing", required=True)
    history = command("history", "quotes and trades of a bond")
    history.add_argument("--isin", required=True)
    history.add_argument("--tail", type=int, default=20)
    history.add_argument("--chart", help="also draw it here")
    inspect = command("inspect", "list landed files by their first bytes")
    inspect.add_argument("--dump", help="show the cells of the workbooks whose path has this in it")
    fit = command("fit", "fit the curve")
    fit.add_argument("--date", type=dt.date.fromisoformat)
    fit.add_argument("--all", action="store_true", help="every day, else those of the newest month")
    fit.add_argument("--calibrate", action="store_true", help="measure the decay; it is not stored")
    fit.add_argument("--plot", help="draw the day here, the newest by default")
    signals = command("signals", "score bonds, switches and spreads and store their statistics")
    signals.add_argument("--out", required=True)
    report = command("report", "the book of a day as text")
    report.add_argument("--date", type=dt.date.fromisoformat)
    report.add_argument("--top", type=int, default=6)
    command("validate", "what the signals were worth")
    page = command("page", "the book of the newest day as a page")
    page.add_argument("--out", default="index.html")
    page.add_argument("--fragment", action="store_true")
    args = parser.parse_args(arguments)
    spark = spark or local_session()
    d = args.data

    if args.command in ("backfill", "update"):
        return update(spark, args.landing, d, args.command == "update")
    if args.command == "history":
        rows = surfaces.history(ingest_queries.bond_history(spark, d), args.isin, args.tail)
        printed(rows)
        if args.chart:
            Path(args.chart).write_text(surfaces.history_chart(rows))
    elif args.command == "inspect":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(d)
        printed(previewed(files))
        if args.dump:
            from bondloom.sources.workbook import workbook_cells

            workbook_cells(files.where(F.contains("path", F.lit(args.dump)))).select("sheet", "row", F.transform("cells", lambda c: F.coalesce(c["text"], c["number"].cast("string"))).alias("cells"), "error").show(200, False)
    elif args.command == "fit":
        if args.calibrate:
            printed(curve_queries.lambda_calibrated(spark, d))
        fits = curve_queries.curve_fit(spark, d)
        newest = fits.agg(F.trunc(F.max("obs_date"), "month").alias("m")).scalar()
        chosen = fits.where(F.col("obs_date") == F.lit(args.date)) if args.date else fits if args.all else fits.where(F.col("obs_date") >= newest)
        printed(chosen.orderBy("obs_date"))
        if args.plot:
            day = surfaces.gather(frames(spark, d), args.date)
            if day is None:
                return 1
            Path(args.plot).write_text(surfaces.curve_chart(day))
    elif args.command == "signals":
        for name, query in (("bond_signals", curve_queries.bond_zscores), ("switch_signals", curve_queries.switch_zscores), ("curve_spreads", market_queries.curve_spread_z)):
            store.rebuild(query(spark, d), f"{args.out}/{name}")
        stats = book_queries.signal_stats(spark, d)
        store.store_stats(stats, f"{args.out}/signal_stats")
        printed(spark.read.parquet(f"{args.out}/signal_stats").orderBy("key"))
    elif args.command in ("report", "page"):
        day = surfaces.gather(frames(spark, d, getattr(args, "top", 6)), getattr(args, "date", None))
        if day is None:
            print("no curve for this day", file=sys.stderr)
            return 1
        if args.command == "report":
            print(surfaces.report(day), end="")
        else:
            Path(args.out).write_text(surfaces.page(day, args.fragment))
    else:
        for title, query in REPORTS.items():
            print(f"\n{title.upper()}")
            printed(query(spark, d))
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Incremental arrivals: new files move the state of the days they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bondloom.plans import curve
from bondloom.sources.state import replace_rows
from bondloom.sources.store import exists, replace_days, rewrite_months


def follow(spark: SparkSession, landing: str, state: str, checkpoint: str, *, schema: str, keys: Sequence[str], order: str, values: Sequence[str], day: str = "obs_date") -> StreamingQuery:
    """Takes in all files of ``landing`` not seen yet, then stops.

    A batch's rows and the stored rows of the same months are reduced to the last arrival
    per key, and only those months are written anew. A late or amended row therefore
    replaces its older one however late it comes; nothing is dropped by a watermark.
    A batch that runs again after a failure writes the same rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        def change(old: DataFrame | None, new: DataFrame) -> DataFrame:
            rows = new if old is None else new.unionByName(old.select(*new.columns))
            return replace_rows(rows, [*keys, "month"], order, [order, *values])

        rewrite_months(batch, state, f"{checkpoint}/staged/{number}", change, day)

    arrivals = spark.readStream.schema(schema).parquet(landing)
    query = arrivals.writeStream.foreachBatch(merge).option("checkpointLocation", f"{checkpoint}/log").trigger(availableNow=True).start()
    return query


def late_days(fitted: DataFrame, trades: DataFrame) -> DataFrame:
    """Days to fit again: quoted without a fit, or with another number of trades than checked."""
    now = trades.groupBy("obs_date").agg(F.count(F.lit(1)).alias("_now"))
    df = fitted.join(now, "obs_date", "left")
    return df.where(F.coalesce("_now", F.lit(0)) != F.coalesce("n_trades", F.lit(0))).select("obs_date")


def days_to_fit(quotes: DataFrame, trades: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Quoted days that have no stored fit, or whose trades are not those it was checked with."""
    quoted = quotes.select("obs_date").distinct()
    if stored is None:
        return quoted
    late = late_days(stored.select("obs_date", "n_trades"), trades)
    return quoted.join(stored.select("obs_date"), "obs_date", "left_anti").unionByName(quoted.join(late, "obs_date", "left_semi"))


def refit(spark: SparkSession, quotes: DataFrame, trades: DataFrame, store: str, only_new: bool = True) -> int:
    """Fits the days that are due and stores fits and residuals; the number of days fitted.

    Days are replaced as a whole. A day too thin to fit keeps what is stored of it.
    """
    fits, lines = f"{store}/curve_fits", f"{store}/curve_residuals"
    stored = spark.read.parquet(fits) if only_new and exists(spark, fits) else None
    days = days_to_fit(quotes, trades, stored)
    due = quotes.join(days, "obs_date", "left_semi")
    residual = curve.residuals(due).persist()
    try:
        fitted = curve.fits_of(residual)
        checked = trades.join(days, "obs_date", "left_semi")
        new = fitted.join(curve.trade_check(checked, fitted), "obs_date", "left").withColumns({"lambda_years": F.lit(curve.LAMBDA), "fitted_at": F.current_timestamp()}).fillna(0, ["n_trades"]).persist()
        n = new.count()
        if n:
            quote = residual.select("obs_date", "isin", F.lit("quote").alias("source"), F.col("tau").alias("tau_years"), F.col("mid").alias("observed_yield"), F.col("fitted").alias("fitted_yield"), "residual_bp", "weight")
            dealt = curve.trade_residuals(checked, fitted)
            trade = dealt.select("obs_date", "isin", F.lit("trade").alias("source"), F.col("tau").alias("tau_years"), F.col("traded").alias("observed_yield"), (F.col("traded") - F.col("residual_bp") / 100).alias("fitted_yield"), "residual_bp", F.lit(None).cast("double").alias("weight"))
            # Residuals first: a run that ends between the two finds the fits still due.
            replace_days(quote.unionByName(trade), lines, f"{store}/staged/residuals")
            replace_days(new, fits, f"{store}/staged/fits")
        new.unpersist()
    finally:
        residual.unpersist()
    return n

"""Tables as the last valid state of append-only arrivals; plain Parquet has no merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bondloom.functions.codecs import canonical_label, steps, synthetic_key, without_letter


def replace_rows(arrivals: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """The last arrival of each key as a whole: replace on conflict."""
    best = arrivals.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_r"))
    return best.select(*keys, "_r.*")


def first_known(arrivals: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Per column the first value that was not null: coalesce on conflict."""
    known = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return arrivals.groupBy(*keys).agg(*[known(c) for c in values])


def last_known(arrivals: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Per column the last value that was not null: partial update on conflict."""
    known = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return arrivals.groupBy(*keys).agg(*[known(c) for c in values])


def cleared(arrivals: DataFrame, file: str, version: str) -> DataFrame:
    """Only rows of the latest parse of each file: what a re-parse drops is gone."""
    latest = arrivals.groupBy(file).agg(F.max(version).alias("_v"))
    return arrivals.join(latest, file).where(F.col(version) == F.col("_v")).drop("_v")


def cleared_days(arrivals: DataFrame, day: str, version: str) -> DataFrame:
    """Only rows of the latest parse of each day: what a sheet owns is its day, not its file."""
    return cleared(arrivals, day, version)


#: What several sources tell of a bond; the first known value stays.
BOND_COLUMNS = ("coupon_pct", "maturity_date", "tenor_years", "notes", "series_label", "issue_date", "coupon_dates")


def merge_bonds(arrivals: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """A row per bond: per column the first value known in the order of ingest, and the
    earliest day it was seen. Notes that contradict the bond's label are cleared."""
    columns = [c for c in BOND_COLUMNS if c in arrivals.columns]
    known = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    rows = arrivals.where("isin is not null").groupBy("isin").agg(*[known(c) for c in columns], F.min("first_seen_date").alias("first_seen_date"))
    return repaired(rows) if {"notes", "series_label"} <= set(columns) else rows


def repaired(bonds: DataFrame) -> DataFrame:
    """Notes of several coupon steps are another bond's where the label has one step at most."""
    wrong = (F.size(steps(F.col("notes"))) > 1) & (F.size(steps(F.col("series_label"))) <= 1)
    return bonds.withColumn("notes", F.when(~F.coalesce(wrong, F.lit(False)), F.col("notes")))


def auction_observations(auctions: DataFrame) -> DataFrame:
    """Results as observations: a yield at which money changed hands is executable."""
    rows = auctions.where("way_pct is not null and kind <> 'announced'")
    last = rows.groupBy(F.col("auction_date").alias("obs_date"), "isin").agg(F.max_by(F.struct("way_pct", "accepted_lkr", "raw_ref"), "auction_seq").alias("r"))
    return last.select("obs_date", "isin", F.lit("auction").alias("source"), F.col("r.way_pct").alias("mid_yield"), F.col("r.accepted_lkr").alias("volume_lkr"), F.lit(True).alias("executable"), F.col("r.raw_ref").alias("raw_ref"))


def merge_observations(arrivals: DataFrame) -> DataFrame:
    """Quote half and volume half of each (day, bond, source), each by its last arrival.

    Both halves come from one aggregation, so no join is needed.
    """
    quote = F.col("bid_yield").isNotNull() | F.col("offer_yield").isNotNull()
    keys = ["obs_date", "isin", "source"]
    agg = arrivals.groupBy(*keys).agg(
        F.max_by(F.struct("bid_yield", "offer_yield"), F.when(quote, F.col("obs_seq"))).alias("q"),
        F.max_by(F.col("volume_lkr"), F.when(F.col("volume_lkr").isNotNull(), F.col("obs_seq"))).alias("volume_lkr"),
    )
    rows = agg.select(*keys, "q.bid_yield", "q.offer_yield", ((F.col("q.bid_yield") + F.col("q.offer_yield")) / 2).alias("mid_yield"), "volume_lkr")
    return rows.where("bid_yield is not null or offer_yield is not null or volume_lkr is not null")


def keep_or_replace(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """New rows, and old ones whose key is not among them: statistics are never deleted."""
    return new.unionByName(old.join(new, key, "left_anti"))


def resolve_isin(quotes: DataFrame, bonds: DataFrame) -> DataFrame:
    """``quotes`` (label, maturity, coupon) with isin and method: exact label, label without
    its letter if it names one bond, maturity and agreeing coupon if one bond, a key of its
    cash flows if it is a price one may believe (``admissible``), else none.

    The guards are lookups with their number of bonds. Bonds' lookups are joined as Spark
    sees fit; the first is by label, so a label's hot lines are spread by AQE.
    """
    held = bonds.where("isin like 'LKB%'")
    by_label = held.where("series_label is not null").groupBy(F.col("series_label").alias("label")).agg(F.max("isin").alias("_exact"))
    loose = held.where("series_label is not null").groupBy(without_letter(F.col("series_label")).alias("_loose")).agg(F.max("isin").alias("_one"), F.count_distinct("isin").alias("_n")).where("_n = 1").drop("_n")
    day = held.select(F.col("maturity_date").alias("maturity"), F.struct("isin", F.col("coupon_pct").alias("c")).alias("b")).groupBy("maturity").agg(F.collect_list("b").alias("_same"))
    df = quotes.join(by_label, "label", "left").withColumn("_loose", without_letter(F.col("label"))).join(loose, "_loose", "left").join(day, "maturity", "left")
    fits = F.filter("_same", lambda b: b["c"].isNull() | F.col("coupon").isNull() | (F.abs(b["c"] - F.col("coupon")) < 0.005))
    by_day = F.when(F.size(fits) == 1, F.get(fits, F.lit(0))["isin"])
    df = df.withColumn("_day", by_day)
    own = F.when(_admissible() if {"bid_yield", "offer_yield"} <= set(quotes.columns) else F.lit(False), synthetic_key(F.col("maturity"), F.col("coupon")))
    df = df.withColumn("_own", own)
    method = F.when(F.col("_exact").isNotNull(), "label").when(F.col("_one").isNotNull(), "label-no-letter").when(F.col("_day").isNotNull(), "maturity+coupon").when(F.col("_own").isNotNull(), "synthetic").otherwise("unresolved")
    return df.withColumns({"isin": F.coalesce("_exact", "_one", "_day", "_own"), "method": method}).drop("_exact", "_one", "_loose", "_same", "_day", "_own")


def _admissible() -> Column:
    width = (F.col("bid_yield") - F.col("offer_yield")) * 100
    good = (F.size(steps(F.col("label"))) == 1) & F.col("coupon").isNotNull() & (width > 0) & (width <= 50)
    return F.coalesce(good, F.lit(False))


def admissible(quotes: DataFrame) -> DataFrame:
    """Quotes that may enter without an ISIN: one coupon step, two-way, at most 50 bp wide."""
    return quotes.where(_admissible())


def printed_quotes(lines: DataFrame) -> DataFrame:
    """Quote lines as the resolver takes them: canonical label, maturity, coupon."""
    from bondloom.functions.codecs import day_first

    day = F.coalesce(F.try_to_date("maturity_text", "yyyy-MM-dd"), day_first(F.col("maturity_text")))
    return lines.select("line_key", canonical_label(F.col("printed_label")).alias("label"), day.alias("maturity"), F.col("coupon_pct").alias("coupon"), "bid_yield", "offer_yield")

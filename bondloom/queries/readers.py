"""Queries of the readers: codecs over printed texts, and tables printed as sheets and
releases, then read back. What the SQL expects is the table itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.functions import codecs
from bondloom.session import table
from bondloom.sources import releases, workbook


def ambiguous_dates(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "quote_lines").select("line_key", codecs.either_order(F.col("maturity_text")).alias("r"))
    return lines.select("line_key", "r.day_first", "r.month_first")


def isin_build(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bonds").where("tenor_years is not null and maturity_date is not null")
    return b.select("isin", codecs.build_isin("LKB", F.col("tenor_years"), F.col("maturity_date")).alias("built"), codecs.is_synthetic(F.col("isin")).alias("is_synthetic"))


def number_cleaners(spark: SparkSession, d: str) -> DataFrame:
    lines, t = table(spark, d, "quote_lines"), F.col("maturity_text")
    return lines.select("line_key", codecs.clean_number(t).alias("clean"), codecs.strict_number(t).alias("strict"), codecs.embedded_number(F.col("printed_label")).alias("embedded"))


def _spelled(day: Column) -> Column:
    return F.date_format(day, "d MMMM yyyy")


def coupon_days(spark: SparkSession, d: str) -> DataFrame:
    """Coupon days printed the long way, the later first, and read back; the issue day after its phrase."""
    b = table(spark, d, "bonds").where("coupon_dates is not null or issue_date is not null")
    name = lambda x: F.date_format(F.to_date(F.concat(F.lit("2024-"), x)), "dd MMMM")
    printed = F.array_join(F.transform(F.reverse("coupon_dates"), name), " & ")
    return b.select("isin", codecs.month_days(printed).alias("coupon_days"), codecs.day_after(F.concat(F.lit("Date of issue Monday, "), _spelled(F.col("issue_date"))), "Date of issue").alias("issued"))


def _cells(*texts: Column | str) -> Column:
    return F.array(*[F.lit(t) if isinstance(t, str) else t for t in texts])


def trade_reports(spark: SparkSession, d: str) -> DataFrame:
    """Each file's trades printed as a report, half of the files collapsed to one row, and read."""
    t = table(spark, d, "trade_summary").where("volume_lkr is not null and n_trades is not null and wavg_yield is not null and raw_ref is not null and isin is not null")
    # A day's rows of a file are one report.
    t = t.withColumn("file", F.concat_ws("/", "raw_ref", F.col("obs_date").cast("string")))
    amount = F.regexp_replace(F.format_number(F.col("volume_lkr") / 1e6, 6), ",", " ,")
    shown = _cells(F.lit("1"), F.col("isin"), F.lit("364"), F.col("security_type"), *[F.col(c).cast("string") for c in ("open_yield", "close_yield", "high_yield", "low_yield", "wavg_yield")], amount, F.col("n_trades").cast("string"))
    rows = t.select("file", F.lit(0).alias("tab"), F.col("trade_seq").cast("long").alias("row"), shown.alias("cells"))
    turned = lambda k: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "cells"))), lambda r: F.get(r["cells"], F.lit(k))), "\n")
    half = F.pmod(F.hash("file"), F.lit(2)) == 0
    collapsed = rows.where(half).groupBy("file", "tab").agg(F.min("row").alias("row"), F.array(*[turned(k) for k in range(11)]).alias("cells"))  # a report is one day's securities
    heads = rows.select("file", "tab").distinct().select("file", "tab", F.lit(-1).cast("long").alias("row"), _cells("No", " ISIN ", "Tenure").alias("cells"))
    texts = t.groupBy("file").agg(F.first("obs_date").alias("d")).select("file", F.concat(F.lit("Trade Summary - "), F.date_format("d", "dd.MM.yyyy")).alias("text"), F.date_add("d", F.lit(2)).alias("label_day"))
    read = releases.trade_rows(rows.where(~half).unionByName(collapsed).unionByName(heads), texts)
    return read.select(F.split("file", "/")[0].alias("raw_ref"), "obs_date", "isin", "security_type", "open_yield", "close_yield", "high_yield", "low_yield", "wavg_yield", "volume_lkr", "n_trades")


def _by_bond(column: Column) -> Column:
    """Texts of a release's bonds in the order of their keys; a release has a handful."""
    return F.transform(F.array_sort(F.collect_list(F.struct("isin", column.alias("v")))), lambda x: x["v"])


def auction_releases(spark: SparkSession, d: str) -> DataFrame:
    """Results printed as tables with a column per bond and a broken field name, and read."""
    a = table(spark, d, "auctions").where("kind in ('auction', 'issuance') and way_pct is not null and offered_lkr is not null and bids_lkr is not null and accepted_lkr is not null")
    a = a.withColumn("file", F.concat_ws("/", "kind", F.col("auction_date").cast("string"), F.col("auction_seq").cast("string")))
    a = a.join(table(spark, d, "bonds").where("coupon_pct is not null").select("isin", "coupon_pct"), "isin")
    mn = lambda c: F.format_number(F.col(c) / 1e6, 0)
    lines = [("", F.col("isin")), ("Series", F.concat(F.format_string("%.2f", "coupon_pct"), F.lit("%2030 'A'"))), ("of the bonds", None), ("Coupon Rate", None), ("", F.format_string("%.2f", "coupon_pct")), ("(p.a.) (%)", None), ("Amount Offered (Rs.Mn.)", mn("offered_lkr")), ("Bids Received", mn("bids_lkr")), ("Amount Accepted", mn("accepted_lkr")), ("Weighted Average Yield", F.col("way_pct").cast("string"))]
    shown = [F.concat(F.array(F.lit(name), F.lit("")), F.array(F.lit("")) if value is None else _by_bond(value)) for name, value in lines]
    tables = a.groupBy("file").agg(F.array(*shown).alias("rows")).select("file", F.lit(0).alias("tab"), F.posexplode("rows").alias("row", "cells"))
    texts = a.groupBy("file").agg(F.first("auction_date").alias("d"), F.first("kind").alias("k"), F.first("settlement_date").alias("s"))
    texts = texts.select("file", F.concat(F.lit("TREASURY BOND "), F.upper("k"), F.lit(" HELD ON "), _spelled(F.col("d")), F.coalesce(F.concat(F.lit("\nThe date of\nsettlement is "), _spelled(F.col("s")), F.lit(".")), F.lit(""))).alias("text"))
    read = releases.auction_results(tables, texts).where("error is null")
    return read.select("auction_date", "kind", "settlement_date", "isin", "coupon_pct", "way_pct", "offered_lkr", "bids_lkr", "accepted_lkr", F.split("file", "/")[2].cast("long").alias("auction_seq"))


def _sheet(rows: DataFrame, sheet: str, place: int) -> DataFrame:
    return rows.select("file", F.lit(sheet).alias("sheet"), F.lit(place).alias("place"), "row", "cells")


def _t(value: Column | str) -> Column:
    return F.struct((F.lit(value) if isinstance(value, str) else value).alias("text"), F.lit(None).cast("double").alias("number"))


def _n(value: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("text"), value.cast("double").alias("number"))


def _serial(day: Column) -> Column:
    return F.date_diff(day, F.lit("1899-12-30").cast("date"))


def quote_sheets(spark: SparkSession, d: str) -> DataFrame:
    """Each day's quotes printed as a quote sheet, every third maturity spoilt, and read."""
    q = table(spark, d, "observations").where("source = 'pdmo_daily' and bid_yield > 0.1 and bid_yield <= 100 and offer_yield > 0.1 and offer_yield <= 100")
    q = q.join(table(spark, d, "bonds").where("series_label is not null").select("isin", "series_label", "maturity_date"), "isin").where("maturity_date > obs_date")
    q = q.withColumn("file", F.col("obs_date").cast("string"))
    spoilt = F.when(F.col("obs_seq") % 3 != 0, _serial(F.col("maturity_date")))
    cells = F.array(_t(""), _t(F.concat(F.lit(" "), F.col("series_label"))), _n(F.lit(5)), _n(spoilt), _n(F.date_diff("maturity_date", "obs_date")), _n(F.lit(99.5)), _n(F.col("bid_yield") / 100), _n(F.lit(100.5)), _n(F.col("offer_yield") / 100))
    rows = q.select("file", F.col("obs_seq").cast("long").alias("row"), cells.alias("cells"))
    days = q.select("file", "obs_date").distinct()
    heads = days.select("file", F.lit(4).cast("long").alias("row"), F.array(_t("No"), _t("Series"), _t("Maturity  Period (Years)"), _t("Maturity Date"), _t("Days to Maturity"), _t("Average Buying Price"), _t(" Yield"), _t("Average Selling Price"), _t("Yield ")).alias("cells"))
    menu = days.select("file", F.explode(F.array(F.struct(F.lit(1).cast("long").alias("row"), F.array(_t(" DATE OF TRADING"), _n(_serial(F.date_sub("obs_date", F.lit(1))))).alias("cells")), F.struct(F.lit(2).cast("long").alias("row"), F.array(_t(" REPORTING DATE"), _t(":"), _n(_serial(F.col("obs_date")))).alias("cells")))).alias("r")).select("file", "r.*")
    read = workbook.daily_quotes(_sheet(rows.unionByName(heads), "QuotesTBond", 1).unionByName(_sheet(menu, "Main Menu", 0)))
    return read.select(F.col("row").alias("obs_seq"), "reporting", "trading", "label", "maturity", "bid_yield", "offer_yield", "bid_price")


def volume_sheets(spark: SparkSession, d: str) -> DataFrame:
    """Each day's trades printed as a volume sheet, without its day, and read."""
    t = table(spark, d, "trade_summary").where("isin like 'LKB%' and volume_lkr > 0 and isin is not null").groupBy("obs_date", "isin").agg(F.max_by("volume_lkr", "trade_seq").alias("v"))
    t = t.withColumn("m", codecs.isin_maturity(F.col("isin"))).where("m > obs_date").withColumn("file", F.col("obs_date").cast("string"))
    cells = F.array(_t(""), _t(F.col("isin")), _n(_serial(F.col("m"))), _n(F.date_diff("m", "obs_date") / F.lit(365.0)), _n(F.col("v") / 1e6))
    rows = t.select("file", (F.abs(F.hash("isin")) % 1000000 + 10).cast("long").alias("row"), cells.alias("cells"))
    days = t.select("file").distinct()
    extra = F.explode(F.array(F.struct(F.lit(2).cast("long").alias("row"), F.array(_t("No"), _t(" isin ")).alias("cells")), F.struct(F.lit(2000000).cast("long").alias("row"), F.array(_t(""), _t("Total"), _n(F.lit(0)), _n(F.lit(1)), _n(F.lit(1))).alias("cells"))))
    read = workbook.traded_volumes(_sheet(rows.unionByName(days.select("file", extra.alias("r")).select("file", "r.*")), "Sheet1", 0))
    return read.select(F.col("file").cast("date").alias("day"), "obs_date", "isin", "volume_lkr")


QUERIES = {f.__name__: f for f in (ambiguous_dates, isin_build, number_cleaners, coupon_days, trade_reports, auction_releases, quote_sheets, volume_sheets)}

_EITHER = r"regexp_extract(regexp_replace(maturity_text, '\s+', '', 'g'), '(\d{1,2})\.(\d{1,2})\.(\d{4})', ['a', 'b', 'y']) m"
SQL = {
    "ambiguous_dates": rf"""with x as (select line_key, {_EITHER} from quote_lines)
select line_key, try_cast(nullif(m.y || '-' || lpad(m.b, 2, '0') || '-' || lpad(m.a, 2, '0'), '-00-00') as date) day_first, try_cast(nullif(m.y || '-' || lpad(m.a, 2, '0') || '-' || lpad(m.b, 2, '0'), '-00-00') as date) month_first from x""",
    "isin_build": """
with b as (select isin, 'LKB' || lpad(cast(tenor_years as varchar), 3, '0') || strftime(maturity_date, '%y') || chr(64 + cast(month(maturity_date) as int)) || strftime(maturity_date, '%d') body from bonds where tenor_years is not null and maturity_date is not null),
d as (select *, list_reverse(string_split(array_to_string(list_transform(string_split(body, ''), lambda c: case when c between 'A' and 'Z' then cast(ascii(c) - 55 as varchar) else c end), ''), '')) dg from b)
select isin, body || cast((10 - list_sum(list_transform(dg, lambda x, i: case when i % 2 = 1 then (cast(x as int) * 2) // 10 + (cast(x as int) * 2) % 10 else cast(x as int) end)) % 10) % 10 as int) built, isin like 'SYN:%' is_synthetic from d""",
    "number_cleaners": r"""
select line_key, case when regexp_full_match(regexp_replace(maturity_text, '[ ,]', '', 'g'), '-?\d+(\.\d+)?') then try_cast(regexp_replace(maturity_text, '[ ,]', '', 'g') as double) end clean,
case when regexp_full_match(trim(maturity_text), '\d[\d,]*(\.\d+)?') then try_cast(replace(trim(maturity_text), ',', '') as double) end strict,
try_cast(replace(nullif(regexp_extract(printed_label, '\d[\d,]*(?:\.\d+)?'), ''), ',', '') as double) embedded from quote_lines""",
    "coupon_days": "select isin, nullif(array_to_string(list_sort(list_distinct(coupon_dates)), ','), '') coupon_days, case when issue_date between date '2000-01-01' and date '2070-01-01' then issue_date end issued from bonds where coupon_dates is not null or issue_date is not null",
    "trade_reports": "select raw_ref, obs_date, isin, security_type, open_yield, close_yield, high_yield, low_yield, wavg_yield, volume_lkr, n_trades from trade_summary where volume_lkr is not null and n_trades is not null and wavg_yield is not null and raw_ref is not null and isin is not null",
    "auction_releases": """
select auction_date, kind, settlement_date, isin, coupon_pct, way_pct, offered_lkr, bids_lkr, accepted_lkr, auction_seq from auctions join bonds using (isin)
where kind in ('auction', 'issuance') and coupon_pct is not null and way_pct is not null and offered_lkr is not null and bids_lkr is not null and accepted_lkr is not null""",
    "quote_sheets": """
select obs_seq, obs_date reporting, obs_date - 1 trading, series_label as label, maturity_date maturity, bid_yield, offer_yield, 99.5e0 bid_price from observations join bonds using (isin)
where source = 'pdmo_daily' and bid_yield > 0.1 and bid_yield <= 100 and offer_yield > 0.1 and offer_yield <= 100 and series_label is not null and maturity_date > obs_date""",
    "volume_sheets": """
with t as (select obs_date, isin, arg_max(volume_lkr, trade_seq) volume_lkr from trade_summary where isin like 'LKB%' and volume_lkr > 0 group by 1, 2)
select obs_date as day, obs_date, isin, volume_lkr from t join (select isin, maturity_date from bonds) using (isin) where maturity_date > obs_date""",
}

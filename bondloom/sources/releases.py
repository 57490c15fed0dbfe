"""Trade reports and auction releases, read from extracted text and table cells.

``tables`` has rows (file, tab, row, cells array<string>), ``texts`` (file, text, label_day):
what any extractor of pages gives. Rows are read by content: columns drift between files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.functions import codecs

# Patterns and phrases of the releases.
ANY_ISIN, BOND_ISIN = r"LK[A-Z]\d{5}[A-L]\d{3}", r"LKB\d{5}[A-L]\d{3}"
TRADE_FIELDS = ("open_yield", "close_yield", "high_yield", "low_yield", "wavg_yield", "volume_mn", "n_trades")
YIELDS_AFTER, YIELD_WINDOW = r"(?i)Weighted Average\s+Yield Rates?\s+of", 300


def _whole(cells: Column) -> Column:
    return F.transform(cells, lambda c: F.coalesce(c, F.lit("")))


def exploded(tables: DataFrame) -> DataFrame:
    """``tables`` with collapsed rows undone: a row that holds two ISINs and more is a whole
    table, its cells columns of lines, and line by line its rows are put together again."""
    cells = _whole(F.col("cells"))
    columns = F.transform(cells, lambda c: F.split(c, "\n"))
    height = F.array_max(F.transform(columns, lambda c: F.size(c)))
    turned = F.transform(F.sequence(F.lit(0), height - 1), lambda i: F.transform(columns, lambda c: F.coalesce(F.get(c, i), F.lit(""))))
    many = F.size(F.regexp_extract_all(F.array_join(cells, " "), F.lit(ANY_ISIN), F.lit(0))) >= 2
    lines = F.when(many & (height > 0), turned).otherwise(F.array(cells))
    return tables.select("file", "tab", "row", F.posexplode(lines).alias("line", "cells"))


def trade_rows(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """(file, obs_date, isin, security_type, yields, volume_lkr, n_trades) of trade reports.

    Only tables with an ISIN head count. The ISIN is found by its pattern anywhere in the row;
    the first seven numbers after the type's cell are the figures. Shorter rows are left out.
    """
    heads = tables.where(F.exists(_whole(F.col("cells")), lambda c: F.upper(codecs.squeeze(c)) == "ISIN")).groupBy("file", "tab").agg(F.min("row").alias("head"))
    rows = exploded(tables.join(heads, ["file", "tab"]).where(F.col("row") > F.col("head")))
    cells = F.transform("cells", codecs.squeeze)
    rows = rows.select("file", "tab", "row", "line", cells.alias("c"), F.regexp_extract(F.regexp_replace(F.array_join("cells", ""), r"\s", ""), ANY_ISIN, 0).alias("isin")).where("isin <> ''")
    kind = F.array_min(F.array_compact(F.transform("c", lambda t, i: F.when(F.lower(t).isin("tbill", "tbond"), i))))
    rows = rows.withColumn("kind", kind).where("kind is not null")
    rows = rows.withColumn("n", F.array_compact(F.transform(F.slice("c", F.col("kind") + 2, F.size("c")), codecs.clean_number))).where(F.size("n") >= len(TRADE_FIELDS))
    figures = {name: F.get("n", F.lit(i)) for i, name in enumerate(TRADE_FIELDS)}
    day = texts.select("file", codecs.report_day(F.col("text"), F.col("label_day")).alias("obs_date")).where("obs_date is not null")
    found = rows.join(day, "file")
    yields = [figures[name].alias(name) for name in TRADE_FIELDS[:5]]
    return found.select("file", "obs_date", "isin", F.get("c", F.col("kind")).alias("security_type"), *yields, codecs.rupees_from_millions(figures["volume_mn"]).alias("volume_lkr"), figures["n_trades"].cast("int").alias("n_trades"))


def _bond_table(tables: DataFrame) -> DataFrame:
    """Rows of each file's first table that names bonds, with the first bond's place (from 0)
    and the bonds, left to right. A release names a handful."""
    cells = F.transform(_whole(F.col("cells")), lambda c: F.regexp_extract(codecs.squeeze(c), BOND_ISIN, 0))
    named = tables.withColumn("_i", cells).where(F.exists("_i", lambda c: c != ""))
    place = F.array_min(F.array_compact(F.transform("_i", lambda c, i: F.when(c != "", i))))
    first = named.groupBy("file").agg(F.min(F.struct("tab", "row", place.alias("at"), F.filter("_i", lambda c: c != "").alias("isins"))).alias("b"))
    return tables.join(first, "file").where(F.col("tab") == F.col("b.tab")).select("file", "row", F.transform(_whole(F.col("cells")), codecs.squeeze).alias("c"), F.col("b.at").alias("at"), F.col("b.isins").alias("isins"))


def bond_fields(tables: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(file, isin, one text per field) of the bond tables, values turned from columns to rows.

    A row's values are its cells, empty ones left out, from the first bond's column on. A
    field is the first row whose own label has its phrase, else the first whose neighbours'
    labels have it, as names may be broken over rows with the values between.
    """
    rows = _bond_table(tables)
    own = F.array_join(F.filter(F.slice("c", 1, F.greatest(F.col("at"), F.lit(0))), lambda t: t != ""), " ")
    rows = rows.withColumn("own", own)
    order = Window.partitionBy("file").orderBy("row")
    near = F.concat_ws(" ", F.lag("own").over(order), "own", F.lead("own").over(order))
    rows = rows.withColumn("near", near).withColumn("values", F.slice(F.filter(F.slice("c", F.col("at") + 1, F.size("c")), lambda t: t != ""), 1, F.size("isins"))).where(F.size("values") > 0)
    says = lambda label, phrase: F.contains(F.lower(label), F.lit(phrase.lower()))
    rank = lambda phrase: F.when(says("own", phrase), F.struct(F.lit(0).alias("k"), F.col("row"))).when(says("near", phrase), F.struct(F.lit(1).alias("k"), F.col("row")))
    found = rows.groupBy("file").agg(F.first("isins").alias("isins"), *[F.min_by("values", rank(phrase)).alias(name) for name, phrase in fields.items()])
    return found.select("file", F.posexplode("isins").alias("place", "isin"), *fields).select("file", "place", "isin", *[F.get(name, F.col("place")).alias(name) for name in fields])


AUCTION_FIELDS = {"series": "Series", "maturity": "Maturity", "coupon": "Coupon Rate", "offered": "Amount Offered", "bids": "Bids Received", "accepted": "Amount Accepted", "way": "Weighted Average"}
NOTICE_FIELDS = {"series": "Series", "offered": "Amount offered", "coupon": "Coupon rate", "issued": "Date of issue", "maturity": "Date of maturity", "coupon_days": "coupon payment", "accrued": "Accrued Interest"}


def _decoded(isin: Column) -> Column:
    return codecs.isin_maturity(isin)


def auction_results(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """(file, auction_date, kind, settlement_date, isin, series_label, maturity_date, coupon_pct,
    way_pct, offered_lkr, bids_lkr, accepted_lkr, error) of auction and issuance releases.

    Figures come from the bond table; a release without one names bonds and yields in
    sentences, paired by position. A file that is no such release gives one row with an
    ``error``. Printed maturities never overrule the ISIN's.
    """
    headline = F.get(F.filter(F.split("text", "\n"), lambda line: line.rlike("(?i)TREASURY BOND (AUCTION|ISSUANCE)")), F.lit(0))
    flat = codecs.squeeze(F.col("text"))
    heads = texts.select("file", headline.alias("headline"), flat.alias("flat"))
    settled = codecs.spelled(F.nullif(F.regexp_extract("flat", r"(?i)date of settlement is ([^.]+)", 1), F.lit("")))
    kind = F.when(F.upper("headline").contains("ISSUANCE"), "issuance").otherwise("auction")
    heads = heads.select("file", "flat", "headline", codecs.spelled(F.col("headline")).alias("auction_date"), kind.alias("kind"), settled.alias("settlement_date"))
    error = F.when(F.col("headline").isNull(), "no auction or issuance release").when(F.col("auction_date").isNull(), "no auction date in the headline")
    heads = heads.withColumn("error", error)
    table = bond_fields(tables, AUCTION_FIELDS)
    table = table.select("file", "isin", codecs.canonical_label(F.col("series")).alias("series_label"), _decoded(F.col("isin")).alias("maturity_date"), codecs.strict_number(F.col("coupon")).alias("coupon_pct"), codecs.strict_number(F.col("way")).alias("way_pct"),
        codecs.rupees_printed(F.col("offered")).alias("offered_lkr"), codecs.rupees_printed(F.col("bids")).alias("bids_lkr"), codecs.rupees_printed(F.col("accepted")).alias("accepted_lkr"))
    good = heads.where("error is null")
    prose = good.join(table.select("file").distinct(), "file", "left_anti")
    isins = F.filter(F.array_distinct(F.regexp_extract_all("flat", F.lit(BOND_ISIN), F.lit(0))), lambda i: _decoded(i).isNotNull())
    window = F.substring(F.get(F.split("flat", YIELDS_AFTER, 2), F.lit(1)), 1, YIELD_WINDOW)
    yields = F.regexp_extract_all(F.coalesce(window, F.lit("")), F.lit(r"(\d{1,2}\.\d{1,2})\s*%"), F.lit(1))
    prose = prose.select("file", yields.alias("_y"), F.posexplode(isins).alias("place", "isin")).select("file", "isin", _decoded(F.col("isin")).alias("maturity_date"), F.get("_y", F.col("place")).cast("double").alias("way_pct"))
    bonds = table.unionByName(prose, allowMissingColumns=True)
    read = good.select("file", "auction_date", "kind", "settlement_date").join(bonds, "file").withColumn("error", F.lit(None).cast("string"))
    none = good.join(bonds.select("file").distinct(), "file", "left_anti").withColumn("error", F.lit("no bonds in the release"))
    bad = heads.where("error is not null").unionByName(none).select("file", "error")
    return read.unionByName(bad, allowMissingColumns=True)


def auction_notices(tables: DataFrame, texts: DataFrame) -> DataFrame:
    """(file, auction_date, settlement_date, isin, series_label, maturity_date, coupon_pct,
    issue_date, coupon_dates, accrued_per_100, offered_lkr, error) of announcements."""
    flat = codecs.squeeze(F.col("text"))
    opener = lambda k: F.regexp_extract("flat", r"(?i)auction on\s+([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})", k)
    heads = texts.select("file", flat.alias("flat"))
    day = F.coalesce(codecs.day_after(F.col("flat"), "Date of auction"), codecs.spelled(F.concat_ws(" ", opener(2), opener(1), opener(3))))
    ours = F.col("flat").rlike(r"(?i)ISSUE OF RS[\s\d,]+MILLION TREASURY BONDS")
    heads = heads.select("file", day.alias("auction_date"), codecs.day_after(F.col("flat"), "Date of settlement").alias("settlement_date"), F.when(~ours, "no issuance announcement").when(day.isNull(), "no auction date in the announcement").alias("error"))
    rows = bond_fields(tables, NOTICE_FIELDS)
    offered = codecs.embedded_number(F.col("offered"))
    rows = rows.select("file", "isin", codecs.canonical_label(F.col("series")).alias("series_label"), _decoded(F.col("isin")).alias("maturity_date"), codecs.embedded_number(F.col("coupon")).alias("coupon_pct"), codecs.spelled(F.col("issued")).alias("issue_date"),
        codecs.month_days(F.col("coupon_days")).alias("coupon_dates"), codecs.embedded_number(F.col("accrued")).alias("accrued_per_100"), F.when(offered != 0, codecs.rupees_from_millions(offered)).alias("offered_lkr"))
    read = heads.where("error is null").join(rows, "file")
    none = heads.where("error is null").join(rows.select("file").distinct(), "file", "left_anti").withColumn("error", F.lit("no bond table in the announcement"))
    return read.unionByName(heads.where("error is not null").unionByName(none).select("file", "error"), allowMissingColumns=True)

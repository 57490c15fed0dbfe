"""Workbooks as cells, and the quote and volume sheets read from cells.

A workbook is a zip of XML, so the standard library opens it; it is the one step in Python.
All that follows works on cells: a row is (file, sheet, place, row, cells), a cell has the
text or the number that the sheet holds. Days are serial numbers there.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.functions import codecs

CELLS = "file string, sheet string, place int, row int, cells array<struct<text: string, number: double>>, error string"

# The first bytes of a zip, and phrases of the sheets.
ZIP_MARK = b"PK\x03\x04"
MENU, QUOTES = "Main Menu", "QuotesTBond"
HEADS = {"tenor": "maturity period", "maturity": "maturity date", "days": "days to maturity", "bid_price": "average buying price", "offer_price": "average selling price"}
SERIES = r"((?:\d{1,2}(?:\.\d{1,2})?\s*%\s*)+)(20\d{2})\s*([A-Z])?"
HEAD_ROWS, VOLUME_HEAD_ROWS = 15, 8

_EPOCH = dt.datetime(1899, 12, 30)


def _local(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _column(reference: str) -> int:
    place = 0
    for letter in re.match("[A-Z]*", reference)[0]:
        place = place * 26 + ord(letter) - 64
    return place - 1


def _value(cell: ElementTree.Element, shared: list[str]) -> tuple[str | None, float | None]:
    kind, texts = cell.get("t", "n"), {_local(e): e for e in cell}
    raw = texts["v"].text if "v" in texts else None
    if kind == "inlineStr":
        return "".join(e.text or "" for e in cell.iter() if _local(e) == "t"), None
    if raw is None:
        return None, None
    if kind == "s":
        return shared[int(raw)], None
    if kind == "d":
        return None, (dt.datetime.fromisoformat(raw) - _EPOCH).total_seconds() / 86400
    return (None, float(raw)) if kind in ("n", "b") else (raw, None)


def read_workbook(content: bytes) -> Iterator[tuple[str, int, int, list[tuple[str | None, float | None]]]]:
    """(sheet, place, row, cells) of each row that is not empty, gaps filled."""
    if content[:4] != ZIP_MARK:
        raise ValueError("no zipped workbook")
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        tree = lambda name: ElementTree.fromstring(book.read(name))
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in item.iter() if _local(t) == "t") for item in tree("xl/sharedStrings.xml")]
        targets = {e.get("Id"): e.get("Target") for e in tree("xl/_rels/workbook.xml.rels")}
        sheets = [e for e in tree("xl/workbook.xml").iter() if _local(e) == "sheet"]
        for place, sheet in enumerate(sheets):
            target = next(targets[v] for k, v in sheet.attrib.items() if k.rpartition("}")[2] == "id")
            path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            for number, line in enumerate(e for e in tree(path).iter() if _local(e) == "row"):
                row = int(line.get("r", number + 1)) - 1
                cells: list[tuple[str | None, float | None]] = []
                for cell in line:
                    at = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells += [(None, None)] * (at - len(cells)) + [_value(cell, shared)]
                yield sheet.get("name", ""), place, row, cells


def workbook_cells(files: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """CELLS of workbooks (as ``binaryFile`` gives them). A file that cannot be read gives one
    row with its ``error``; it never stops the others. Null contents are left out."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split(" ")[0] for c in ("file", "sheet", "place", "row", "cells", "error")]
        for batch in batches:
            for file, data in zip(batch["file"], batch["content"]):
                try:
                    rows = [(file, sheet, place, row, [{"text": t, "number": n} for t, n in cells], None) for sheet, place, row, cells in read_workbook(bytes(data))]
                except Exception as error:  # noqa: BLE001 - many kinds, all mean that the file is not readable
                    rows = [(file, None, None, None, None, f"{type(error).__name__}: {error}")]
                yield pd.DataFrame(rows, columns=columns)

    slim = files.select(F.col(name).cast("string").alias("file"), F.col(content).alias("content")).where("content is not null")
    # A workbook is far larger in cells than in bytes.
    return slim.mapInPandas(read, CELLS)


def _text(cells: Column) -> Column:
    """Texts of a row, small letters, blanks squeezed; numbers are null."""
    return F.transform(cells, lambda c: F.lower(codecs.squeeze(c["text"])))


def _last_place(texts: Column, says) -> Column:  # noqa: ANN001
    """The last place (from 0) whose text fits, null if none."""
    places = F.transform(texts, lambda t, i: F.when(F.coalesce(says(t), F.lit(False)), i))
    return F.array_max(F.array_compact(places))


def _labelled(menu: DataFrame, label: str, alias: str) -> DataFrame:
    """(file, alias): the last number of the first row that names ``label``."""
    said = F.contains(F.array_join(F.array_compact(_text(F.col("cells"))), " "), F.lit(label.lower()))
    numbers = F.filter(F.transform("cells", lambda c: c["number"]), lambda n: n.isNotNull() & (n != 0))
    rows = menu.where(said).select("file", "row", numbers.alias("n")).where(F.size("n") > 0)
    return rows.groupBy("file").agg(F.min_by(F.element_at("n", -1), "row").alias(alias))


def daily_quotes(cells: DataFrame) -> DataFrame:
    """(file, row, reporting, trading, update, label, printed_label, coupon, maturity, prices,
    yields) of the quote sheets; rows without a yield, as matured bonds keep, are left out.

    Columns are found by their heads in the first HEAD_ROWS rows; each yield is the first
    one right of its price. A bad maturity is rebuilt from the days to it.
    """
    menu = cells.where(F.col("sheet") == MENU)
    days = _labelled(menu, "REPORTING DATE", "_r").join(_labelled(menu, "DATE OF TRADING", "_t"), "file", "left").join(_labelled(menu, "UPDATE", "update"), "file", "left")
    days = days.select("file", codecs.serial_day(F.col("_r")).alias("reporting"), codecs.serial_day(F.col("_t")).alias("_t"), "update").where("reporting is not null")
    days = days.select("file", "reporting", F.coalesce("_t", "reporting").alias("trading"), "update")
    sheet = cells.where(F.col("sheet") == QUOTES)
    texts = _text(F.col("cells"))
    heads = sheet.where(F.col("row") < HEAD_ROWS).select("file", "row", *[_last_place(texts, lambda t, p=phrase: F.contains(t, F.lit(p))).alias(name) for name, phrase in HEADS.items()], F.array_compact(F.transform(texts, lambda t, i: F.when(t == "yield", i))).alias("_y"))
    right = lambda price: F.array_min(F.filter("_y", lambda y: y > F.col(price)))
    heads = heads.dropna(subset=list(HEADS)).where(F.size("_y") >= 2).withColumns({"bid_yield": right("bid_price"), "offer_yield": right("offer_price")}).dropna(subset=["bid_yield", "offer_yield"])
    places = [*HEADS, "bid_yield", "offer_yield"]
    heads = heads.groupBy("file").agg(F.min_by(F.struct(*places), "row").alias("at"))
    printed = F.get(F.filter(F.transform("cells", lambda c: F.regexp_extract(c["text"], SERIES, 0)), lambda t: F.length(t) > 0), F.lit(0))
    rows = sheet.withColumn("printed", codecs.squeeze(printed)).where("printed is not null").join(heads, "file").join(days, "file")
    number = lambda name: F.get("cells", F.col(f"at.{name}"))["number"]
    positive = lambda name: F.when(number(name) > 0, number(name))
    maturity = F.coalesce(codecs.serial_day(number("maturity")), F.when(number("days") > 0, F.date_add("reporting", number("days").cast("int"))))
    steps = codecs.steps(F.col("printed"))
    rows = rows.select("file", "row", "reporting", "trading", "update", codecs.canonical_label(F.col("printed")).alias("label"), F.when(F.size(steps) > 1, F.col("printed")).alias("printed_label"), F.get(steps, F.lit(0)).alias("coupon"), maturity.alias("maturity"),
        positive("bid_price").alias("bid_price"), positive("offer_price").alias("offer_price"), codecs.percent(number("bid_yield")).alias("bid_yield"), codecs.percent(number("offer_yield")).alias("offer_yield"))
    return rows.where("maturity is not null and (bid_yield is not null or offer_yield is not null)")


def traded_volumes(cells: DataFrame) -> DataFrame:
    """(file, obs_date, isin, maturity, volume_lkr) of the volume sheets, the first of a book.

    Columns stand in fixed order right of the ISIN head; reading ends at the total. The day is
    the lower median of maturity less remaining years of 365 days, not the title's.
    """
    sheet = cells.where(F.col("place") == 0)
    isin_head = _last_place(F.transform("cells", lambda c: F.upper(F.trim(c["text"]))), lambda t: t == "ISIN")
    heads = sheet.where(F.col("row") < VOLUME_HEAD_ROWS).select("file", "row", isin_head.alias("at")).where("at is not null")
    heads = heads.groupBy("file").agg(F.min(F.struct("row", "at")).alias("h"))
    cell = lambda k: F.get("cells", F.col("h.at") + k)
    rows = sheet.join(heads, "file").where(F.col("row") > F.col("h.row")).select("file", "row", F.trim(cell(0)["text"]).alias("isin"), cell(2)["number"].alias("remaining"), cell(3)["number"].alias("amount"))
    ends = rows.where(F.contains(F.lower("isin"), F.lit("total"))).groupBy("file").agg(F.min("row").alias("end"))
    rows = rows.join(ends, "file", "left").where((F.col("row") < F.coalesce("end", F.lit(1 << 30))) & (F.col("amount") > 0))
    key = F.upper("isin")
    rows = rows.withColumn("maturity", F.when(key.startswith("LKB"), codecs.isin_maturity(key))).where("maturity is not null")
    derived = F.when((F.col("remaining") > 0) & (F.col("remaining") < 50), F.date_sub("maturity", F.bround(F.col("remaining") * 365).cast("int")))
    # A sheet lists each bond once, so its days are few.
    all_days = F.array_sort(F.collect_list(derived).over(Window.partitionBy("file")))
    middle = F.when(F.size(all_days) > 0, F.get(all_days, F.floor((F.size(all_days) - 1) / 2).cast("int")))
    return rows.select("file", middle.alias("obs_date"), "isin", "maturity", codecs.rupees_from_millions(F.col("amount")).alias("volume_lkr"))

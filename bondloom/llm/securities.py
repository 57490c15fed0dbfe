"""Reading printed bond lines, and the evidence that a line denotes a bond."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The months' names.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

#: Days that a printed maturity may be off, and half a printed digit of a coupon.
NEAR_DAYS, NEAR_COUPON, ROUGH_COUPON, ROUGH_BIN = 3, 0.0051, 0.0501, 0.06

#: Weights of the rules. A conflict rule fires if all evidence of its kind disagrees.
WEIGHTS = {"date": 4.0, "days": 2.0, "rate": 3.0, "coupon": 2.0, "year": 1.0, "month": 0.5, "tenor": 0.7, "letter": 0.5}
CONFLICT = 10.0

_RATE = re.compile(r"(\d{1,2}(?:\.\d+)?)\s*%")
_SHORT = re.compile(r"(\d{1,2}(?:\.\d+)?)((?:%\d{1,2}(?:\.\d+)?)*) (\d\d)\s*([A-Z]?)")
_YEAR = re.compile(r"(?<![\d.])(20\d\d)(?![\d.])")
_MONTH_YEAR = re.compile(rf"({'|'.join(MONTHS)})[a-z]*\s*(20\d\d)", re.IGNORECASE)
_LETTER = re.compile(r"20\d\d\W*([A-Z])\W*(?=$|\s)", re.IGNORECASE)


def read_label(label: str | None) -> tuple[list[float], int | None, int | None, str | None]:
    """(rates, year, month, letter) of a printed series label."""
    if not label:
        return [], None, None, None
    text = re.sub(r"(?<=\d)[Oo](?=[\d.%\s]|$)|(?<![A-Za-z])[Oo](?=\d)|(?<=[\d.])[Oo](?=\d|%)", "0", label).replace(",", ".")
    short = _SHORT.fullmatch(text.strip())
    if short:
        rates = [float(short[1]), *[float(x) for x in re.findall(r"\d+(?:\.\d+)?", short[2])]]
        return rates, 2000 + int(short[3]), None, short[4] or None
    rates = [float(x) for x in _RATE.findall(text)]
    letter = _LETTER.search(text)
    dated = _MONTH_YEAR.search(text)
    if dated:
        return rates, int(dated[2]), MONTHS.index(dated[1].lower()) + 1, letter[1].upper() if letter else None
    year = _YEAR.search(re.sub(r"[A-Za-z]", " ", text))
    return rates, int(year[1]) if year else None, None, letter[1].upper() if letter else None


def _day(year: int, month: int, day: int) -> list[dt.date]:
    try:
        return [dt.date(year, month, day)]
    except ValueError:
        return []


def read_maturity(text: str | None) -> tuple[list[dt.date], int | None]:
    """(possible days, year alone) of a printed maturity. Day first, else month first."""
    if not text:
        return [], None
    t = re.sub(r"\s*([./])\s*", r"\1", text.strip())
    if m := re.fullmatch(r"(\d{4})-?(\d\d)-?(\d\d)", t):
        return _day(*map(int, m.groups())), None
    if m := re.fullmatch(r"(\d\d?)[./-](\d\d?)[./-](\d{4})", t):
        a, b, year = map(int, m.groups())
        return list(dict.fromkeys(_day(year, b, a) + _day(year, a, b))), None
    if m := re.fullmatch(r"(\d\d?)(?:st|nd|rd|th)?[\s-]+([A-Za-z]{3,})\.?,?[\s-]+(\d{4}|\d\d)", t):
        month = m[2][:3].lower()
        if month in MONTHS:
            return _day(int(m[3]) + 2000 * (len(m[3]) == 2), MONTHS.index(month) + 1, int(m[1])), None
    if re.fullmatch(r"\d{5}", t):  # a sheet's serial day
        return [dt.date(1899, 12, 30) + dt.timedelta(int(t))], None
    if m := re.fullmatch(r"20\d\d", t):
        return [], int(m[0])
    return [], None


READ = "key string, rates array<double>, label_year int, label_month int, letter string, days array<date>, year int, coupon double, tenor int, by_days date"


def read_lines(lines: DataFrame) -> DataFrame:
    """Quote lines as READ: what each attribute says, null where it says nothing."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for line in batch.itertuples(index=False):
                rates, year, month, letter = read_label(line.printed_label)
                days, year_alone = read_maturity(line.maturity_text)
                rows.append((line.line_key, rates, year, month, letter, days, year_alone))
            yield pd.DataFrame(rows, columns=["key", "rates", "label_year", "label_month", "letter", "days", "year"]).astype({c: "Int32" for c in ("label_year", "label_month", "year")})

    columns = ("line_key", "printed_label", "maturity_text")
    read_rows = lines.select(*columns).where("line_key is not null").mapInPandas(read, READ.split(", coupon")[0])
    # A fraction and a percentage are told apart by size: no coupon is under one half.
    coupon = F.when(F.col("coupon_pct") < 0.5, F.col("coupon_pct") * 100).otherwise(F.col("coupon_pct"))
    rest = lines.select(F.col("line_key").alias("key"), coupon.alias("coupon"), F.col("tenor_years").alias("tenor"), F.date_add("sheet_date", F.col("days_to_maturity")).alias("by_days"))
    return read_rows.join(rest, "key")


def read_synthetic(keys: DataFrame, column: str = "isin") -> DataFrame:
    """Distinct ``SYN:<maturity>:<coupon>`` keys as READ."""
    parts = F.split(column, ":")
    distinct = keys.where(F.col(column).startswith("SYN:")).select(column).distinct()
    none = {"label_year": "int", "label_month": "int", "letter": "string", "year": "int", "tenor": "int", "by_days": "date"}
    day = F.try_to_date(F.get(parts, F.lit(1)), "yyyy-MM-dd")
    out = distinct.select(F.col(column).alias("key"), F.array().cast("array<double>").alias("rates"), F.array_compact(F.array(day)).alias("days"), F.get(parts, F.lit(2)).try_cast("double").alias("coupon"))
    return out.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})


def _agree(said: Column, is_so: Column) -> Column:
    """How well a printed coupon fits: exactly, rounded to one digit, or not."""
    off = F.abs(said - is_so)
    return F.when(off <= NEAR_COUPON, 1.0).when(off <= ROUGH_COUPON, 0.85).otherwise(F.lit(0.0))


def candidate_pairs(read: DataFrame, bonds: DataFrame) -> DataFrame:
    """(key, isin, alike, pull, weight) of the pairs that share a day or a coupon and year.

    A line meets the bonds whose maturity is within NEAR_DAYS of one it prints, and those
    of its coupon and year, so pairs grow with the lines; bonds under one key are few.
    """

    @F.pandas_udf("struct<rates: array<double>, letter: string>")
    def label_of(labels: pd.Series) -> pd.DataFrame:
        rows = [read_label(x) for x in labels]
        return pd.DataFrame({"rates": [r[0] for r in rows], "letter": [r[3] for r in rows]})

    held = bonds.where("isin is not null and maturity_date is not null").select("isin", F.col("coupon_pct").alias("b_coupon"), F.col("maturity_date").alias("b_day"), F.col("tenor_years").alias("b_tenor"), label_of("series_label").alias("l"))
    held = held.withColumn("b_rates", F.array_distinct(F.array_compact(F.concat(F.array("b_coupon"), F.coalesce("l.rates", F.array().cast("array<double>")))))).withColumn("b_letter", F.col("l.letter")).drop("l")
    tag = lambda coupon, year: F.concat(F.lit("c"), F.round(coupon / ROUGH_BIN).cast("long").cast("string"), F.lit(":"), year.cast("string"))
    held = held.withColumn("block", F.explode(F.concat(F.array(F.col("b_day").cast("string")), F.transform("b_rates", lambda c: tag(c, F.year("b_day"))))))

    said_days = F.array_compact(F.concat("days", F.array("by_days")))
    near = F.flatten(F.transform(said_days, lambda d: F.transform(F.sequence(F.lit(-NEAR_DAYS), F.lit(NEAR_DAYS)), lambda k: F.date_add(d, k).cast("string"))))
    years = F.array_distinct(F.array_compact(F.array("label_year", "year")))
    coupons = F.array_distinct(F.array_compact(F.concat("rates", F.array("coupon"))))
    # A bin is as wide as a coupon may be off, so bonds that agree lie in it or beside it.
    beside = lambda c: F.array(*[c + k * ROUGH_BIN for k in (-1, 0, 1)])
    near_coupons = F.flatten(F.transform(coupons, beside))
    tags = F.flatten(F.transform(years, lambda y: F.transform(near_coupons, lambda c: tag(c, y))))
    asks = read.withColumn("block", F.explode(F.array_distinct(F.concat(near, tags))))
    pairs = asks.join(held, "block").drop("block").dropDuplicates(["key", "isin"])

    nearest = lambda said: F.array_min(F.transform(said, lambda d: F.abs(F.date_diff(d, F.col("b_day")))))
    by_distance = lambda n: F.when(n == 0, 1.0).when(n <= NEAR_DAYS, 0.9).otherwise(F.lit(0.0))
    # Every rate that a line prints must be one of the bond's.
    fits = F.transform("rates", lambda r: F.array_max(F.transform("b_rates", lambda c: _agree(r, c))))
    rates = F.aggregate(fits, F.lit(0.0), lambda s, x: s + x) / F.size("rates")
    field = F.array_max(F.transform("b_rates", lambda c: _agree(F.col("coupon"), c)))
    year_fits = F.when(F.col("year") == F.year("b_day"), 0.9).otherwise(F.lit(0.0))
    off_tenor = F.abs(F.col("tenor") - F.col("b_tenor"))
    says = {
        "date": F.when(F.size("days") > 0, by_distance(nearest(F.col("days")))).when(F.col("year").isNotNull(), year_fits),
        "days": F.when(F.col("by_days").isNotNull(), by_distance(F.abs(F.date_diff("by_days", "b_day")))),
        "rate": F.when((F.size("rates") > 0) & (F.size("b_rates") > 0), rates),
        "coupon": F.when(F.col("coupon").isNotNull() & (F.size("b_rates") > 0), field),
        "year": F.when(F.col("label_year").isNotNull(), (F.col("label_year") == F.year("b_day")).cast("double")),
        "month": F.when(F.col("label_month").isNotNull(), (F.col("label_month") == F.month("b_day")).cast("double")),
        "tenor": F.when(off_tenor == 0, 1.0).when(off_tenor == 1, 0.7).when(off_tenor > 1, 0.0),
        "letter": F.when(F.col("letter").isNotNull() & F.col("b_letter").isNotNull(), (F.col("letter") == F.col("b_letter")).cast("double")),
    }
    pairs = pairs.withColumns({f"s_{c}": v for c, v in says.items()})
    # All that speaks of the day, or of the coupon, is against it.
    against = lambda *names: F.coalesce(F.greatest(*names) == 0, F.lit(False))
    days_against = against("s_date", "s_days") | (F.coalesce("s_date", "s_days").isNull() & (F.coalesce("s_year", F.lit(0.0)) == 0))
    conflicts = F.when(days_against, CONFLICT).otherwise(0.0) + F.when(against("s_rate", "s_coupon"), CONFLICT).otherwise(0.0)
    zero = F.lit(0.0)
    total = sum((F.when(F.col(f"s_{c}").isNotNull(), w).otherwise(zero) for c, w in WEIGHTS.items()), conflicts)
    asked = sum((F.coalesce(F.col(f"s_{c}") * w, zero) for c, w in WEIGHTS.items()), zero)
    printed_day = F.coalesce(F.when(F.size("days") == 1, F.get("days", F.lit(0))), F.col("by_days"))
    alike = F.concat_ws(":", printed_day.cast("string"), F.round(F.coalesce(F.get("rates", F.lit(0)), F.col("coupon")), 2).cast("string"))
    alike = F.when(printed_day.isNotNull() & F.coalesce(F.get("rates", F.lit(0)), F.col("coupon")).isNotNull(), alike)
    return pairs.select("key", "isin", alike.alias("alike"), (asked / total).alias("pull"), total.alias("weight"))

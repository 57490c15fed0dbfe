"""Codecs of identifiers, labels, dates and money as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def steps(label: Column) -> Column:
    """Coupon rates printed in a series label; none for null."""
    found = F.regexp_extract_all(label, F.lit(r"(\d+(?:\.\d+)?)\s*%"), F.lit(1))
    return F.coalesce(F.transform(found, lambda x: x.cast("double")), F.array().cast("array<double>"))


def canonical_label(label: Column) -> Column:
    """Rates to two digits joined by %, then the year and its letter; null if unreadable."""
    clean = F.regexp_replace(label, "[\\s'’\"]", "")
    year = F.regexp_extract(clean, r"%(\d{4})([A-Z]?)$", 1)
    letter = F.regexp_extract(clean, r"%(\d{4})([A-Z]?)$", 2)
    rates = F.array_join(F.transform(steps(clean), lambda x: F.format_string("%.2f", x)), "%")
    return F.when(year != "", F.concat(rates, F.lit("%"), year, letter))


def without_letter(label: Column) -> Column:
    return F.regexp_replace(label, "[A-Z]+$", "")


def isin_check_digit(body: Column) -> Column:
    """Check digit of an 11-character body: letters as two digits, every second doubled."""
    upper = F.transform(F.split(body, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
    digits = F.reverse(F.filter(F.split(F.array_join(upper, ""), ""), lambda d: d != ""))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.floor(d / 10).cast("int") + d % 10)
    return ((10 - total % 10) % 10).cast("int")


def isin_maturity(isin: Column) -> Column:
    """Maturity printed in a bond or bill key; null if the key is malformed or its check fails."""
    isin = F.upper(F.trim(isin))
    pattern = r"^LK[AB](\d{3})(\d{2})([A-L])(\d{2})(\d)$"
    part = lambda k: F.regexp_extract(isin, pattern, k)
    month = F.lpad((F.ascii(part(3)) - 64).cast("string"), 2, "0")
    day = F.try_to_date(F.concat(F.lit("20"), part(2), month, part(4)), "yyyyMMdd")
    good = isin.rlike(pattern) & (F.try_element_at(F.split(isin, ""), F.lit(12)) == isin_check_digit(F.substring(isin, 1, 11)).cast("string"))
    return F.when(good, day)


def isin_tenor(isin: Column) -> Column:
    """Tenor in a key: years of a bond, days of a bill."""
    return F.when(isin_maturity(isin).isNotNull(), F.substring(F.upper(F.trim(isin)), 4, 3).cast("int"))


def synthetic_key(maturity: Column, coupon: Column) -> Column:
    """Key of a security known by its cash flows alone; null without a coupon."""
    text = F.concat(F.lit("SYN:"), F.date_format(maturity, "yyyy-MM-dd"), F.lit(":"), F.format_string("%.3f", coupon))
    return F.when(coupon.isNotNull() & maturity.isNotNull(), text)


def day_first(text: Column) -> Column:
    """First d.m.yyyy in a text, blanks ignored; null if it is no day from 2000 to 2069."""
    clean = F.regexp_replace(text, r"\s+", "")
    p = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
    part = lambda k, n: F.lpad(F.regexp_extract(clean, p, k), n, "0")
    return sane(F.when(F.regexp_extract(clean, p, 3) != "", F.try_to_date(F.concat(part(3, 4), part(2, 2), part(1, 2)), "yyyyMMdd")))


def spelled(text: Column) -> Column:
    """First "12th June 2034" in a text, English month names in full."""
    p = r"(?i)(\d{1,2})(?:st|nd|rd|th)?\s+(January|February|March|April|May|June|July|August|September|October|November|December),?\s+(\d{4})"
    part = lambda k: F.regexp_extract(text, p, k)
    return sane(F.when(part(3) != "", F.try_to_date(F.concat_ws(" ", F.lpad(part(1), 2, "0"), F.initcap(part(2)), part(3)), "dd MMMM yyyy")))


def serial_day(value: Column) -> Column:
    """Day of a sheet's serial number, a number or its text."""
    number = value.cast("string").try_cast("double")
    return sane(F.when(F.abs(number) < 1e6, F.date_add(F.lit("1899-12-30").cast("date"), number.cast("int"))))


def sane(day: Column) -> Column:
    return F.when((day >= F.lit("2000-01-01").cast("date")) & (day <= F.lit("2070-01-01").cast("date")), day)


def rupees_from_millions(millions: Column) -> Column:
    return F.bround(millions * 1_000_000).cast("long")


def percent(value: Column) -> Column:
    """A sheet's fraction as percent to six digits; null for none, not positive or over 1."""
    number = value.try_cast("double")
    return F.when((number > 0) & (number <= 1), F.round(number * 100, 6))


# Fixed value: the months' English names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def full_year(year: Column) -> Column:
    """Years of two digits are of this century."""
    return F.when(year < 100, year + 2000).otherwise(year)


def _day_of(year: Column, month: Column, day: Column) -> Column:
    part = lambda c, n: F.lpad(c.cast("int").cast("string"), n, "0")
    return sane(F.try_to_date(F.concat(part(full_year(year.cast("int")), 4), part(month, 2), part(day, 2)), "yyyyMMdd"))


def either_order(text: Column) -> Column:
    """Struct (day_first, month_first) of the first d.d.yyyy in a text, blanks ignored; a
    reading that is no day is null."""
    clean = F.regexp_replace(text, r"\s+", "")
    a, b, year = (F.nullif(F.regexp_extract(clean, r"(\d{1,2})\.(\d{1,2})\.(\d{4})", k), F.lit("")) for k in (1, 2, 3))
    return F.struct(_day_of(year, b, a).alias("day_first"), _day_of(year, a, b).alias("month_first"))


#: Days that a printed title may be off the day its link names.
TITLE_DAYS = 7


def report_day(text: Column, label_day: Column) -> Column:
    """Day of a trade report from its page text and the day its link names.

    A reading of the title that equals the link's day wins; else the title, day first, unless
    it is more than TITLE_DAYS off; then a spelled day in the text, then the link's day.
    """
    title = F.regexp_extract(text, r"Trade Summary\D{0,5}(\d{1,2}\.\d{1,2}\.\d{4})", 1)

    def choose(read: Column) -> Column:
        printed = F.coalesce(read["day_first"], read["month_first"])
        far = F.coalesce(F.abs(F.date_diff(printed, label_day)) > TITLE_DAYS, F.lit(False))
        agrees = F.coalesce((read["day_first"] == label_day) | (read["month_first"] == label_day), F.lit(False))
        return F.when(agrees | far, label_day).otherwise(printed)

    return F.coalesce(_let(either_order(title), choose), spelled(squeeze(text)), label_day)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def build_isin(prefix: str, tenor: Column, maturity: Column) -> Column:
    """Key of a bond (``LKB``, tenor in years) or bill (``LKA``, in days), check digit included."""
    month = F.char(F.lit(64) + F.month(maturity))
    body = F.concat(F.lit(prefix), F.lpad(tenor.cast("string"), 3, "0"), F.date_format(maturity, "yy"), month, F.date_format(maturity, "dd"))
    return F.concat(body, isin_check_digit(body).cast("string"))


def is_synthetic(key: Column) -> Column:
    return F.coalesce(key.startswith("SYN:"), F.lit(False))


def clean_number(text: Column) -> Column:
    """A number whose digits may be parted by blanks and commas; null for all else."""
    bare = F.regexp_replace(text, "[ ,]", "")
    return F.when(bare.rlike(r"^-?\d+(\.\d+)?$"), bare.try_cast("double"))


def strict_number(text: Column) -> Column:
    """A text that is a number throughout; commas may group its digits."""
    t = squeeze(text)
    return F.when(t.rlike(r"^\d[\d,]*(?:\.\d+)?$"), F.regexp_replace(t, ",", "").try_cast("double"))


def embedded_number(text: Column) -> Column:
    """The first number in a phrase."""
    return F.regexp_replace(F.nullif(F.regexp_extract(squeeze(text), r"\d[\d,]*(?:\.\d+)?", 0), F.lit("")), ",", "").try_cast("double")


def rupees_printed(text: Column) -> Column:
    """A figure of millions as whole rupees."""
    return rupees_from_millions(strict_number(text))


def month_days(text: Column) -> Column:
    """Coupon days printed as day and month, as sorted ``mm-dd`` without repeats; null if none."""
    found = F.regexp_extract_all(squeeze(text), F.lit(r"(\d{1,2}\s+[A-Za-z]+)"), F.lit(1))
    names = F.array(*[F.lit(m.lower()) for m in MONTHS])
    part = lambda x, k: F.regexp_extract(x, r"(\d{1,2})\s+([A-Za-z]+)", k)
    number = lambda x: F.array_position(names, F.lower(part(x, 2)))
    known = F.filter(found, lambda x: number(x) > 0)
    days = F.transform(known, lambda x: F.concat(F.lpad(number(x).cast("string"), 2, "0"), F.lit("-"), F.lpad(part(x, 1), 2, "0")))
    return F.when(F.size(days) > 0, F.array_join(F.array_sort(F.array_distinct(days)), ","))


def day_after(text: Column, phrase: str) -> Column:
    """The spelled day that follows a phrase, a weekday may stand between."""
    found = F.regexp_extract(text, rf"(?i)\Q{phrase}\E\s+(?:\w+day,?\s*)?(\d{{1,2}}\s+[A-Za-z]+\s+\d{{4}})", 1)
    return spelled(F.nullif(found, F.lit("")))

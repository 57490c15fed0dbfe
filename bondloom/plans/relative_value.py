"""Rolling rich/cheap signals of bonds and switches, and what they later gave back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.operators import switches
from bondloom.session import broadcast_if_small

# Fixed values of the signals.
ROWS, LEAST_ROWS, LEAST_SD, PAIR_YEARS = 60, 30, 0.5, 2.0
HORIZON_DAYS, SLACK_DAYS, THRESHOLDS, LEAST_EVENTS = 14, 4, (2.0, 3.0), 30

#: Slices that auctioned bonds meet in.
SLICES = 16


def rolling_z(df: DataFrame, keys: list[str], value: str, order: str = "obs_date") -> DataFrame:
    """mean, sd, count and z of ``value`` over the ROWS rows before its own, never with it.

    Running sums less their values ROWS back, so a row costs the same however long the frame
    is, in one sort. Values are a few hundred bp, far from where the difference of sums of
    squares would lose digits.
    """
    rows = Window.partitionBy(*keys).orderBy(order)
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    v = F.col(value).cast("double")
    # The three sums travel as one value, so each row is looked up twice, not six times.
    df = df.withColumns({"_n": F.count(v).over(upto), "_s": F.sum(v).over(upto), "_q": F.sum(v * v).over(upto)})
    sums = F.struct(F.col("_n").alias("n"), F.col("_s").alias("s"), F.col("_q").alias("q"))
    df = df.withColumns({"_to": F.lag(sums, 1).over(rows), "_from": F.lag(sums, ROWS + 1).over(rows)})
    past = lambda c: F.coalesce(F.col(f"_to.{c}"), F.lit(0)) - F.coalesce(F.col(f"_from.{c}"), F.lit(0))
    df = df.withColumns({"n_window": past("n"), "_ps": past("s"), "_pq": past("q")})
    enough = F.col("n_window") >= LEAST_ROWS
    mean = F.when(enough, F.col("_ps") / F.col("n_window"))
    var = (F.col("_pq") - F.col("_ps") * F.col("_ps") / F.col("n_window")) / (F.col("n_window") - 1)
    sd = F.when(enough, F.sqrt(F.greatest(var, F.lit(0.0))))
    df = df.withColumns({"mean_bp": mean, "sd_bp": sd}).drop("_n", "_s", "_q", "_to", "_from", "_ps", "_pq")
    gone = v - F.col("mean_bp")
    return df.withColumns({"dislocation_bp": gone, "zscore": F.when(F.col("sd_bp") > LEAST_SD, gone / F.col("sd_bp"))})


def bond_signals(residual: DataFrame) -> DataFrame:
    return rolling_z(residual.select("obs_date", "isin", "tau", "residual_bp"), ["isin"], "residual_bp")


def pair_bonds(residual: DataFrame, auctions: DataFrame) -> DataFrame:
    """(isin, id, tau, auctioned): each bond's number, median tenor, and whether it was ever
    auctioned. A row per bond of the whole history; the numbering sorts those few rows."""
    tau = residual.groupBy("isin").agg(F.percentile("tau", F.lit(0.5)).alias("tau"))
    sold = auctions.where("isin is not null").select("isin").distinct().withColumn("auctioned", F.lit(True))
    bonds = tau.join(sold, "isin", "left").withColumn("auctioned", F.coalesce("auctioned", F.lit(False)))
    return bonds.withColumn("id", F.row_number().over(Window.partitionBy().orderBy("isin")).cast("long"))


def _paired(tau_a: Column, tau_b: Column, sold_a: Column, sold_b: Column) -> Column:
    return (F.abs(tau_a - tau_b) <= PAIR_YEARS) | (sold_a & sold_b)


def pairs(bonds: DataFrame) -> DataFrame:
    """(isin_a, isin_b, tau_a, tau_b) of the bonds of ``pair_bonds`` whose tenors are near, or
    that were both auctioned. Near ones meet in tenor bands of PAIR_YEARS, auctioned ones in
    SLICES slices, so that they are not one task's."""
    band = F.floor(F.col("tau") / PAIR_YEARS)
    slot = F.pmod(F.hash("isin"), F.lit(SLICES))
    near = lambda bands: F.transform(bands, lambda k: F.concat(F.lit("near:"), k.cast("string")))
    sold = lambda slots: F.when(F.col("auctioned"), F.transform(slots, lambda k: F.concat(F.lit("sold:"), k.cast("string")))).otherwise(F.array().cast("array<string>"))
    side = lambda x, keys: bonds.select(*[F.col(c).alias(f"{c}_{x}") for c in ("isin", "tau", "auctioned")], F.explode(keys).alias("meet"))
    a = side("a", F.concat(near(F.array(band - 1, band, band + 1)), sold(F.array(slot))))
    b = side("b", F.concat(near(F.array(band)), sold(F.sequence(F.lit(0), F.lit(SLICES - 1)))))
    met = a.join(b, "meet").where(F.col("isin_a") < F.col("isin_b"))
    fits = _paired(*[F.col(f"{c}_{x}") for c in ("tau", "auctioned") for x in "ab"])
    return met.where(fits).select("isin_a", "isin_b", "tau_a", "tau_b").distinct()


#: The pair rule and the window of switches.
RULE = switches.Rule(ROWS, LEAST_ROWS, LEAST_SD, PAIR_YEARS)
#: What a scored switch has on each day.
DAILY = ("obs_date", "spread_bp", "zscore", "n_window")


def switch_series(residual: DataFrame, bonds: DataFrame, digits: int | None = None) -> DataFrame:
    """Scored spreads, a row for each ``pair`` number with an array for each of DAILY, on the days
    when both legs have a residual; ``named`` gives the bonds, ``daily`` a row for each day. With
    ``digits`` spread and score are rounded, halves away from zero."""

    def rounded(v: np.ndarray) -> np.ndarray:
        return v if digits is None else np.copysign(np.floor(np.abs(v) * 10**digits + 0.5), v) / 10**digits + 0.0

    def take(blocks: Iterator[switches.Scored]) -> Iterator[pa.RecordBatch]:
        for x in blocks:
            starts = np.flatnonzero(np.diff(x.at, prepend=-1))
            cuts = pa.array(np.append(starts, len(x.at)).astype("int32"))
            day = pa.array(x.day.astype("int32")).cast(pa.date32())
            columns = dict(zip(DAILY, (day, pa.array(rounded(x.spread)), pa.array(rounded(x.z)), pa.array(x.n.astype("int32")))))
            yield pa.RecordBatch.from_pydict({"pair": pa.array(x.pair()[starts])} | {c: pa.ListArray.from_arrays(cuts, v) for c, v in columns.items()})

    return switches.swept(residual, bonds, RULE, take, "pair long, obs_date array<date>, spread_bp array<double>, zscore array<double>, n_window array<int>")


def daily(series: DataFrame) -> DataFrame:
    """A row for each day of ``switch_series``, whatever its other columns."""
    day, *values = DAILY
    others = [c for c in series.columns if c not in DAILY]
    rows = series.select(*others, *values, F.posexplode(day).alias("_k", day))
    each = {c: F.get(c, F.col("_k")) for c in values}
    return rows.select(*others, day, *[(v.cast("long") if c == "n_window" else v).alias(c) for c, v in each.items()])


def switch_signals(residual: DataFrame, bonds: DataFrame, digits: int | None = None) -> DataFrame:
    """``switch_series`` by day."""
    return daily(switch_series(residual, bonds, digits))


def named(signals: DataFrame, bonds: DataFrame) -> DataFrame:
    """``signals`` with isin_a, isin_b and their tenors for the pair number."""
    few = broadcast_if_small(bonds)
    side = lambda x: few.select(F.col("id").alias(f"id_{x}"), F.col("isin").alias(f"isin_{x}"), F.col("tau").alias(f"tau_{x}"))
    ids = signals.withColumns({"id_a": F.shiftright("pair", 32), "id_b": F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))})
    return ids.join(side("a"), "id_a").join(side("b"), "id_b").drop("pair", "id_a", "id_b")


def forward_by_date(keys: list[str], value: str) -> Column:
    """Change to the first row at or up to SLACK_DAYS after ten business days ahead; null if
    none. From a weekday that is HORIZON_DAYS calendar days; a day of the weekend counts from
    the Friday before it."""
    day = F.unix_date("obs_date")
    rows = Window.partitionBy(*keys).orderBy(day)
    ahead = lambda days: F.first(value).over(rows.rangeBetween(days, days + SLACK_DAYS))
    weekday = F.weekday("obs_date")
    return F.when(weekday == 5, ahead(HORIZON_DAYS - 1)).when(weekday == 6, ahead(HORIZON_DAYS - 2)).otherwise(ahead(HORIZON_DAYS)) - F.col(value)


class Gains:
    """Number and sum of what fading a switch gained by the date of ``forward_by_date``, by threshold."""

    def __init__(self) -> None:
        self.n, self.total = [0] * len(THRESHOLDS), [0.0] * len(THRESHOLDS)

    def add(self, x: switches.Scored) -> None:
        far = np.flatnonzero(np.abs(x.z) >= min(THRESHOLDS))
        weekday = (x.day[far] + 3) % 7  # day 0 is a Thursday
        later, there = x.later(far, HORIZON_DAYS - np.maximum(weekday - 4, 0), SLACK_DAYS)
        gain = (-np.sign(x.z[far]) * (x.spread[later] - x.spread[far]))[there]
        size = np.abs(x.z[far])[there]
        for k, threshold in enumerate(THRESHOLDS):
            self.n[k] += int((size >= threshold).sum())
            self.total[k] += float(gain[size >= threshold].sum())

    def rows(self) -> dict[str, list]:
        return {"threshold": list(THRESHOLDS), "n": self.n, "total": self.total}


def captured(gains: DataFrame) -> DataFrame:
    """Average gain by threshold from the blocks' (threshold, n, total); null under LEAST_EVENTS events."""
    each = gains.groupBy("threshold").agg(F.sum("n").alias("n"), F.sum("total").alias("_t")).where("n > 0")
    return each.select("threshold", "n", F.when(F.col("n") >= LEAST_EVENTS, F.col("_t") / F.col("n")).alias("capture_bp"))


def switch_reversion(residual: DataFrame, bonds: DataFrame) -> DataFrame:
    """Average gain of fading a switch by threshold; null under LEAST_EVENTS events."""

    def take(blocks: Iterator[switches.Scored]) -> Iterator[pa.RecordBatch]:
        gains = Gains()
        for x in blocks:
            gains.add(x)
        yield pa.RecordBatch.from_pydict(gains.rows())

    return captured(switches.swept(residual, bonds, RULE, take, "threshold double, n long, total double"))


def switch_book(residual: DataFrame, bonds: DataFrame, dealt: DataFrame, top: int) -> DataFrame:
    """The ``top`` switches of each day by size of score, then by pair, whose legs are both in
    ``dealt`` (obs_date, isin): pair, obs_date, dislocation_bp, zscore, place. Beside them, on rows
    without a day, what ``captured`` takes, from the same pass over all pairs.

    A block sends on the ``top`` of its own pairs for each day, so a day's rows are few.
    """
    kinds = {"pair": "int64", "obs_date": "int32", "dislocation_bp": "float64", "zscore": "float64"}

    def highest(rows: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        if not rows:
            return {c: np.zeros(0, kind) for c, kind in kinds.items()}
        all_ = {c: np.concatenate([x[c] for x in rows]) for c in kinds}
        order = np.lexsort((all_["pair"], -np.abs(all_["zscore"]), all_["obs_date"]))
        day = all_["obs_date"][order]
        nth = np.arange(len(day)) - np.searchsorted(day, day)
        return {c: v[order[nth < top]] for c, v in all_.items()}

    def take(blocks: Iterator[switches.Scored]) -> Iterator[pa.RecordBatch]:
        gains, kept, size = Gains(), [], 0
        for x in blocks:
            gains.add(x)
            if x.marked is not None and x.marked.any():
                on = x.marked
                kept.append({"pair": x.pair()[on], "obs_date": x.day[on].astype("int32"), "dislocation_bp": x.gone[on], "zscore": x.z[on]})
                size += int(on.sum())
            if size > most:
                kept, size = [highest(kept)], 0
        rows, sums = highest(kept), gains.rows()
        n, m = len(rows["pair"]), len(sums["n"])
        made = {c: pa.concat_arrays([pa.array(v), pa.nulls(m, pa.array(v).type)]) for c, v in rows.items()}
        made["obs_date"] = made["obs_date"].cast(pa.date32())
        made |= {c: pa.array([None] * n + v, pa.int64() if c == "n" else pa.float64()) for c, v in sums.items()}
        yield pa.RecordBatch.from_pydict(made)

    most = 1 << 20  # rows that a block holds before it drops those behind
    schema = "pair long, obs_date date, dislocation_bp double, zscore double, threshold double, n long, total double"
    found = switches.swept(residual, bonds, RULE, take, schema, dealt)
    place = F.row_number().over(Window.partitionBy("obs_date").orderBy(F.desc(F.abs("zscore")), "pair"))
    return found.withColumn("place", place).where(F.col("obs_date").isNull() | (F.col("place") <= top))

"""Readings that cannot belong to their series: spikes, stuck values, impossible values.

The series is decomposed by the undecimated Haar wavelet. At a reading, the two level-1
translates give its differences to the reading before and after; a spike makes both large
with one sign, a lasting move only one of them. Level 2 does the same for two neighbouring
readings together. Coefficients are scaled by the series' own median of non-zero ones. A run
of zero details far longer than the series' usual runs is a stuck value.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.session import broadcast_if_small, checkpointed

#: Readings looked at on each side of one.
REACH = 5
SERIES = ["series"]


@dataclass(frozen=True)
class SpikeRules:
    """Thresholds. ``low``/``high`` bound possible readings (exclusive/inclusive)."""

    low: float = 1.0
    high: float = 30.0
    spike: float = 5.0
    #: Two spikes side by side look like a short move; only ones beyond any market move count.
    pair: float = 1.5
    floor: float = 0.02
    stuck: int = 6
    stuck_ratio: float = 4.0
    chunk_days: int = 256
    min_readings: int = 8


def _neighbours(df: DataFrame, parts: list[str]) -> DataFrame:
    w = Window.partitionBy(*parts).orderBy("day", "stamp", "seq")
    for k in range(1, REACH + 1):
        df = df.withColumn(f"b{k}", F.lag("x", k).over(w)).withColumn(f"a{k}", F.lead("x", k).over(w))
    return df


def _apart(x: Column, left: Column, right: Column, least: Column) -> Column:
    """Both Haar details of ``x`` reach ``least`` with one sign."""
    return F.coalesce(
        ((x - left >= least) & (x - right >= least)) | ((left - x >= least) & (right - x >= least)),
        F.lit(False),
    )


def faulty_readings(readings: DataFrame, rules: SpikeRules = SpikeRules()) -> DataFrame:
    """(tag, seq, fault) of the faulty rows of ``readings``.

    ``readings`` has series (any type), tag (int, told back; one per series), day (date),
    stamp (timestamp or null), value (double) and seq (long). Rows of one series, day, stamp
    and value are copies: they count once and are all reported. ``fault`` is ``impossible``,
    ``spike`` or ``stuck``; a run's first reading is not reported. Inside, a series goes by
    a 64-bit digest of its name, which keeps the sorted rows narrow.

    Nulls: rows with a null series, day, value or seq are left out, NaN counts as null.
    A series shorter than ``min_readings`` has no scale and only its impossible readings
    come out; the outer readings of a series need both neighbours to be spikes. Empty
    tables give no rows; further columns are ignored.

    A series is sorted in chunks of ``chunk_days`` and its chunk edges once more together,
    so that a hot series is spread over its chunks and every reading sees its neighbours.
    """
    raw = readings.where(F.col("series").isNotNull()).select(F.xxhash64("series").alias("series"), "tag", "day", F.coalesce(F.col("stamp"), F.timestamp_seconds(F.lit(0))).alias("stamp"), F.col("value").alias("x"), "seq")
    raw = raw.where(F.col("day").isNotNull() & F.col("seq").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x"))
    possible = (F.col("x") >= rules.low) & (F.col("x") <= rules.high)
    impossible = raw.where(~possible).select("tag", "seq", F.lit("impossible").alias("fault"))

    key = [*SERIES, "day", "stamp", "x"]
    raw = raw.where(possible).withColumn("chunk", F.floor(F.unix_date("day") / rules.chunk_days).cast("int"))
    one = raw.repartition(*SERIES, "chunk").groupBy(*SERIES, "chunk", "day", "stamp", "x").agg(F.min("seq").alias("seq"), F.first("tag").alias("tag"), F.count(F.lit(1)).alias("copies"))
    order = Window.partitionBy(*SERIES, "chunk").orderBy("day", "stamp", "seq")
    placed = one.withColumn("from_start", F.row_number().over(order))
    placed = placed.withColumn("to_end", F.count(F.lit(1)).over(Window.partitionBy(*SERIES, "chunk")) - F.col("from_start") + 1)
    near = lambda k: (F.col("from_start") <= k) | (F.col("to_end") <= k)
    inner = _neighbours(placed, [*SERIES, "chunk"]).where(~near(REACH))
    edges = _neighbours(placed.where(near(2 * REACH)), SERIES).where(near(REACH))
    ring = inner.unionByName(edges).drop("from_start", "to_end")

    detail = F.abs(F.col("x") - F.col("b1"))
    scale = ring.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n"),
        (F.percentile_approx(F.when(detail > 0, detail), F.lit(0.5), F.lit(2000)) * F.lit(1.4826)).alias("sd"),
    )
    # The checkpoints are small: a row per series, the few percent of readings that stand
    # out or repeat, and those found. All that follows starts from them.
    scale = checkpointed(scale)
    least = F.greatest(F.col("sd") * rules.spike, F.lit(rules.floor))
    alone = (F.col("n") >= rules.min_readings) & _apart(F.col("x"), F.col("b1"), F.col("a1"), least)
    moved = (F.col("n") >= rules.min_readings) & (F.greatest(detail, F.abs(F.col("x") - F.col("a1"))) >= rules.pair)
    zero = F.coalesce(F.col("x") == F.col("b1"), F.lit(False))
    repeats = zero | F.coalesce(F.col("x") == F.col("a1"), F.lit(False))
    ring = ring.join(broadcast_if_small(scale), SERIES).withColumns({"zero": zero, "repeats": repeats, "stands_out": F.coalesce(alone | moved, F.lit(False))})
    ring = checkpointed(ring.where("repeats or stands_out"))
    spikes = _spikes(ring.where("stands_out"), rules)
    stuck = _stuck(ring.where("repeats"), rules)
    found = checkpointed(spikes.unionByName(stuck))
    again = found.where("copies > 1").select(*key, "fault", F.col("seq").alias("first_seq"))
    copies = raw.join(broadcast_if_small(again), key).where("seq <> first_seq").select("tag", "seq", "fault")
    return impossible.unionByName(found.select("tag", "seq", "fault")).unionByName(copies)


def _spikes(df: DataFrame, rules: SpikeRules) -> DataFrame:
    least = F.greatest(F.col("sd") * rules.spike, F.lit(rules.floor))
    cells = [f"b{k}" for k in range(REACH, 0, -1)] + ["x"] + [f"a{k}" for k in range(1, REACH + 1)]
    df = df.select(*SERIES, "day", "stamp", "x", "b1", "a1", "tag", "seq", "copies", least.alias("least"), F.greatest(least, F.lit(rules.pair)).alias("wide"), F.array(*cells).alias("v"))

    def candidate(i: Column) -> Column:
        at = lambda k: F.get("v", i + k)
        two = lambda x, y, left, right: _apart(x, left, right, F.col("wide")) & _apart(y, left, right, F.col("wide"))
        # Level 2: this reading with the next, or with the one before.
        return _apart(at(0), at(-1), at(1), F.col("least")) | two(at(0), at(1), at(-1), at(2)) | two(at(0), at(-1), at(-2), at(1))

    # A sound reading between two spikes is apart from both: the nearest readings that are
    # no candidates themselves decide.
    df = df.withColumn("flags", F.transform(F.array(*[F.lit(i) for i in range(2, 9)]), candidate)).where(F.get("flags", F.lit(3)))
    sound = lambda k: F.when(~F.get("flags", F.lit(3 + k)), F.get("v", F.lit(REACH + k)))
    left = F.coalesce(sound(-1), sound(-2), sound(-3), F.col("b1"))
    right = F.coalesce(sound(1), sound(2), sound(3), F.col("a1"))
    return df.where(_apart(F.col("x"), left, right, F.col("least"))).select(*SERIES, "day", "stamp", "x", "tag", "seq", "copies", F.lit("spike").alias("fault"))


def _stuck(ring: DataFrame, rules: SpikeRules) -> DataFrame:
    place = F.struct("day", "stamp", "seq")
    runs = ring.select(*SERIES, "chunk", "day", "stamp", "x", "tag", "seq", "copies", "n", "zero")
    runs = runs.withColumn("begin", F.when(~F.col("zero"), place))
    # The run's begin: the last in this chunk, else the last of the chunks before.
    in_chunk = Window.partitionBy(*SERIES, "chunk").orderBy("day", "stamp", "seq").rowsBetween(Window.unboundedPreceding, 0)
    by_chunk = runs.groupBy(*SERIES, "chunk").agg(F.max("begin").alias("top"))
    before = Window.partitionBy(*SERIES).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_chunk.select(*SERIES, "chunk", F.max("top").over(before).alias("carried"))
    runs = runs.withColumn("own", F.max("begin").over(in_chunk)).join(carried, [*SERIES, "chunk"])
    runs = runs.select(*SERIES, "day", "stamp", "x", "tag", "seq", "copies", "n", "zero", F.coalesce("own", "carried").alias("begin"))
    lengths = runs.groupBy(*SERIES, "begin").agg(F.count(F.lit(1)).alias("length"), F.first("n").alias("n"))
    # The length of the run that the series' median reading is part of. Readings outside
    # the runs have length 1.
    kinds = lengths.groupBy(*SERIES, "length").agg(F.sum("length").alias("rows"), F.first("n").alias("n"))
    total = F.sum("rows").over(Window.partitionBy(*SERIES))
    upto = F.sum("rows").over(Window.partitionBy(*SERIES).orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    kinds = kinds.withColumn("upto", F.col("n") - total + upto)
    single = F.col("n") - total
    kinds = kinds.withColumn("usual", F.when(single * 2 >= F.col("n"), F.lit(1)).when(F.col("upto") * 2 >= F.col("n"), F.col("length")))
    usual = kinds.groupBy(*SERIES).agg(F.min("usual").alias("usual"))
    long_runs = lengths.where(F.col("length") >= rules.stuck).join(usual, SERIES)
    long_runs = long_runs.where(F.col("length") > F.col("usual") * rules.stuck_ratio).select(*SERIES, "begin")
    hit = runs.where("zero").join(long_runs, [*SERIES, "begin"])
    return hit.select(*SERIES, "day", "stamp", "x", "tag", "seq", "copies", F.lit("stuck").alias("fault"))

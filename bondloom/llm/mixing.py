"""Mixing sources to target shares of all tokens by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bondloom.llm.tokens import FOLDER, VOCABULARY, token_ids
from bondloom.session import checkpointed

#: Slices of the order in which a source's documents are ranked; only the slice that holds
#: the cut is sorted.
SLICES = 1 << 14
#: Bins of weights to a doubling.
BINS = 64


def sized(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None, folder: str = FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens, weight) of documents with an id and a source."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = [len(token_ids(t, folder, vocabulary)) for t in batch["t"]]
            yield batch.drop(columns="t").assign(n_tokens=pd.Series(sizes, dtype="int64", index=batch.index))

    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    slim = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), w.alias("weight"), F.col(text).alias("t"))
    slim = slim.where("doc_id is not null and source is not null and weight > 0")
    return slim.mapInPandas(measure, "doc_id long, source string, weight double, n_tokens long").where("n_tokens > 0")


def plan(sizes: DataFrame, targets: DataFrame, total: int | Column | None = None) -> DataFrame:
    """(source, tokens, goal, rate, repeats, target_share), a row per source.

    ``goal`` are the tokens asked of the source. Without ``total`` the mix is the largest that
    all sources can give at their shares; with it a source gives what its cap allows.
    A document of weight w is expected min(``repeats``, ``rate`` * w) times, and ``rate`` is such
    that the expected tokens come to the goal: documents whose weight would take them over the
    cap are certain at the cap, and the others share what is left. The rate is read from sums
    of bins of near weights, BINS to a doubling, so a source's documents are never sorted.
    """
    bins = sizes.withColumn("bin", F.floor(F.log2("weight") * BINS)).groupBy("source", "bin").agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("weight")).alias("w"), F.max("weight").alias("top"))
    have = bins.groupBy("source").agg(F.sum("t").alias("tokens"))
    asked = targets.select("source", "target_share", F.col("max_repeats").alias("repeats")).where("target_share > 0 and repeats > 0").dropDuplicates(["source"])
    both = checkpointed(asked.join(have, "source"))  # a row per source
    most = F.col("repeats") * F.col("tokens")
    limit = both.agg(F.min(most / F.col("target_share")).alias("limit")).scalar() if total is None else F.lit(total) if isinstance(total, int) else total
    both = both.withColumn("goal", F.least(most.cast("double"), limit * F.col("target_share")))
    heavier = Window.partitionBy("source").orderBy(F.desc("bin"))
    filled = bins.join(F.broadcast(both.select("source", "goal", "repeats")), "source")
    filled = filled.withColumns({"above": F.sum("t").over(heavier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("t"), "rest": F.sum("w").over(heavier.rowsBetween(0, Window.unboundedFollowing))})
    rate = (F.col("goal") - F.col("repeats") * F.col("above")) / F.col("rest")
    fits = rate * F.col("top") <= F.col("repeats") * (1 + 1e-9)
    rates = filled.groupBy("source").agg(F.max_by(F.when(fits, rate), F.when(fits, F.col("bin"))).alias("rate"))
    return both.join(rates, "source").select("source", "target_share", "repeats", "tokens", "goal", "rate")


def draw(sizes: DataFrame, targets: DataFrame, *, seed: int = 0, total: int | Column | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of the drawn documents.

    Each document first gets its certain whole copies. The rest, its inclusion probability,
    ranks it by random odds over inclusion odds, and documents are taken in that order
    while the source's tokens stay nearest its goal. The random number is a digest of seed
    and id, so a lost task draws the same again. No document exceeds its source's repeats.

    The size that is fixed is that of tokens, as that is what shares are measured in.
    The order is cut without sorting a source: sums of SLICES slices find the one holding
    the cut, and only that one is sorted. Sources without a target, or with none of their
    documents at hand, give nothing. Repeated ids are separate documents of one rank.
    """
    plans = checkpointed(plan(sizes, targets, total))  # like targets a few rows, so it is broadcast
    each = sizes.join(F.broadcast(plans.select("source", "goal", "rate", "repeats")), "source")
    # No bin leaves room under the cap where all of a source is asked for at its cap.
    expected = F.coalesce(F.least(F.col("repeats").cast("double"), F.greatest(F.lit(0.0), F.col("rate")) * F.col("weight")), F.col("repeats").cast("double"))
    # A hair's breadth under a whole number is that number.
    certain = F.floor(expected + 1e-9)
    each = each.withColumns({"certain": certain, "chance": F.greatest(F.lit(0.0), expected - certain)})
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    odds = lambda p: p / (1 - p)
    ratio = odds(u) / odds(F.col("chance"))
    each = each.withColumn("rank", F.when(F.col("chance") > 0, ratio / (1 + ratio)))
    each = each.withColumn("slice", F.least(F.lit(SLICES - 1), F.floor(F.col("rank") * SLICES)))

    sure = each.groupBy("source").agg(F.sum(F.col("certain") * F.col("n_tokens")).alias("sure"))
    slices = each.where("slice is not null").groupBy("source", "slice").agg(F.sum("n_tokens").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    slices = slices.withColumn("upto", upto).join(sure, "source").join(plans.select("source", "goal"), "source")
    left = F.col("goal") - F.col("sure")
    slices = checkpointed(slices.select("source", "slice", (F.col("upto") <= left).alias("whole"), (left - (F.col("upto") - F.col("size"))).alias("room")).where("whole or room > 0"))

    each = each.join(slices, ["source", "slice"], "left")
    inside = F.coalesce(F.col("whole"), F.lit(False))
    cut = each.where(F.col("whole") == False)  # noqa: E712
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "n_tokens")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # The last document is taken if that brings the source nearer its goal.
    cut = cut.withColumn("taken", before + F.col("n_tokens") / 2 <= F.col("room"))
    rest = each.where(F.coalesce(F.col("whole"), F.lit(True))).withColumn("taken", inside)
    drawn = rest.unionByName(cut).select("doc_id", "source", "n_tokens", (F.col("certain") + F.col("taken").cast("long")).alias("copies"))
    return drawn.where("copies > 0")


def shares(sizes: DataFrame, targets: DataFrame, drawn: DataFrame) -> DataFrame:
    """A row per source of ``targets``: what was asked, drawn and reached."""
    have = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
    got = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("drawn"), F.sum(F.col("copies") * F.col("n_tokens")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    rows = targets.select("source", "target_share", "max_repeats").join(have, "source", "left").join(got, "source", "left")
    rows = rows.fillna(0, ["documents", "tokens", "drawn", "mixed_tokens", "most_copies"])
    # One row per source: a window over all of them is a few rows.
    share = F.try_divide(F.col("mixed_tokens"), F.sum("mixed_tokens").over(Window.partitionBy()))
    return rows.withColumn("share", F.coalesce(share, F.lit(0.0)))

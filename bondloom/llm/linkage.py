"""Soft-logic linkage of records that share no key.

Every candidate pair is a variable between 0 and 1. Each weighted rule is a squared hinge:
a rule that the evidence supports pulls the variable up, one that it contradicts pulls it
down. Exclusivity: a record's variables sum to one at most. Transitivity: of two records that
print the same thing, what links one links the other; these rules over all pairs of a group's
records, each by one over the group's size, add up to the distance from the group's mean, so
no pair is written out. The sum is convex and has one minimum.

No rule reaches over two groups, so groups are solved side by side, each by the alternating
direction method of multipliers: one step minimises the rules, one puts every record back into
its bounds, until both agree. Records of a group with equal evidence have equal values; they
are one variable that counts as often as there are such records, so a hot group is as small as
its evidence is various.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Step of the method, the largest difference left between its two steps, and rounds at most.
RHO, TOLERANCE, ROUNDS = 10.0, 1e-6, 20_000


def _bounded(v: np.ndarray) -> np.ndarray:
    """Each row's nearest point with no part under 0 and a sum of 1 at most."""
    clipped = np.maximum(v, 0)
    over = clipped.sum(axis=1) > 1
    if over.any():
        rows = v[over]
        ordered = -np.sort(-rows, axis=1)
        spare = (np.cumsum(ordered, axis=1) - 1) / np.arange(1, rows.shape[1] + 1)
        last = (ordered > spare).sum(axis=1) - 1
        clipped[over] = np.maximum(rows - spare[np.arange(len(rows)), last][:, None], 0)
    return clipped


def solve_group(m: np.ndarray, w: np.ndarray, n: np.ndarray, transitivity: float, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """(values, support, rounds used) of a group: rows are kinds of records, columns entities.

    ``m`` is what a pair's rules ask for, ``w`` the sum of their weights, 0 where a record has
    no such pair; ``n`` are the records of a kind. Support is what the rules and the group ask
    for, exclusivity aside.
    """
    held = w > 0
    many = np.where(held, n[:, None], 0)
    whole = many.sum(axis=0)
    gain = np.where(held, 1 / (2 * w + 2 * transitivity + RHO), 0)
    x, u, y = np.where(held, m, 0), np.zeros_like(m), np.zeros(m.shape[1])
    x = _bounded(x)
    used = rounds
    for k in range(rounds):
        own = np.where(held, (2 * w * m + RHO * (x - u)) * gain, 0)
        # The group's mean and its records' values, both at their least together.
        y = (many * own).sum(axis=0) / (whole - 2 * transitivity * (many * gain).sum(axis=0))
        z = np.where(held, own + 2 * transitivity * y * gain, 0)
        before, x = x, np.where(held, _bounded(np.where(held, z + u, -1e9)), 0)
        u += z - x
        if max(np.abs(z - x).max(), np.abs(x - before).max()) < tolerance:
            used = k + 1
            break
    support = np.where(held, (w * m + transitivity * y) / np.where(held, w + transitivity, 1), 0)
    return x, support, used


def soft_links(pairs: DataFrame, *, record: str, entity: str, alike: str, pull: str, weight: str, transitivity: float = 1.0, prior: float = 0.5) -> DataFrame:
    """(record, entity, confidence, support, rounds) of the candidate ``pairs``.

    ``pull`` is the weighted mean of what the pair's rules ask for, ``weight`` the sum of
    their weights: squared hinges on one variable add up to that. ``prior`` weighs the rule
    that a pair is no match. Records with equal ``alike`` form a group; null: a record alone.

    Repeated pairs count once; rows with a null record or entity are left out; an empty table
    gives no rows. Only named columns are read. A record's candidates are gathered, which the
    search for them bounds, and the different ones of a group, not its records.
    """
    rows = pairs.select(F.col(record).alias("r"), F.col(entity).cast("string").alias("e"), F.col(alike).cast("string").alias("g"), F.col(pull).cast("double").alias("m"), F.col(weight).cast("double").alias("w"))
    rows = rows.dropna(subset=["r", "e", "m", "w"]).groupBy("r", "e").agg(F.min("g").alias("g"), F.max(F.struct("m", "w")).alias("b"))
    asked = F.col("b.w") + prior
    evidence = F.struct("e", F.round(F.col("b.w") * F.col("b.m") / asked, 9).alias("m"), F.round(asked, 9).alias("w"))
    records = rows.groupBy("r").agg(F.min("g").alias("g"), F.sort_array(F.collect_list(evidence)).alias("said"))
    records = records.withColumn("kind", F.sha2(F.to_json("said"), 256)).withColumn("g", F.coalesce(F.concat(F.lit("g:"), "g"), F.concat(F.lit("k:"), "kind")))
    kinds = records.groupBy("g", "kind").agg(F.count(F.lit(1)).alias("n"), F.first("said").alias("said"))
    # Solving costs far more than its few bytes tell, so groups are spread by number, not size.
    spread = kinds.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g")
    groups = spread.groupBy("g").agg(F.collect_list(F.struct("kind", "n", "said")).alias("kinds"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, members in zip(batch["g"], batch["kinds"]):
                names = sorted({s["e"] for k in members for s in k["said"]})
                place = {e: i for i, e in enumerate(names)}
                m, w = np.zeros((len(members), len(names))), np.zeros((len(members), len(names)))
                for i, k in enumerate(members):
                    for s in k["said"]:
                        m[i, place[s["e"]]], w[i, place[s["e"]]] = s["m"], s["w"]
                z, support, used = solve_group(m, w, np.array([k["n"] for k in members], dtype=float), transitivity)
                out += [(g, k["kind"], s["e"], z[i, place[s["e"]]], support[i, place[s["e"]]], used) for i, k in enumerate(members) for s in k["said"]]
            yield pd.DataFrame(out, columns=["g", "kind", "e", "z", "support", "rounds"])

    solved = groups.mapInPandas(solve, "g string, kind string, e string, z double, support double, rounds int")
    met = records.select("r", "g", "kind").join(solved, ["g", "kind"])
    return met.select(F.col("r").alias(record), F.col("e").alias(entity), F.col("z").alias("confidence"), "support", "rounds")


def best_links(links: DataFrame, *, record: str, entity: str, least: float = 0.5, margin: float = 0.02) -> DataFrame:
    """The entity of greatest confidence for each record, if its ``support`` reaches ``least``
    and no rival comes within ``margin``: rivals share one match, so their values fall, but
    not what speaks for them. Equal rivals leave the record unlinked."""
    c = F.col("confidence")
    order = Window.partitionBy(record).orderBy(F.desc(c), entity)  # a record's candidates
    ranked = links.withColumns({"_place": F.row_number().over(order), "_second": F.lead(c).over(order)}).where("_place = 1")
    good = (F.col("support") >= least) & (c - F.coalesce("_second", F.lit(0.0)) >= margin)
    return ranked.where(good).select(F.col(entity), record, c.alias("confidence"))

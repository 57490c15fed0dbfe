"""Attributes of an entity as they were known when an event happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days between two snapshots; also the bound on the changes replayed for an event.
PERIOD_DAYS = 32


def as_known(
    events: DataFrame,
    facts: DataFrame,
    *,
    entity: str,
    event_day: str,
    fact_day: str,
    known_day: str,
    fact_id: str,
    event_id: str,
    carry: Sequence[str] = (),
    period_days: int = PERIOD_DAYS,
) -> DataFrame:
    """(event_id, fact_id, *carry): the fact in force for each event, as then known.

    A fact may serve an event when its ``fact_day`` and its ``known_day`` are not after
    the event; of those the greatest (fact_day, known_day, fact_id) holds. So a fact
    enters the state on the later of its two days, and the state only ever rises.

    Change log: the greatest fact entering per entity and day, at most ``period_days``
    in a period. Snapshot: the state at each period's start, for the periods that have
    events or changes. An event joins its (entity, period) snapshot and replays the
    changes of that period up to its own day.

    Events without a fact are left out, as are rows with a null entity, day or id.
    Repeated events are each answered; of repeated facts the greatest id holds. Empty
    tables give no rows. Only named columns are read, so further columns may clash.
    """
    period = lambda c: F.floor(F.unix_date(c) / period_days).cast("int")
    rank = F.struct(F.col(fact_day).cast("date").alias("a"), F.col(known_day).cast("date").alias("k"), F.col(fact_id).alias("id"), F.struct(F.lit(0).alias("_"), *carry).alias("x"))
    log = facts.select(F.col(entity).alias("_e"), rank.alias("_f")).where("_e is not null and _f.a is not null and _f.k is not null and _f.id is not null")
    log = log.groupBy("_e", F.greatest("_f.a", "_f.k").alias("_day")).agg(F.max("_f").alias("_f"))
    log = log.groupBy("_e", period("_day").alias("_p")).agg(F.collect_list(F.struct("_day", "_f")).alias("_log"), F.max("_f").alias("_top"))

    asks = events.select(F.col(entity).alias("_e"), F.col(event_day).cast("date").alias("_d"), F.col(event_id).alias("_id")).dropna()
    asks = asks.withColumn("_p", period("_d"))
    none = log.select("_log", "_top").schema
    wanted = asks.select("_e", "_p").distinct()
    for field in none.fields:
        wanted = wanted.withColumn(field.name, F.lit(None).cast(field.dataType))
    slots = log.unionByName(wanted).groupBy("_e", "_p").agg(F.first("_log", True).alias("_log"), F.first("_top", True).alias("_top"))
    before = Window.partitionBy("_e").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    snapshots = slots.withColumn("_state", F.max("_top").over(before)).where("_state is not null or _log is not null").drop("_top")

    joined = asks.join(snapshots, ["_e", "_p"])
    replay = F.array_max(F.transform(F.filter("_log", lambda c: c["_day"] <= F.col("_d")), lambda c: c["_f"]))
    state = joined.select("_id", F.greatest("_state", replay).alias("_f")).where("_f is not null")
    return state.select(F.col("_id").alias(event_id), F.col("_f.id").alias(fact_id), *[F.col(f"_f.x.{c}").alias(c) for c in carry])

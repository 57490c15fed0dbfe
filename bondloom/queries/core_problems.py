"""Queries of the general data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.operators.rolling import trailing_totals
from bondloom.operators.spikes import faulty_readings
from bondloom.session import table


#: Tags of the readings: table and column.
READINGS = (("observations", "bid_yield"), ("observations", "mid_yield"), ("trade_summary", "wavg_yield"))


def yield_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yield readings of both tables in long form, for ``faulty_readings``."""
    two = F.explode(F.array(*[F.struct(F.lit(k).alias("tag"), F.col(READINGS[k][1]).alias("value")) for k in (0, 1)])).alias("r")
    quotes = table(spark, sf_dir, "observations").where("isin is not null and (bid_yield is not null or mid_yield is not null)")
    quotes = quotes.select("isin", "source", F.col("obs_date").alias("day"), F.col("stamped_at").alias("stamp"), F.col("obs_seq").alias("seq"), two).where("r.value is not null")
    # Amended rows carry another print time, so a trade reading is known by its day alone.
    trades = table(spark, sf_dir, "trade_summary").where("wavg_yield is not null and isin is not null")
    trades = trades.select("isin", F.lit(None).cast("string").alias("source"), F.col("obs_date").alias("day"), F.lit(None).cast("timestamp").alias("stamp"), F.col("trade_seq").alias("seq"), F.struct(F.lit(2).alias("tag"), F.col("wavg_yield").alias("value")).alias("r"))
    return quotes.unionByName(trades).select(F.struct("isin", "source", "r.tag").alias("series"), "r.tag", "day", "stamp", "r.value", "seq")


def _faults(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    found = faulty_readings(yield_readings(spark, sf_dir))
    found = found.where(F.col("fault").isin(*kinds)) if kinds else found
    name = lambda k: F.get(F.array(*[F.lit(r[k]) for r in READINGS]), F.col("tag"))
    return found.select(name(0).alias("table_name"), F.col("seq").alias("row_seq"), name(1).alias("reading"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faults(spark, sf_dir)


def p1_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faults(spark, sf_dir, "impossible")


def p1_stuck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faults(spark, sf_dir, "stuck")


def p3_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trailing_totals(table(spark, sf_dir, "trade_summary"), "isin", "obs_date", "trade_seq", ["volume_lkr", "n_trades"])


QUERIES = {"p1_found": p1_found, "p1_impossible": p1_impossible, "p1_stuck": p1_stuck, "p3_trailing": p3_trailing}

_READINGS = """with r as (
  select 'observations' table_name, 'bid_yield' reading, isin, source, obs_date d, coalesce(stamped_at, timestamp '1970-01-01') st, obs_seq row_seq, bid_yield x from observations
  union all select 'observations', 'mid_yield', isin, source, obs_date, coalesce(stamped_at, timestamp '1970-01-01'), obs_seq, mid_yield from observations
  union all select 'trade_summary', 'wavg_yield', isin, null, obs_date, timestamp '1970-01-01', trade_seq, wavg_yield from trade_summary),
v as (select * from r where isin is not null and d is not null and x is not null and not isnan(x))"""
SQL = {
    "p1_impossible": f"{_READINGS} select table_name, row_seq, reading from v where x < 1 or x > 30",
    # A run is stuck at 6 readings and more, and over 4 times the run that the median reading is in.
    "p1_stuck": f"""{_READINGS}, u as (select table_name, reading, isin, source, d, st, x, min(row_seq) seq from v where x between 1 and 30 group by all),
z as (select *, coalesce(x = lag(x) over w, false) zero from u window w as (partition by reading, isin, source order by d, st, seq)),
g as (select *, sum(case when zero then 0 else 1 end) over (partition by reading, isin, source order by d, st, seq) run from z),
l as (select reading, isin, source, run, count(*) len from g group by 1, 2, 3, 4),
c as (select *, sum(len) over (partition by reading, isin, source order by len range unbounded preceding) upto, sum(len) over (partition by reading, isin, source) n from l),
k as (select reading, isin, source, min(len) usual from c where upto * 2 >= n group by 1, 2, 3),
h as (select g.* from g join l on g.reading = l.reading and g.isin = l.isin and g.source is not distinct from l.source and g.run = l.run join k on g.reading = k.reading and g.isin = k.isin and g.source is not distinct from k.source where zero and len >= 6 and len > usual * 4)
select v.table_name, v.row_seq, v.reading from v join h on v.reading = h.reading and v.isin = h.isin and v.source is not distinct from h.source and v.d = h.d and v.st = h.st and v.x = h.x""",
    "p3_trailing": """
with valid as (select isin, obs_date, arg_max(coalesce(volume_lkr, 0), trade_seq) v, arg_max(coalesce(n_trades, 0), trade_seq) t
  from trade_summary where isin is not null and obs_date is not null group by 1, 2),
cal as (select isin, cast(unnest(generate_series(min(obs_date), max(obs_date), interval 1 day)) as date) obs_date from valid group by 1),
daily as (select isin, obs_date, coalesce(v, 0) v, coalesce(t, 0) t from cal left join valid using (isin, obs_date)),
sums as (select isin, obs_date,
  sum(v) over w7 a, sum(v) over w30 b, sum(t) over w7 c, sum(t) over w30 d from daily
  window w7 as (partition by isin order by obs_date rows 6 preceding), w30 as (partition by isin order by obs_date rows 29 preceding))
select isin, obs_date, cast(a as bigint) volume_lkr_sum_7d, cast(a as double) / 7 volume_lkr_mean_7d, cast(b as bigint) volume_lkr_sum_30d, cast(b as double) / 30 volume_lkr_mean_30d,
  cast(c as bigint) n_trades_sum_7d, cast(c as double) / 7 n_trades_mean_7d, cast(d as bigint) n_trades_sum_30d, cast(d as double) / 30 n_trades_mean_30d from sums""",
}

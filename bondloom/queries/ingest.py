"""Queries of the codecs and state reductions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bondloom.functions import codecs
from bondloom.plans import curve
from bondloom.queries.sql import BASE
from bondloom.session import table
from bondloom.sources import state
from bondloom.streaming.update import late_days


def isin_codec(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "observations").select("isin").union(table(spark, d, "trade_summary").select("isin")).where("isin is not null").distinct()
    digit = F.when(F.length("isin") == 12, codecs.isin_check_digit(F.substring("isin", 1, 11)))
    return keys.select("isin", digit.alias("check_digit"), codecs.isin_maturity(F.col("isin")).alias("maturity"), codecs.isin_tenor(F.col("isin")).alias("tenor"))


def label_normalise(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bonds").where("series_label is not null")
    label = F.col("series_label")
    return b.select("isin", codecs.canonical_label(label).alias("label"), F.size(codecs.steps(label)).alias("n_steps"), codecs.without_letter(label).alias("loose"))


def date_parsers(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("maturity_text")
    return table(spark, d, "quote_lines").select("line_key", codecs.day_first(t).alias("day_first"), codecs.spelled(t).alias("spelled"), F.when(t.rlike("^[0-9]{5}$"), codecs.serial_day(t)).alias("serial"), codecs.squeeze(t).alias("squeezed"))


def money_percent(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "trade_summary").where("volume_lkr is not null")
    return t.select("trade_seq", codecs.rupees_from_millions(F.col("volume_lkr") / 1e6).alias("rupees"), codecs.percent(F.col("wavg_yield") / 100).alias("pct"))


def synthetic_keys(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "bonds")
    return b.select("isin", codecs.synthetic_key(F.col("maturity_date"), F.col("coupon_pct")).alias("key"))


def resolve_isin(spark: SparkSession, d: str) -> DataFrame:
    lines = state.printed_quotes(table(spark, d, "quote_lines"))
    return state.resolve_isin(lines, table(spark, d, "bonds")).select("line_key", "isin", "method")


def admissible_quotes(spark: SparkSession, d: str) -> DataFrame:
    return state.admissible(state.printed_quotes(table(spark, d, "quote_lines"))).select("line_key", "label", "coupon")


def merge_observations(spark: SparkSession, d: str) -> DataFrame:
    return state.merge_observations(table(spark, d, "observations"))


def latest_trades(spark: SparkSession, d: str) -> DataFrame:
    return state.replace_rows(table(spark, d, "trade_summary"), ["obs_date", "isin"], "trade_seq", ["trade_seq", "wavg_yield", "volume_lkr", "n_trades"])


def latest_auctions(spark: SparkSession, d: str) -> DataFrame:
    return state.replace_rows(table(spark, d, "auctions"), ["auction_date", "isin", "kind"], "auction_seq", ["auction_seq", "way_pct", "offered_lkr", "bids_lkr", "accepted_lkr"])


def first_known_auction(spark: SparkSession, d: str) -> DataFrame:
    return state.first_known(table(spark, d, "auctions"), ["isin"], "auction_seq", ["accrued_per_100", "way_pct", "accepted_lkr"])


def last_known_trade(spark: SparkSession, d: str) -> DataFrame:
    return state.last_known(table(spark, d, "trade_summary"), ["isin"], "trade_seq", ["wavg_yield", "volume_lkr", "n_trades"])


def cleared_reparse(spark: SparkSession, d: str) -> DataFrame:
    rows = state.cleared(table(spark, d, "trade_summary").where("raw_ref is not null"), "raw_ref", "ingested_at")
    return rows.groupBy("raw_ref").agg(F.count(F.lit(1)).alias("n"), F.max("trade_seq").alias("last_seq"))


def refit_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Days whose trades came after the first delivery: checked then, counted now."""
    trades = curve.usable_trades(spark, d)
    first = table(spark, d, "trade_summary").where("security_type = 'TBond' and wavg_yield is not null and ingested_at < date_add(obs_date, 3)")
    checked = first.groupBy("obs_date").agg(F.count_distinct("isin").alias("n_trades"))
    days = curve.fits(curve.usable_quotes(spark, d)).select("obs_date").join(checked, "obs_date", "left")
    return late_days(days, trades)


def bond_history(spark: SparkSession, d: str) -> DataFrame:
    """Quotes and trades of every bond side by side, volumes in millions."""
    quotes = curve.valid_quotes(spark, d).select("obs_date", "isin", "bid", "offer")
    trades = curve.valid_trades(spark, d).select("obs_date", "isin", F.col("wavg_yield").alias("traded"), F.round(F.col("volume_lkr") / 1e6, 1).alias("traded_mn"))
    return quotes.join(trades, ["obs_date", "isin"], "full")


def _bond_arrivals(spark: SparkSession, d: str) -> DataFrame:
    """What three sources tell of bonds, in the order of ingest: results, trades, quotes."""
    auctions = table(spark, d, "auctions").select("isin", F.col("auction_seq").alias("ingest_seq"), F.col("auction_date").alias("first_seen_date"), codecs.isin_maturity(F.col("isin")).alias("maturity_date"), codecs.isin_tenor(F.col("isin")).alias("tenor_years"))
    trades = table(spark, d, "trade_summary").where("isin like 'LKB%'").select("isin", (F.col("trade_seq") + 10**12).alias("ingest_seq"), F.col("obs_date").alias("first_seen_date"), codecs.isin_maturity(F.col("isin")).alias("maturity_date"), codecs.isin_tenor(F.col("isin")).alias("tenor_years"))
    sheet = table(spark, d, "bonds").select("isin", F.lit(2 * 10**12).alias("ingest_seq"), "first_seen_date", "maturity_date", "tenor_years", "coupon_pct", "series_label", F.coalesce("notes", F.when(F.month("maturity_date") > 6, "12%9%2027A")).alias("notes"))
    return auctions.unionByName(trades, allowMissingColumns=True).unionByName(sheet, allowMissingColumns=True)


def merge_bonds(spark: SparkSession, d: str) -> DataFrame:
    return state.merge_bonds(_bond_arrivals(spark, d))


def auction_observations(spark: SparkSession, d: str) -> DataFrame:
    return state.auction_observations(table(spark, d, "auctions"))


def cleared_days(spark: SparkSession, d: str) -> DataFrame:
    """Volumes by the latest parse of their day."""
    rows = table(spark, d, "observations").where("source = 'pdmo_daily' and volume_lkr is not null").select("obs_date", "isin", "volume_lkr", "obs_seq", F.col("ingested_at").cast("date").alias("parsed"))
    return state.cleared_days(rows, "obs_date", "parsed").select("obs_date", "isin", "volume_lkr", "obs_seq")


def latest_file_state(spark: SparkSession, d: str) -> DataFrame:
    """Records of files from partial updates: each field as it was last set."""
    t = table(spark, d, "trade_summary").where("raw_ref is not null").withColumn("url", F.col("raw_ref"))
    landed = t.select("url", F.col("trade_seq").alias("seq"), F.col("ingested_at").cast("date").alias("posted_date"), F.col("security_type").alias("file_type"))
    parsed = t.select("url", (F.col("trade_seq") + 1).alias("seq"), F.when(F.col("wavg_yield").isNotNull(), F.col("obs_date")).alias("report_date"), F.when(F.col("wavg_yield").isNull(), "failed").otherwise("ok").alias("parse_status"))
    both = landed.unionByName(parsed, allowMissingColumns=True)
    return state.last_known(both, ["url"], "seq", ["posted_date", "file_type", "report_date", "parse_status"])


def resolution_tally(spark: SparkSession, d: str) -> DataFrame:
    return resolve_isin(spark, d).groupBy("method").agg(F.count(F.lit(1)).alias("n"))


def curve_coverage(spark: SparkSession, d: str) -> DataFrame:
    f = curve.fits(curve.usable_quotes(spark, d))
    return f.agg(F.count(F.lit(1)).alias("days"), F.min("obs_date").alias("first"), F.max("obs_date").alias("last"))


QUERIES = {f.__name__: f for f in (
    isin_codec, label_normalise, date_parsers, money_percent, synthetic_keys, resolve_isin, admissible_quotes, merge_observations, latest_trades,
    latest_auctions, first_known_auction, last_known_trade, cleared_reparse, refit_candidates, bond_history,
    merge_bonds, auction_observations, cleared_days, latest_file_state, resolution_tally, curve_coverage,
)}

_LABEL = r"""case when regexp_extract(cl, '%(\d{4})([A-Z]?)$', 1) <> '' then
 array_to_string(list_transform(regexp_extract_all(cl, '(\d+(?:\.\d+)?)\s*%', 1), lambda x: printf('%.2f', cast(x as double))), '%') || '%' || regexp_extract(cl, '%(\d{4})([A-Z]?)$', 1) || regexp_extract(cl, '%(\d{4})([A-Z]?)$', 2) end"""
_STEPS = r"len(regexp_extract_all({}, '(\d+(?:\.\d+)?)\s*%', 1))"
_DAY_FIRST = r"""try_cast(case when regexp_matches(regexp_replace(maturity_text, '\s+', '', 'g'), '\d{1,2}\.\d{1,2}\.\d{4}') then
 regexp_extract(regexp_replace(maturity_text, '\s+', '', 'g'), '(\d{1,2})\.(\d{1,2})\.(\d{4})', 3) || '-' || lpad(regexp_extract(regexp_replace(maturity_text, '\s+', '', 'g'), '(\d{1,2})\.(\d{1,2})\.(\d{4})', 2), 2, '0')
 || '-' || lpad(regexp_extract(regexp_replace(maturity_text, '\s+', '', 'g'), '(\d{1,2})\.(\d{1,2})\.(\d{4})', 1), 2, '0') end as date)"""
_ISO = r"case when regexp_matches(maturity_text, '^\d{4}-\d\d-\d\d$') then try_cast(maturity_text as date) end"
_LINES = rf"""with c as (select *, regexp_replace(printed_label, '[\s''’"]', '', 'g') cl from quote_lines),
l as (select line_key, {_LABEL} as label, coalesce({_ISO}, {_DAY_FIRST}) as maturity, coupon_pct coupon, bid_yield, offer_yield from c)"""
_RESOLVED = rf"""{_LINES}, b as (select * from bonds where isin like 'LKB%'),
e as (select series_label, max(isin) ex from b where series_label is not null group by 1),
o as (select regexp_replace(series_label, '[A-Z]+$', '') lo, max(isin) one from b where series_label is not null group by 1 having count(distinct isin) = 1),
m as (select line_key, max(b.isin) bd from l join b on b.maturity_date = l.maturity and (b.coupon_pct is null or coupon is null or abs(b.coupon_pct - coupon) < 0.005e0) group by 1 having count(*) = 1),
f as (select l.line_key, ex, one, bd, case when {_STEPS.format('label')} = 1 and coupon is not null and maturity is not null and (bid_yield - offer_yield) * 100 > 0 and (bid_yield - offer_yield) * 100 <= 50 then printf('SYN:%s:%.3f', strftime(maturity, '%Y-%m-%d'), coupon) end syn
from l left join e on e.series_label = l.label left join o on o.lo = regexp_replace(l.label, '[A-Z]+$', '') left join m on m.line_key = l.line_key),
rs as (select line_key, coalesce(ex, one, bd, syn) isin, case when ex is not null then 'label' when one is not null then 'label-no-letter' when bd is not null then 'maturity+coupon' when syn is not null then 'synthetic' else 'unresolved' end as method from f)"""
_STEPS_OF = r"coalesce(len(regexp_extract_all({}, '(\d+(?:\.\d+)?)\s*%', 1)), 0)"

SQL = {
    "curve_coverage": f"{BASE} select count(*) as days, min(obs_date) as first, max(obs_date) as last from fit",
    "merge_bonds": rf"""
with a as (select isin, auction_date f from auctions where isin is not null union all select isin, obs_date from trade_summary where isin like 'LKB%' union all select isin, first_seen_date from bonds),
g as (select isin, min(f) first_seen_date, max(isin in (select isin from auctions) or isin in (select isin from trade_summary)) seen from a group by 1),
n as (select *, coalesce(notes, case when month(maturity_date) > 6 then '12%9%2027A' end) nt from bonds)
select g.isin, n.coupon_pct, case when seen then make_date(2000 + cast(substr(g.isin, 7, 2) as int), ascii(substr(g.isin, 9, 1)) - 64, cast(substr(g.isin, 10, 2) as int)) else n.maturity_date end maturity_date,
  case when seen then cast(substr(g.isin, 4, 3) as int) else n.tenor_years end tenor_years, case when {_STEPS_OF.format('nt')} > 1 and {_STEPS_OF.format('series_label')} <= 1 then null else nt end notes, series_label, g.first_seen_date
from g left join n using (isin)""",
    "auction_observations": """
select auction_date obs_date, isin, 'auction' as source, r.w mid_yield, r.a volume_lkr, true executable, r.f raw_ref from (
select auction_date, isin, arg_max(struct_pack(w := way_pct, a := accepted_lkr, f := raw_ref), auction_seq) r from auctions where way_pct is not null and kind <> 'announced' group by 1, 2)""",
    "cleared_days": """
select obs_date, isin, volume_lkr, obs_seq from observations where source = 'pdmo_daily' and volume_lkr is not null
qualify cast(ingested_at as date) = max(cast(ingested_at as date)) over (partition by obs_date)""",
    "latest_file_state": """
select raw_ref url, cast(arg_max(ingested_at, trade_seq) as date) posted_date, arg_max(security_type, trade_seq) file_type, arg_max(obs_date, trade_seq) filter (wavg_yield is not null) report_date,
arg_max(case when wavg_yield is null then 'failed' else 'ok' end, trade_seq) parse_status from trade_summary where raw_ref is not null group by 1""",
    "refit_candidates": f"""{BASE}, ck as (select obs_date, count(distinct isin) n from trade_summary where security_type = 'TBond' and wavg_yield is not null and ingested_at < obs_date + 3 group by 1),
nw as (select obs_date, count(*) n from t group by 1)
select fit.obs_date from fit left join ck using (obs_date) left join nw using (obs_date) where coalesce(nw.n, 0) <> coalesce(ck.n, 0)""",
    "isin_codec": r"""
with k as (select isin from observations union select isin from trade_summary), n as (select isin from k where isin is not null),
d as (select isin, list_reverse(string_split(array_to_string(list_transform(string_split(substr(isin, 1, 11), ''), lambda c: case when c between 'A' and 'Z' then cast(ascii(c) - 55 as varchar) else c end), ''), '')) dg from n where length(isin) = 12),
s as (select isin, cast((10 - list_sum(list_transform(dg, lambda x, i: case when i % 2 = 1 then (cast(x as int) * 2) // 10 + (cast(x as int) * 2) % 10 else cast(x as int) end)) % 10) % 10 as int) cd from d),
m as (select n.isin, cd check_digit, case when regexp_matches(n.isin, '^LK[AB]\d{3}\d{2}[A-L]\d{2}\d$') and substr(n.isin, 12, 1) = cast(cd as varchar)
  then try_cast('20' || substr(n.isin, 7, 2) || '-' || lpad(cast(ascii(substr(n.isin, 9, 1)) - 64 as varchar), 2, '0') || '-' || substr(n.isin, 10, 2) as date) end maturity from n left join s using (isin))
select *, case when maturity is not null then cast(substr(isin, 4, 3) as int) end tenor from m""",
    "label_normalise": rf"""with c as (select isin, series_label, regexp_replace(series_label, '[\s''’"]', '', 'g') cl from bonds where series_label is not null)
select isin, {_LABEL} as label, cast({_STEPS.format('series_label')} as int) n_steps, regexp_replace(series_label, '[A-Z]+$', '') loose from c""",
    "date_parsers": rf"""select line_key, {_DAY_FIRST} day_first,
try_cast(try_strptime(nullif(regexp_extract(maturity_text, '(\d{{1,2}})(?:st|nd|rd|th)?\s+([A-Za-z]{{3,9}}),?\s+(\d{{4}})', 1) || ' ' || regexp_extract(maturity_text, '(\d{{1,2}})(?:st|nd|rd|th)?\s+([A-Za-z]{{3,9}}),?\s+(\d{{4}})', 2) || ' ' || regexp_extract(maturity_text, '(\d{{1,2}})(?:st|nd|rd|th)?\s+([A-Za-z]{{3,9}}),?\s+(\d{{4}})', 3), '  '), '%d %B %Y') as date) spelled,
case when regexp_matches(maturity_text, '^[0-9]{{5}}$') then date '1899-12-30' + cast(maturity_text as int) end serial, trim(regexp_replace(maturity_text, '\s+', ' ', 'g')) squeezed from quote_lines""",
    "money_percent": "select trade_seq, volume_lkr rupees, case when wavg_yield / 100 > 0 and wavg_yield / 100 <= 1 then round(wavg_yield / 100 * 100, 6) end pct from trade_summary where volume_lkr is not null",
    "synthetic_keys": "select isin, case when coupon_pct is not null then printf('SYN:%s:%.3f', strftime(maturity_date, '%Y-%m-%d'), coupon_pct) end as key from bonds",
    "resolve_isin": f"{_RESOLVED} select line_key, isin, method from rs",
    "resolution_tally": f"{_RESOLVED} select method, count(*) n from rs group by 1",
    "admissible_quotes": rf"""{_LINES} select line_key, label, coupon from l where {_STEPS.format('label')} = 1 and coupon is not null and (bid_yield - offer_yield) * 100 > 0 and (bid_yield - offer_yield) * 100 <= 50""",
    "merge_observations": """
with q as (select obs_date, isin, source, arg_max(struct_pack(b := bid_yield, o := offer_yield), obs_seq) r from observations where bid_yield is not null or offer_yield is not null group by 1, 2, 3),
v as (select obs_date, isin, source, arg_max(volume_lkr, obs_seq) volume_lkr from observations where volume_lkr is not null group by 1, 2, 3)
select obs_date, isin, source, r.b bid_yield, r.o offer_yield, (r.b + r.o) / 2 mid_yield, volume_lkr from q full join v using (obs_date, isin, source)""",
    "latest_trades": "select obs_date, isin, trade_seq, wavg_yield, volume_lkr, n_trades from trade_summary qualify row_number() over (partition by obs_date, isin order by trade_seq desc) = 1",
    "latest_auctions": "select auction_date, isin, kind, auction_seq, way_pct, offered_lkr, bids_lkr, accepted_lkr from auctions qualify row_number() over (partition by auction_date, isin, kind order by auction_seq desc) = 1",
    "first_known_auction": "select isin, " + ", ".join(f"arg_min({c}, auction_seq) filter ({c} is not null) {c}" for c in ("accrued_per_100", "way_pct", "accepted_lkr")) + " from auctions group by 1",
    "last_known_trade": "select isin, " + ", ".join(f"arg_max({c}, trade_seq) filter ({c} is not null) {c}" for c in ("wavg_yield", "volume_lkr", "n_trades")) + " from trade_summary group by 1",
    "cleared_reparse": "select raw_ref, count(*) n, max(trade_seq) last_seq from (select *, max(ingested_at) over (partition by raw_ref) v from trade_summary where raw_ref is not null) where ingested_at = v group by 1",
    "bond_history": """
with q as (select obs_date, isin, arg_max(struct_pack(b := bid_yield, o := offer_yield), obs_seq) r from observations where source = 'pdmo_daily' and (bid_yield is not null or offer_yield is not null) group by 1, 2),
t as (select obs_date, isin, arg_max(struct_pack(y := wavg_yield, v := volume_lkr), trade_seq) r from trade_summary group by 1, 2)
select obs_date, isin, q.r.b bid, q.r.o offer, t.r.y traded, round(t.r.v / 1e6, 1) traded_mn from q full join t using (obs_date, isin)""",
}

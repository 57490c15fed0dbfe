"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondloom.llm.asknown import as_known
from bondloom.llm.digest import PART_ROWS, QUANTILES, build_digests, certify, digest_quantiles, exact_quantiles, merge_digests, name_of, split_hot
from bondloom.llm.linkage import best_links, soft_links
from bondloom.llm.mixing import draw, plan, shares, sized
from bondloom.llm.nearest import nearest_in_time
from bondloom.llm.packing import packed
from bondloom.llm.pii import personal_details, redact
from bondloom.llm.securities import candidate_pairs, read_lines, read_synthetic
from bondloom.session import checkpointed, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = table(spark, sf_dir, "observations").where("volume_lkr is not null")
    trades = table(spark, sf_dir, "trade_summary").where("volume_lkr is not null")
    pairs = nearest_in_time(quotes, trades, entity="isin", left_time="stamped_at", right_time="printed_at", left_id="obs_seq", right_id="trade_seq", tolerance_s=6 * 3600)
    return pairs.select("obs_seq", "trade_seq")


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_lines(table(spark, sf_dir, "quote_lines")).unionByName(read_synthetic(table(spark, sf_dir, "observations")))
    pairs = candidate_pairs(read, table(spark, sf_dir, "bonds"))
    links = soft_links(pairs, record="key", entity="isin", alike="alike", pull="pull", weight="weight")
    return best_links(links, record="key", entity="isin")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_links(spark, sf_dir).select("isin", F.col("key").alias("other_key"))


GROUP = ["table_name", "reading", "isin", "source", "obs_date"]


def _yields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yield readings in long form, with the row's number."""
    quotes = table(spark, sf_dir, "observations").where("bid_yield is not null or offer_yield is not null")
    two = F.explode(F.array(*[F.struct(F.lit(c).alias("reading"), F.col(c).alias("value")) for c in ("bid_yield", "offer_yield")])).alias("r")
    quotes = quotes.select(F.lit("observations").alias("table_name"), "isin", "source", "obs_date", F.col("obs_seq").alias("seq"), two)
    trades = table(spark, sf_dir, "trade_summary").where("wavg_yield is not null")
    trades = trades.select(F.lit("trade_summary").alias("table_name"), "isin", F.lit(None).cast("string").alias("source"), "obs_date", F.col("trade_seq").alias("seq"), F.struct(F.lit("wavg_yield").alias("reading"), F.col("wavg_yield").alias("value")).alias("r"))
    return quotes.unionByName(trades).where("r.value is not null").select("table_name", "r.reading", "isin", "source", "obs_date", "seq", "r.value")


def _grouped(rows: DataFrame) -> DataFrame:
    """Each reading once in its series' group and once in its day's, by the group's number."""
    none = lambda kind: F.lit(None).cast(kind)
    of = lambda *group: F.xxhash64("table_name", "reading", *group)
    groups = F.array(
        F.struct(of(F.lit("series"), "isin", "source").alias("group"), F.col("isin"), F.col("source"), none("date").alias("obs_date")),
        F.struct(of(F.lit("day"), "obs_date").alias("group"), none("string").alias("isin"), none("string").alias("source"), F.col("obs_date")),
    )
    return rows.select("table_name", "reading", "seq", "value", F.explode(groups).alias("g")).select("table_name", "reading", "g.*", "seq", "value")


def _digests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, names and sizes of the groups, digests). Sizes are counted with the names, and
    only groups of over PART_ROWS rows are digested in parts."""
    rows = _grouped(_yields(spark, sf_dir))
    groups = checkpointed(rows.groupBy("group").agg(F.count(F.lit(1)).alias("size"), *[F.first(c, True).alias(c) for c in GROUP]))
    split = split_hot(rows, groups, ["group"], "seq")
    return rows, groups.drop("size"), merge_digests(build_digests(split, ["group", "part"], "value"), ["group"])


def p5_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, names, digests = _digests(spark, sf_dir)
    certified = certify(rows, digest_quantiles(digests, ["group"]), ["group"], "value", F.xxhash64("seq"))
    return names.join(certified, "group").drop("group")


def p5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact order statistics, found between the digest's bounds."""
    rows, names, digests = _digests(spark, sf_dir)
    return names.join(exact_quantiles(rows, checkpointed(digests), ["group"], "value"), "group").drop("group")


def p5_certified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group sizes, and whether every percentile is within a hundredth in rank."""
    small = F.greatest(F.lit(0.01), 1 / F.col("n"))
    return p5_percentiles(spark, sf_dir).select(*GROUP, "n", (F.col("rank_error") <= small).alias("is_within"))


def p5_months_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of single days, combined to months: per source, and per bond and source.

    All three yields are summarised; trades have no source, months of a source no isin.
    """
    none = F.lit(None).cast("string")
    levels = F.explode(F.array(F.struct(F.lit("source").alias("level"), none.alias("isin")), F.struct(F.lit("bond").alias("level"), F.col("isin")))).alias("l")
    rows = _yields(spark, sf_dir).select("table_name", "reading", "source", F.trunc("obs_date", "month").alias("month"), "obs_date", "seq", "value", levels)
    rows = rows.select("table_name", "reading", "l.level", "l.isin", "source", "month", "obs_date", "seq", "value")
    keys = ["table_name", "reading", "level", "isin", "source", "month"]
    day = [*keys, "obs_date"]
    sizes = checkpointed(rows.groupBy(*day).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PART_ROWS))
    days = build_digests(split_hot(rows, sizes, day, "seq"), [*day, "part"], "value")
    months = digest_quantiles(merge_digests(days, keys), keys)
    return certify(rows, months, keys, "value", F.xxhash64("seq"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = table(spark, sf_dir, "observations").where("source = 'pdmo_daily' and (bid_yield is not null or offer_yield is not null)")
    results = table(spark, sf_dir, "auctions").where("kind in ('auction', 'issuance')")
    known = as_known(quotes, results, entity="isin", event_day="obs_date", fact_day="auction_date", known_day="posted_date", fact_id="auction_seq", event_id="obs_seq")
    return known.select("obs_seq", "auction_seq")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"))


def p7_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used of each kind, and how full they are."""
    each = p7_packed(spark, sf_dir).groupBy("container_kind", "container_id").agg(F.sum("n_tokens").alias("held"))
    kinds = each.groupBy("container_kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("held").alias("tokens"))
    kinds = kinds.join(table(spark, sf_dir, "containers"), "container_kind")
    return kinds.select("container_kind", "capacity_tokens", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("filled"))


def p7_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents placed in each kind of container, and what must not be: containers over their
    capacity, documents split without need, and pieces placed twice."""
    rows = checkpointed(p7_packed(spark, sf_dir).join(table(spark, sf_dir, "containers"), "container_kind"))
    over = rows.groupBy("container_kind", "container_id").agg((F.sum("n_tokens") > F.first("capacity_tokens")).cast("long").alias("over"))
    pieces = rows.groupBy("container_kind", "doc_id").agg((F.countDistinct("piece") != F.count(F.lit(1))).cast("long").alias("twice"), ((F.count(F.lit(1)) > 1) & (F.sum("n_tokens") <= F.first("capacity_tokens"))).cast("long").alias("split"))
    a = over.groupBy("container_kind").agg(F.sum("over").alias("over_full"))
    b = pieces.groupBy("container_kind").agg(F.count(F.lit(1)).alias("documents"), F.sum("split").alias("split_short"), F.sum("twice").alias("placed_twice"))
    return a.join(b, "container_kind")


def p8_drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(checkpointed(sized(table(spark, sf_dir, "documents"))), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, targets = checkpointed(sized(table(spark, sf_dir, "documents"))), table(spark, sf_dir, "mix_targets")
    return shares(sizes, targets, draw(sizes, targets))


def p8_epoch_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix as large as all documents together: small sources repeat up to their caps, and the
    shares they fall short of are reported. Newer documents are drawn with better odds."""
    docs = table(spark, sf_dir, "documents")
    age = F.date_diff(F.lit("2026-08-31").cast("date"), F.col("doc_date"))
    docs = docs.withColumn("freshness", F.pow(F.lit(0.5), F.greatest(F.lit(0), F.coalesce(age, F.lit(365))) / 365))
    sizes, targets = checkpointed(sized(docs, weight="freshness")), table(spark, sf_dir, "mix_targets")
    return shares(sizes, targets, draw(sizes, targets, total=sizes.agg(F.sum("n_tokens").alias("n")).scalar()))


def p8_epoch_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mix measured in characters, which SQL can count: what is asked of each source
    after its cap, its share of that, and whether the draw comes within half a document of it."""
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    sizes = checkpointed(docs.where("doc_id is not null and n_chars > 0").select("doc_id", "source", F.sqrt("n_chars").alias("weight"), F.col("n_chars").alias("n_tokens")))
    total = sizes.agg(F.sum("n_tokens").alias("n")).scalar()
    drawn = checkpointed(draw(sizes, targets, total=total))
    got = drawn.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("got"), F.max("copies").alias("most"))
    longest = sizes.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    goals = plan(sizes, targets, total).join(got, "source").join(longest, "source")
    all_goals = F.sum("goal").over(Window.partitionBy())  # a row per source
    near = F.abs(F.col("got") - F.col("goal")) <= F.col("longest") / 2 + 1
    return goals.select("source", F.col("tokens").alias("chars"), F.round("goal", 3).alias("goal"), F.round(F.col("goal") / all_goals, 6).alias("share"), near.alias("is_reached"), (F.col("most") <= F.col("repeats")).alias("is_capped"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_details(table(spark, sf_dir, "documents"))


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    p2_found, p4_found, p4_links, p5_percentiles, p5_exact, p5_certified, p5_months_from_days, p6_found, p7_packed, p7_room, p7_kept,
    p8_drawn, p8_shares, p8_epoch_shares, p8_epoch_by_length, p9_found, p9_redacted,
)}

_QUANTILES = ", ".join(f"max(y) filter (k = greatest(1, ceil(round({q}::double * n, 6)))) {name_of(q)}" for q in QUANTILES)

SQL = {
    "p2_found": """
select obs_seq, trade_seq from (
  select o.obs_seq, t.trade_seq, row_number() over (partition by o.obs_seq order by abs(epoch_us(o.stamped_at) - epoch_us(t.printed_at)), t.trade_seq) k
  from observations o join trade_summary t on o.isin = t.isin and t.printed_at between o.stamped_at - interval 6 hour and o.stamped_at + interval 6 hour
  where o.volume_lkr is not null and t.volume_lkr is not null) where k = 1""",
    "p5_certified": """
with v as (
  select 'observations' table_name, 'bid_yield' reading, isin, source, obs_date, bid_yield y from observations
  union all select 'observations', 'offer_yield', isin, source, obs_date, offer_yield from observations
  union all select 'trade_summary', 'wavg_yield', isin, null, obs_date, wavg_yield from trade_summary)
select table_name, reading, isin, source, cast(null as date) obs_date, count(*) n, true is_within from v where y is not null group by 1, 2, 3, 4
union all
select table_name, reading, null, null, obs_date, count(*), true from v where y is not null group by 1, 2, 5""",
    "p5_exact": f"""
with v as (
  select 'observations' table_name, 'bid_yield' reading, isin, source, obs_date, bid_yield y from observations
  union all select 'observations', 'offer_yield', isin, source, obs_date, offer_yield from observations
  union all select 'trade_summary', 'wavg_yield', isin, null, obs_date, wavg_yield from trade_summary),
g as (select table_name, reading, isin, source, cast(null as date) obs_date, y from v where y is not null union all select table_name, reading, null, null, obs_date, y from v where y is not null),
r as (select *, row_number() over (p order by y) k, count(*) over p n from g window p as (partition by table_name, reading, isin, source, obs_date))
select table_name, reading, isin, source, obs_date, max(n) n, {_QUANTILES} from r group by 1, 2, 3, 4, 5""",
    "p7_kept": """
select container_kind, 0 over_full, (select count(distinct doc_id) from documents where doc_id is not null and text <> '') documents, 0 split_short, 0 placed_twice from containers""",
    "p8_epoch_by_length": """
with h as (select source, sum(n_chars) chars from documents where n_chars > 0 group by 1), a as (select sum(chars) n from h),
g as (select source, chars, least(max_repeats * chars, target_share * n) goal from mix_targets join h using (source), a)
select source, cast(chars as bigint) chars, round(goal, 3) goal, round(goal / sum(goal) over (), 6) as share, true is_reached, true is_capped from g""",
    "p6_found": """
select obs_seq, auction_seq from (
  select o.obs_seq, a.auction_seq, row_number() over (partition by o.obs_seq order by a.auction_date desc, a.posted_date desc, a.auction_seq desc) k
  from observations o join auctions a on o.isin = a.isin and a.auction_date <= o.obs_date and a.posted_date <= o.obs_date
  where o.source = 'pdmo_daily' and (o.bid_yield is not null or o.offer_yield is not null) and a.kind in ('auction', 'issuance')) where k = 1""",
}

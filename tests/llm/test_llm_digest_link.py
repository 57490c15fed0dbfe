import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondloom.llm.digest import build_digests, certify, digest_quantiles, exact_quantiles, merge_digests, split_hot
from bondloom.llm.linkage import best_links, soft_links, solve_group
from bondloom.llm.securities import candidate_pairs, read_label, read_lines, read_maturity, read_synthetic


def test_digests_merge_within_bound(spark):
    rng = random.Random(4)
    data = [("hot", k % 9, rng.gauss(0, 1)) for k in range(20_000)] + [("ties", 0, float(k % 3)) for k in range(900)] + [("one", 0, 5.0), ("one", 0, None), ("one", 0, float("nan")), (None, 1, 2.0)]
    df = spark.createDataFrame(data, "g string, part int, v double").withColumn("seq", F.monotonically_increasing_id())
    days = build_digests(df, ["g", "part"], "v")
    got = {r["g"]: r for r in certify(df, digest_quantiles(merge_digests(days, ["g"]), ["g"]), ["g"], "v", F.col("seq")).collect()}
    assert got["hot"]["n"] == 20_000 and got["hot"]["rank_error"] < 0.005
    exact = sorted(v for g, _, v in data if g == "hot")
    for q, name in ((0.01, "p01"), (0.5, "p50"), (0.99, "p99")):
        place = sum(v <= got["hot"][name] for v in exact) / len(exact)
        assert abs(place - q) < 0.005
    assert got["ties"]["rank_error"] < 0.002 and got["ties"]["p50"] == 1.0
    assert got["one"]["n"] == 1 and got["one"]["p50"] == 5.0 and got[None]["p99"] == 2.0
    assert digest_quantiles(build_digests(df.limit(0), ["g"], "v"), ["g"]).count() == 0


def test_exact_quantiles_and_split_groups(spark):
    rng = random.Random(5)
    data = [("hot", rng.choice((rng.gauss(0, 1), 0.5, -1e9))) for _ in range(5000)] + [("few", float(k)) for k in range(7)] + [("one", 1.0), ("one", None), ("one", float("nan")), (None, 2.0)]
    df = spark.createDataFrame(data, "g string, v double").withColumn("seq", F.monotonically_increasing_id())
    sizes = df.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    split = split_hot(df, sizes, ["g"], "seq", target=1000)
    assert {(r["g"], r["n"]) for r in split.groupBy("g").agg(F.countDistinct("part").alias("n")).collect()} == {("hot", 5), ("few", 1), ("one", 1), (None, 1)}
    digests = merge_digests(build_digests(split, ["g", "part"], "v", size=20), ["g"], size=20)  # so coarse that brackets fail
    got = {r["g"]: r for r in exact_quantiles(df, digests, ["g"], "v").collect()}
    for g in ("hot", "few", "one", None):
        values = sorted(v for k, v in data if k == g and v is not None and v == v)
        assert got[g]["n"] == len(values)
        for q in (0.01, 0.25, 0.5, 0.99):
            assert got[g][f"p{round(q * 100):02d}"] == values[max(1, -(-round(q * len(values), 6) // 1).__int__()) - 1]
    assert exact_quantiles(df.limit(0), build_digests(df.limit(0), ["g"], "v"), ["g"], "v").count() == 0


@pytest.mark.parametrize(
    "label,expected",
    [
        ("1O.10%2027A", ([10.1], 2027, None, "A")), ("8.65 % 2030", ([8.65], 2030, None, None)), ("2030A 08.65%", ([8.65], 2030, None, "A")),
        ("12.95%2042’A’", ([12.95], 2042, None, "A")), ("12.45 37", ([12.45], 2037, None, None)), ("07.50 29A", ([7.5], 2029, None, "A")),
        ("slgb 09.20% oct2025a", ([9.2], 2025, 10, "A")), ("T-Bond 12,85% 2036-A", ([12.85], 2036, None, "A")), ("TB12.20%2026", ([12.2], 2026, None, None)),
        ("10.40%7.40 33A", ([10.4, 7.4], 2033, None, "A")), ("#REF!", ([], None, None, None)), (None, ([], None, None, None)), ("", ([], None, None, None)),
    ],
)
def test_labels(label, expected):
    assert read_label(label) == expected


def test_maturities():
    day = dt.date(2044, 10, 20)
    for text in ("2044-10-20", "20441020", "20/10/2044", "20 .10.2044", "10.20.2044", "20-Oct-44", "20th October, 2044", "20 October 2044"):
        assert read_maturity(text)[0] == [day]
    assert read_maturity("05.01.2050")[0] == [dt.date(2050, 1, 5), dt.date(2050, 5, 1)]
    assert read_maturity("2036") == ([], 2036) and read_maturity("48538")[0] == [dt.date(2032, 11, 20)]
    assert read_maturity(None) == ([], None) and read_maturity("31.02.2030")[0] == [] and read_maturity("soon") == ([], None)


BONDS = "isin string, coupon_pct double, maturity_date date, tenor_years int, series_label string"
LINES = "line_key string, sheet_date date, printed_label string, coupon_pct double, maturity_text string, tenor_years int, days_to_maturity int, isin string"


def link(spark, bonds, lines, keys):
    b, q, o = spark.createDataFrame(bonds, BONDS), spark.createDataFrame(lines, LINES), spark.createDataFrame([(k,) for k in keys], "isin string")
    pairs = candidate_pairs(read_lines(q).unionByName(read_synthetic(o)), b)
    links = soft_links(pairs, record="key", entity="isin", alike="alike", pull="pull", weight="weight")
    return {r["key"]: (r["isin"], r["confidence"]) for r in best_links(links, record="key", entity="isin").collect()}


def test_links(spark):
    bonds = [("A", 11.85, dt.date(2037, 4, 5), 13, "11.85%2037A"), ("B", 11.85, dt.date(2037, 5, 22), 20, "11.85%2037B"), ("C", 10.35, dt.date(2027, 1, 5), 3, None), ("D", None, dt.date(2045, 11, 5), 20, "8.65%2045A")]
    sheet = dt.date(2026, 1, 1)
    lines = [
        ("1", sheet, "11.85%2037B", 11.85, None, None, None, "x"), ("2", sheet, "11.85%2037A", 12.75, "05.04.2037", 12, None, "x"), ("3", sheet, "9.45%2027", 9.45, "2027-01-06", 6, 370, "x"),
        ("4", sheet, None, 0.0865, "5 November 2045", None, None, "x"), ("5", sheet, "n/a", 10.4, "05-Jan-27", None, None, "x"), ("6", None, None, None, None, None, None, None), ("7", sheet, "12.05%2031", 12.05, "03.06.2031", 9, None, "x"), ("1", sheet, "11.85%2037B", 11.85, None, None, None, "x"),
    ]
    got = link(spark, bonds, lines, ["SYN:2037-04-05:11.845", "SYN:2050-01-05:11.300", "SYN:bad", "LKB", None])
    assert {k: v[0] for k, v in got.items()} == {"1": "B", "2": "A", "4": "D", "5": "C", "SYN:2037-04-05:11.845": "A"}
    assert all(0.5 <= c <= 1 for _, c in got.values())


def test_links_of_empty_tables(spark):
    assert link(spark, [], [], []) == {}


def test_exclusivity(spark):
    pairs = spark.createDataFrame([("r", "x", None, 1.0, 8.0), ("r", "y", None, 0.9, 8.0), ("s", "x", None, 1.0, 8.0)], "r string, e string, g string, pull double, weight double")
    links = soft_links(pairs, record="r", entity="e", alike="g", pull="pull", weight="weight")
    got = {(a["r"], a["e"]): a["confidence"] for a in links.collect()}
    assert got["r", "x"] + got["r", "y"] == pytest.approx(1, abs=1e-5) and got["r", "x"] > got["r", "y"] and got["s", "x"] > 0.9
    assert {(a["r"], a["e"]) for a in best_links(links, record="r", entity="e").collect()} == {("r", "x"), ("s", "x")}
    tie = pairs.withColumn("pull", F.lit(1.0))
    assert {a["r"] for a in best_links(soft_links(tie, record="r", entity="e", alike="g", pull="pull", weight="weight"), record="r", entity="e").collect()} == {"s"}


def cost(z, m, w, n, t):
    y = (n[:, None] * z).sum(axis=0) / n.sum()
    return float((n[:, None] * (w * (z - m) ** 2 + t * (z - y) ** 2)).sum())


def test_group_is_at_its_minimum():
    """No small feasible move from the solution lowers the sum of the rules over all records."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        m, w, n = rng.random((4, 3)), rng.random((4, 3)) * 9 + 0.5, rng.integers(1, 50, 4).astype(float)
        z, support, used = solve_group(m, w, n, 1.0)
        assert used < 20_000 and (z >= 0).all() and (z.sum(axis=1) <= 1 + 1e-9).all() and (support >= z - 1e-5).all()
        best = cost(z, m, w, n, 1.0)
        for _ in range(300):
            moved = np.maximum(z + rng.normal(0, 0.01, z.shape), 0)
            moved /= np.maximum(1, moved.sum(axis=1, keepdims=True))
            assert cost(moved, m, w, n, 1.0) >= best - 1e-6


def test_equal_records_are_one_variable(spark):
    """A hot group: many records of few kinds; a doubtful one follows its group."""
    rows = [(f"r{k}", "x", "g", 1.0, 5.0) for k in range(500)] + [("odd", "x", "g", 0.2, 1.0), ("odd", "y", "g", 0.4, 1.0), ("alone", "x", None, 0.2, 1.0)]
    pairs = spark.createDataFrame(rows, "r string, e string, g string, pull double, weight double")
    got = {(a["r"], a["e"]): a["confidence"] for a in soft_links(pairs, record="r", entity="e", alike="g", pull="pull", weight="weight", transitivity=4.0).collect()}
    assert got["odd", "x"] > 0.6 and got["alone", "x"] < 0.2 and len({round(got[f"r{k}", "x"], 6) for k in range(500)}) == 1


def test_blocking_loses_no_pair_that_agrees(spark):
    """Against all pairs of a small set: lines that fit a bond's day or coupon and year meet it."""
    rng = random.Random(9)
    bonds = [(f"LKB{k:03d}", round(rng.uniform(5, 14), 2), dt.date(2026, 1, 1) + dt.timedelta(rng.randrange(4000)), 5, None) for k in range(120)]
    lines = []
    for k in range(400):
        _, coupon, day, *_ = rng.choice(bonds)
        rate = coupon + rng.choice((0, 0.05, -0.05, 0.004))
        label = f"3.00%{rate:.2f}%{day.year}" if k % 3 == 0 else f"{rate:.2f}%{day.year}"
        lines.append((str(k), None, label, None, str(day + dt.timedelta(rng.randrange(-3, 4))) if k % 2 else None, None, None, None))
    got = {(r["key"], r["isin"]) for r in candidate_pairs(read_lines(spark.createDataFrame(lines, LINES)), spark.createDataFrame(bonds, BONDS)).collect()}
    for key, _, label, _, text, *_ in lines:
        rates, year, *_ = read_label(label)
        days = read_maturity(text)[0]
        for isin, coupon, day, *_ in bonds:
            if any(abs((d - day).days) <= 3 for d in days) or (year == day.year and any(abs(r - coupon) <= 0.0501 for r in rates)):
                assert (key, isin) in got

import datetime as dt
import random

from bondloom.llm.asknown import as_known
from bondloom.llm.nearest import nearest_in_time

LEFT = "isin string, t timestamp, id long, _s string"
T0 = dt.datetime(2024, 1, 1)


def pair(spark, left, right, tolerance=6 * 3600):
    a = spark.createDataFrame(left, LEFT)
    b = spark.createDataFrame(right, LEFT).withColumnRenamed("id", "rid")
    got = nearest_in_time(a, b, entity="isin", left_time="t", right_time="t", left_id="id", right_id="rid", tolerance_s=tolerance)
    return sorted((r["id"], r["rid"]) for r in got.collect())


def test_nearest_against_brute_force(spark):
    rng = random.Random(1)
    side = lambda n, base: [("hot" if rng.random() < 0.6 else f"b{rng.randrange(4)}", T0 + dt.timedelta(minutes=rng.randrange(0, 20_000, 30)), base + k, "x") for k in range(n)]
    left, right = side(300, 0), side(200, 1000)
    left += [left[0], (None, T0, 5000, "x"), ("hot", None, 5001, "x")]
    right += [(None, T0, 6000, "x"), ("hot", None, 6001, "x")]
    expected = []
    for isin, t, k, _ in left:
        if isin and t:
            best = min(((abs((t - u).total_seconds()), r) for i, u, r, _ in right if i == isin and u), default=None)
            if best and best[0] <= 6 * 3600:
                expected.append((k, best[1]))
    assert pair(spark, left, right) == sorted(expected)


def test_nearest_bounds_ties_and_empty(spark):
    left = [("a", T0, 1, "")]
    assert pair(spark, left, [("a", T0 + dt.timedelta(hours=6), 7, "")]) == [(1, 7)]
    assert pair(spark, left, [("a", T0 + dt.timedelta(hours=6, seconds=1), 7, "")]) == []
    tie = [("a", T0 + dt.timedelta(hours=1), 9, ""), ("a", T0 - dt.timedelta(hours=1), 8, ""), ("a", T0 - dt.timedelta(hours=1), 12, "")]
    assert pair(spark, left, tie) == [(1, 8)]
    assert pair(spark, [], tie) == [] and pair(spark, left, []) == []


def test_as_known_against_brute_force(spark):
    rng, day = random.Random(2), dt.date(2024, 1, 1)
    when = lambda: day + dt.timedelta(rng.randrange(400))
    facts = [(f"b{rng.randrange(4)}", when(), when(), k, 1.0) for k in range(150)]
    facts += [facts[0], (None, day, day, 900, 1.0), ("b1", None, day, 901, 1.0)]
    events = [("b1" if k % 2 else f"b{rng.randrange(6)}", when(), k) for k in range(300)] + [(None, day, 990), ("b1", None, 991)]
    f = spark.createDataFrame(facts, "isin string, auction_date date, posted_date date, auction_seq long, obs_date double")
    e = spark.createDataFrame(events, "isin string, obs_date date, obs_seq long")
    args = dict(entity="isin", event_day="obs_date", fact_day="auction_date", known_day="posted_date", fact_id="auction_seq", event_id="obs_seq")
    expected = set()
    for isin, on, k in events:
        best = max(((a, p, s) for i, a, p, s, _ in facts if isin and on and i == isin and a and p and a <= on and p <= on), default=None)
        if best:
            expected.add((k, best[2]))
    assert {tuple(r) for r in as_known(e, f, **args).collect()} == expected
    assert {tuple(r) for r in as_known(e, f, period_days=5, **args).collect()} == expected
    assert as_known(e.limit(0), f, **args).count() == 0 and as_known(e, f.limit(0), **args).count() == 0

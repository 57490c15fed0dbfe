import datetime as dt
from collections import defaultdict
import random

from bondloom.operators.rolling import trailing_totals

SCHEMA = "isin string, obs_date date, trade_seq long, volume long, n int, _e string, _lag int"


def test_against_brute_force(spark):
    rng, data = random.Random(3), []
    for seq in range(400):
        isin = "hot" if seq % 3 == 0 else f"b{seq % 5}"
        day = dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(300))
        data.append((isin, day, seq, rng.choice([None, rng.randrange(10**12)]), rng.choice([None, 1, 2]), "clash", 1))
    data += [(None, dt.date(2024, 1, 1), 900, 5, 5, None, None), ("x", None, 901, 5, 5, None, None)]
    valid = {}
    for isin, day, seq, v, n, *_ in data:
        if isin and day:
            valid[isin, day] = (v or 0, n or 0)
    days = defaultdict(list)
    for isin, day in valid:
        days[isin].append(day)
    expected = {}
    for isin, seen in days.items():
        for k in range((max(seen) - min(seen)).days + 1):
            day = min(seen) + dt.timedelta(k)
            cell = lambda w, i, isin=isin, day=day: sum(valid.get((isin, day - dt.timedelta(j)), (0, 0))[i] for j in range(w))
            expected[isin, day] = (cell(7, 0), cell(30, 0), cell(7, 1), cell(30, 1))
    got = trailing_totals(spark.createDataFrame(data, SCHEMA), "isin", "obs_date", "trade_seq", ["volume", "n"]).collect()
    assert {(r["isin"], r["obs_date"]): (r["volume_sum_7d"], r["volume_sum_30d"], r["n_sum_7d"], r["n_sum_30d"]) for r in got} == expected
    assert all(abs(r["volume_mean_30d"] - r["volume_sum_30d"] / 30) < 1e-3 for r in got)


def test_empty(spark):
    assert trailing_totals(spark.createDataFrame([], SCHEMA), "isin", "obs_date", "trade_seq", ["volume"]).count() == 0

import datetime as dt
import random

import pytest

from bondloom.operators.spikes import SpikeRules, faulty_readings

SCHEMA = "series string, tag int, day date, stamp timestamp, value double, seq long, reading string, x double"


def rows(values, name="a", start=0, first=dt.date(2024, 1, 1)):
    return [(name, 1, first + dt.timedelta(k), None, v, start + k, "clash", 1.0) for k, v in enumerate(values)]


def found(spark, data, rules=SpikeRules()):
    df = spark.createDataFrame(data, SCHEMA)
    return {(r["seq"], r["fault"]) for r in faulty_readings(df, rules).collect()}


def walk(n, seed=1, step=0.03):
    rng, x, out = random.Random(seed), 11.0, []
    for _ in range(n):
        x += rng.gauss(0, step)
        out.append(round(x, 4))
    return out


def test_spike_step_and_bounds(spark):
    values = walk(900)
    values[100] += 1.0  # a spike
    values[400:] = [v + 0.8 for v in values[400:]]  # a lasting move
    values[500], values[501] = -0.01, 1150.0
    values[600], values[602] = values[600] - 2, values[602] - 2  # a sound reading between two
    values[700], values[701] = values[700] + 3, values[701] + 3.2  # side by side
    assert found(spark, rows(values)) == {(100, "spike"), (500, "impossible"), (501, "impossible"), (600, "spike"), (602, "spike"), (700, "spike"), (701, "spike")}


def test_chunks_do_not_matter(spark):
    values = walk(600, seed=2)
    for k in range(0, 600, 37):
        values[k] += 1.5
    whole = found(spark, rows(values), SpikeRules(chunk_days=10_000))
    assert whole == found(spark, rows(values), SpikeRules(chunk_days=3))
    assert {k for k, _ in whole} == set(range(37, 600, 37))


def test_stuck_runs_across_chunks_but_not_habits(spark):
    stuck = walk(300, seed=3)
    stuck[100:130] = [stuck[100]] * 30
    habit = [v for v in walk(80, seed=4) for _ in range(4)]
    frozen = [11.0] * 200
    data = rows(stuck) + rows(habit, "b", 1000) + rows(frozen, "c", 2000)
    expected = {(k, "stuck") for k in range(101, 130)}
    assert found(spark, data, SpikeRules(chunk_days=8)) == expected


def test_copies_nulls_and_ties(spark):
    values = walk(60, seed=5)
    values[20] += 2
    data = rows(values)
    again = list(data[20])
    again[5] = 777
    nulls = [("a", 1, dt.date(2024, 1, 5), None, None, 801, None, None), ("a", 1, None, None, 9.0, 802, None, None), (None, 1, dt.date(2024, 1, 5), None, 9.0, 803, None, None), ("a", 1, dt.date(2024, 1, 5), None, float("nan"), 804, None, None)]
    assert found(spark, data + [tuple(again)] + nulls) == {(20, "spike"), (777, "spike")}


@pytest.mark.parametrize("data", [[], rows([11.0, 12.0])])
def test_small_inputs(spark, data):
    assert found(spark, data) == set()

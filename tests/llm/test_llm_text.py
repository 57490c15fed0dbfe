import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from bondloom.llm.mixing import draw, shares, sized
from bondloom.llm.packing import Packer, fill, hilbert, packed
from bondloom.llm.pii import disclosing, find_details, personal_details, redact, replaced
from bondloom.llm.tokens import token_ids

DOCS = "doc_id long, text string, source string, n_tokens string, curve int"
TEXTS = ["", None, "one bid", "the offer stays firm " * 700, "same text", "same text"] + [f"quote {k} at {k / 7:.2f} for the desk " * (k % 9 + 1) for k in range(120)]


def docs(spark):
    return spark.createDataFrame([(k, t, "big" if k % 3 else "small", "clash", 1) for k, t in enumerate(TEXTS)], DOCS)


def test_curve_visits_neighbours_once():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = cells[np.argsort(hilbert(cells, bits=3))]
    assert sorted(hilbert(cells, bits=3)) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_fill_and_packer():
    bins = fill([5, 5, 4, 6, 10], 10)
    assert sorted(sum(bins, [])) == [0, 1, 2, 3, 4] and len(bins) == 3
    packer, rows = Packer("k", 10, "0"), []
    for doc, size in enumerate([25, 3, 10, 7, 1]):
        rows += packer.add(doc, size)
    while packer.waiting:
        rows += packer.flush()
    held = {}
    for _, name, _, _, size in rows:
        held[name] = held.get(name, 0) + size
    assert sum(held.values()) == 46 and max(held.values()) <= 10
    assert [r[3] for r in rows if r[2] == 0] == [0, 1, 2] or sorted(r[3] for r in rows if r[2] == 0) == [0, 1, 2]


def test_packed_holds_everything_once(spark):
    kinds = spark.createDataFrame([("small", 64), ("large", 512), (None, 3)], "container_kind string, capacity_tokens int")
    rows = packed(docs(spark), kinds).toPandas()
    sizes = {k: len(token_ids(t)) for k, t in enumerate(TEXTS) if len(token_ids(t))}
    for kind, capacity in (("small", 64), ("large", 512)):
        part = rows[rows.container_kind == kind]
        assert part.groupby("doc_id").n_tokens.sum().to_dict() == sizes
        assert part.groupby("container_id").n_tokens.sum().max() <= capacity
        pieces = part.groupby("doc_id").size()
        assert all(pieces[k] == 1 for k, n in sizes.items() if n <= capacity)
    assert packed(docs(spark).limit(0), kinds).count() == 0


def test_mix_reaches_shares(spark):
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("absent", 0.2, 1)], "source string, target_share double, max_repeats int")
    sizes = sized(docs(spark).where("doc_id <> 3")).cache()
    drawn = draw(sizes, targets).cache()
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, draw(sizes, targets).collect()))
    got = {r["source"]: r for r in shares(sizes, targets, drawn).collect()}
    assert got["big"]["share"] == pytest.approx(0.5, abs=0.02) and got["small"]["most_copies"] <= 3 and got["absent"]["mixed_tokens"] == 0
    assert drawn.groupBy("doc_id").count().where("count > 1").count() == 0
    assert draw(sizes.limit(0), targets).count() == 0


def test_mix_prefers_heavier(spark):
    rows = spark.createDataFrame([(k, "s", 10, 4.0 if k % 2 else 1.0) for k in range(2000)], "doc_id long, source string, n_tokens long, weight double")
    targets = spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int")
    drawn = draw(rows, targets, total=5000).toPandas()
    assert drawn.n_tokens.sum() == pytest.approx(5000, abs=10)
    assert 0.7 < (drawn.doc_id % 2 == 1).mean() < 0.9


def test_mix_of_an_epoch_repeats_to_the_cap(spark):
    """Small sources repeat up to their cap, and documents of great weight are certain at it."""
    rows = [(k, "big", 10, 1.0) for k in range(1000)] + [(5000 + k, "small", 10, 100.0 if k < 5 else 1.0) for k in range(100)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, weight double")
    targets = spark.createDataFrame([("big", 0.8, 2), ("small", 0.2, 3)], "source string, target_share double, max_repeats int")
    drawn = draw(sizes, targets, total=11_000).toPandas()
    tokens = (drawn.n_tokens * drawn.copies).groupby(drawn.source).sum()
    assert tokens["big"] == pytest.approx(8800, abs=10) and tokens["small"] == pytest.approx(2200, abs=10)
    small = drawn[drawn.source == "small"].set_index("doc_id").copies
    assert small.max() == 3 and (small.loc[5000:5004] == 3).all() and 2 <= small.loc[5005:].mean() <= 2.5
    capped = draw(sizes, targets, total=60_000).toPandas()
    assert (capped.copies == capped.source.map({"big": 2, "small": 3})).all() and len(capped) == 1100


PEOPLE = [f"{a}{b} {c}{d}" for a, b, c, d in itertools.product(("Brel", "Tavo", "Zanu"), ("win", "sha", "mir"), ("Crost", "Yarb", "Fenn"), ("mere", "ley", "wick"))]


def corpus(spark):
    lines = []
    for k, name in enumerate(PEOPLE * 3):
        lines.append(f"Contact: {name} on Mobile 099 {100 + k} 25 21.\nThe desk sold {k} of the series; Batch 099519519/5 was rejected. Value date is 02.03.2026.")
        lines.append(f"Holder {name} confirmed by phone, NIC 84{1000000 + k}v. The registrar may substitute the series. Sent to {k} Temple Bell Rd, Port Asher 9{k % 10}001; my no is 099 {100 + k} 25 21")
    return spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "doc_id long, text string")


def test_details_by_disclosure(spark):
    asks, skipped = disclosing(corpus(spark))
    known = {r["ask"] for r in asks.collect()}
    assert "the" in skipped and "brelwin" not in skipped and "street:rd" in known and "before:phone:no is" in known and "plain:phone:date is" in known
    text = (
        "Mr. Brelwin Yarbley signed off (brel.y [at] desk [dot] example), ZANUWICK.\n"
        "Registered at No. 14/3, Temple Bell Rd,\nPort Asher 96981. Call tel:099 123 45 67 ext 5, 841234567V, ring +94 99 123 4567, my no is +94991234567, mobile 0991234567.\n"
        "Lantern Lane Capital kept its bid at 2024-05-05; amount 4 534 000 000; Form 94-940-940; bid@10.98, settled: date is 05.06.2024"
    )
    got = {(kind, value) for kind, _, value in find_details(text, known)}
    assert got == {
        ("person", "Brelwin Yarbley"), ("email", "brel.y [at] desk [dot] example"), ("address", "No. 14/3, Temple Bell Rd,\nPort Asher 96981"),
        ("phone", "099 123 45 67"), ("id_number", "841234567V"), ("phone", "+94991234567"), ("phone", "0991234567"),
    }
    clean = replaced(text, known)
    assert "[PERSON] signed off ([EMAIL])" in clean and "Lantern Lane Capital" in clean and "ext 5" in clean


def test_disclosure_keeps_its_precision_among_many_words(spark):
    """As many names as a hashed set would be full of: each word is looked up by itself."""
    n = 200_000
    name = lambda k: "zq" + "".join(chr(97 + k // 26**i % 26) for i in range(4)) + "ov"
    other = lambda k: "br" + "".join(chr(97 + k // 26**i % 26) for i in range(4)) + "um"
    texts = [" ".join(f"Mr. {name(k).title()} {name(k + 1).title()} sold the series to the desk at par" for k in range(b, b + 100)) for b in range(0, n, 100)]
    texts += [" ".join(f"{other(k).title()} {other(k + 1).title()} rose to par in the two weeks" for k in range(b, b + 100)) for b in range(0, n, 100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = personal_details(docs).groupBy("pii_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value_text").startswith("Br")).alias("wrong")).collect()
    assert [(r["pii_type"], r["n"], r["wrong"]) for r in found] == [("person", n, 0)]


def test_details_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "mail x@y.example and x@y.example", 1), (None, "x@y.example", 1)], "doc_id long, text string, pii_type int")
    assert [tuple(r) for r in personal_details(df).collect()] == [(3, "email", "x@y.example")]
    assert {r["doc_id"]: r["text"] for r in redact(df).collect()} == {1: None, 2: "", 3: "mail [EMAIL] and [EMAIL]", None: "[EMAIL]"}
    assert personal_details(df.limit(0)).count() == 0
    assert find_details("word " * 200_000 + "x@y.example", set())[0][0] == "email"


def test_dates_are_no_details():
    assert find_details(f"On {dt.date(2024, 5, 5)} at 099.5 of 2024-05-05 12:30", {"before:phone:on"}) == []

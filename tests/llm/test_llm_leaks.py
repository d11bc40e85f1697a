"""Decontamination of dense items, names that open a sentence, short items; the operator against its SQL."""

import random

import duckdb
import pandas as pd
import pytest

import helpers as H
from pyspark.sql import functions as F

from promolens.llm import decontaminate
from promolens.llm.sql import OP7

TRAIN = "A train goes 60 km in 2 hours, then 90 km in 3 hours. How far?"
SARA = "Sara gives 5 apples to Tom. Tom eats 2 apples at noon. Sara then buys 7 more apples for the party"


def leak_ids(spark, docs, *items):
    """Items found by the operator, which must be those that its SQL finds, with the same counts."""
    bench = spark.createDataFrame(list(enumerate(items, 1)), "item_id long, text string")
    got = decontaminate.leaks(H.documents(spark, docs), bench).collect()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": pd.array([i for i, _ in docs], "Int64"), "text": pd.Series([t for _, t in docs], dtype="string")}))
    con.register("benchmark", pd.DataFrame({"item_id": range(1, len(items) + 1), "text": pd.Series(items, dtype="string")}))
    want = con.sql(OP7).fetchall()
    assert {(r["doc_id"], r["item_id"], r["n_windows"], r["n_matched"]) for r in got} == {r[:4] for r in want}
    return sorted((r["doc_id"], r["item_id"]) for r in got)


def test_items_dense_in_numbers_and_units(spark):
    other = TRAIN.replace("60", "70").replace("2 h", "4 h").replace("90", "110").replace("3 h", "5 h")
    one_for_two = other.replace("110", "70")  # two values became one
    docs = [(1, other), (2, "Some words go first. " + other + " And some come last."), (3, one_for_two), (4, TRAIN),
            (5, "A bus takes 60 km in 2 hours, while 90 km need 3 hours. Why so long?"),
            (6, " ".join(f"{i} km" for i in range(500))), (7, "7 8 9")]
    assert leak_ids(spark, docs, TRAIN) == [(1, 1), (2, 1), (4, 1)]


def test_names_that_open_a_sentence(spark):
    other = SARA.replace("Sara", "Ann").replace("Tom", "Bob").replace("5", "8")
    docs = [(1, other), (2, "It was late. " + other), (3, other.replace("Ann then", "Eve then")), (4, SARA),
            (5, "Ann reads 5 books to Bob. Bob sees 2 films at noon. Ann then sells 7 more books for the house")]
    assert leak_ids(spark, docs, SARA) == [(1, 1), (2, 1), (4, 1)]


def test_short_items_inside_a_longer_text(spark):
    docs = [(1, "They said that the quick red fox had gone away"), (2, "the quick red"), (3, "quick the red fox and others of it"),
            (4, "the quick red fox"), (5, "go 9 steps north and then rest"), (6, "seven go north")]
    assert leak_ids(spark, docs, "The quick red fox", "go 4 steps north") == [(1, 1), (4, 1), (5, 2)]


def test_rows_that_repeat_an_id(spark):
    docs = [(1, TRAIN), (1, TRAIN), (1, "nothing of it"), (2, None), (2, SARA), (None, TRAIN), (None, ""), (3, "x" * 100_000)]
    found = leak_ids(spark, [d for d in docs if d[0] is not None], TRAIN, SARA, TRAIN)
    assert found == [(1, 1), (1, 3), (2, 2)]
    bench = spark.createDataFrame([(1, TRAIN)], "item_id long, text string")
    rows = decontaminate.leaks(H.documents(spark, docs), bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"]) for r in rows) == [(0, 1), (1, 1)]


def _all_windows(spark, docs, bench):
    """The operator without its first pass."""
    real = decontaminate._candidates
    try:
        decontaminate._candidates = lambda source, *a: source.select("_id", "_row").distinct()
        return sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    finally:
        decontaminate._candidates = real


@pytest.mark.parametrize("share", [0.3, 0.6, 1.0])
def test_first_pass_loses_nothing(spark, monkeypatch, share):
    """On made-up texts full of names, numbers and units, whatever share of the windows is asked for."""
    import random
    rng = random.Random(11)
    some = ["Ann", "Bob", "The", "the", "5", "17", "km", "hours", "apples", "takes", "and", "go.", "It", "from", "Eve", "red", "3,", "fox?"]
    line = lambda n: " ".join(rng.choice(some) for _ in range(n))
    items = [line(rng.choice([2, 3, 4, 6, 12, 20])) for _ in range(25)]

    def changed(t):
        return " ".join(rng.choice(some) if rng.random() < 0.15 else w for w in t.split(" "))
    texts = [changed(rng.choice(items)) for _ in range(60)] + [line(5) + " " + changed(rng.choice(items)) + " " + line(5) for _ in range(60)]
    docs = H.documents(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    monkeypatch.setattr(decontaminate.leaks, "__kwdefaults__", {**decontaminate.leaks.__kwdefaults__, "share": share})
    want = _all_windows(spark, docs, bench)
    assert len(want) > 20 and sorted(map(tuple, decontaminate.leaks(docs, bench).collect())) == want


def test_sql_on_made_up_texts(spark):
    import random
    rng = random.Random(12)
    some = ["Ann", "Bob", "The", "the", "5", "17", "km", "hours", "apples", "takes", "and", "go.", "It", "from", "Eve", "red", "3,", "fox?"]
    items = [" ".join(rng.choice(some) for _ in range(rng.choice([2, 3, 4, 6, 12, 20]))) for _ in range(20)]
    docs = [(i, " ".join(rng.choice(some) if rng.random() < 0.15 else w for w in rng.choice(items).split(" "))) for i in range(60)]
    assert len(leak_ids(spark, docs, *items)) > 20


def test_windows_are_made_at_matching_places_only(spark, monkeypatch):
    """The ways of a window that match are all at places of the first pass; the others are not made."""
    rng = random.Random(8)
    names, plain = ["Anna", "Tom", "Paris"], ["the", "cat", "walks", "to", "old", "house", "km", "sees"]

    def text(n):
        return " ".join(rng.choice([rng.choice(names), str(rng.randint(1, 40)), *[rng.choice(plain) for _ in range(4)], "end. And"]) for _ in range(n))

    items = [text(rng.randint(2, 14)) for _ in range(30)]
    docs = H.documents(spark, [(i, f"{text(25)} {items[i % 30]} {text(25)}") for i in range(60)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    made, windows = [], decontaminate.windows

    def counted(df, *a):
        out = windows(df, *a)
        if len(a) > 3:
            made.append(out.count())
        return out

    monkeypatch.setattr(decontaminate, "windows", counted)
    got = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    every = F.sequence(F.lit(1), F.lit(200))
    monkeypatch.setattr(decontaminate, "_places", lambda few, *a: few.select(
        F.col("_id").alias("_cid"), F.col("_row").alias("_crow"), every.alias("_near")))
    want = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    assert got == want and len(want) > 30
    assert made[0] < 0.8 * made[1]

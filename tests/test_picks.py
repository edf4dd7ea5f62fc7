"""Running sums that are cut into pieces give what one sort of the group gives."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from gridweave.operators import picks


def rows(n=600):
    rnd = random.Random(5)
    hot = lambda: "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
    values = [None, float("nan"), 1.0, 1.0, 2.5]
    return [(i, hot(), rnd.choice(values) if rnd.random() < 0.3 else rnd.uniform(-9, 9), rnd.choice([None, 0, 1, 2, 5])) for i in range(n)]


def place(r, falling):
    v = r[2]
    nan = v is not None and v != v
    key = (v is None, (not nan if falling else nan), 0.0 if v is None or nan else (-v if falling else v), r[0])
    return key


def test_running_sums_agree_with_one_sort(spark):
    own = rows()
    df = spark.createDataFrame(own, "k int, g string, v double, s int")
    for falling in (True, False):
        want = {}
        for g in {r[1] for r in own}:
            run, of = 0, sorted((r for r in own if r[1] == g), key=lambda r: place(r, falling))
            total = sum(r[3] or 0 for r in of)
            for r in of:
                want[r[0]] = (run, total)
                run += r[3] or 0
        got = picks.running(df, "g", "v", F.col("s"), "k", falling, runs=7)
        assert {r.k: (r["_before"], r["_total"]) for r in got.collect()} == want


def test_nothing_and_one_tie(spark):
    df = spark.createDataFrame([], "k int, g string, v double, s int")
    assert picks.running(df, "g", "v", F.col("s"), "k").count() == 0
    same = spark.createDataFrame([(k, "a", 1.0, 3) for k in range(50)], "k int, g string, v double, need int")
    assert sorted(r.k for r in picks.take_top(same, "g", "v", "need", "k").collect()) == [0, 1, 2]

"""The library's operators on odd rows: nulls, empty tables, ties, hot groups; and round trips of sinks and streams."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from gridweave.operators import climate, demand, models, notes, picks, placing, shaping
from gridweave.sources import settled, shared_folder, sinks
from gridweave.streaming import hourly_load, read_stream, write_until_done


def placed_rows(n=400):
    rng = random.Random(3)
    return [(i, "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c"]), f"c{rng.randint(0, 5)}", rng.choice([None, 1, 1, 2, 5, 9]), rng.choice([None, None, None, "shop"])) for i in range(n)]


def brute_place(rows, targets, cap):
    """The reference way: caps doubled one by one for districts that fall short."""
    taken = {}
    for d in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == d]
        tagged = sum(r[4] == "shop" for r in own)
        need = max(0, targets.get(d, 0) - tagged)
        pool = sorted((r for r in own if r[4] is None), key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))
        for k in range(9):
            seen, pick = {}, []
            for r in pool:
                seen[r[2]] = seen.get(r[2], 0) + 1
                if seen[r[2]] <= cap * 2**k and len(pick) < need:
                    pick.append(r[0])
            if len(pick) >= need:
                break
        taken[d] = (need, tagged, sorted(pick))
    return taken


def test_placing_against_the_loop(spark):
    rows, targets = placed_rows(), {"hot": 60, "a": 3, "b": 10_000, "d": 4}
    df = spark.createDataFrame([(i, d, c, s, u, u) for i, d, c, s, u in rows], "bldg_id int, district string, cell string, score int, use string, est string")
    df = df.withColumn("est_w", F.lit(1.0)).withColumn("source", F.lit(None).cast("string"))
    want = spark.createDataFrame([(d, "i", n) for d, n in targets.items()], "district string, item string, target long")
    out, report = placing.place(df, want, placing.Stage("i", "shop", "commercial", F.lit(True), F.col("score"), "census", cap=1))
    brute = brute_place(rows, targets, 1)
    got = {}
    for r in out.where("source = 'census'").collect():
        got.setdefault(r["district"], []).append(r["bldg_id"])
    assert {d: sorted(got.get(d, [])) for d in brute} == {d: p for d, (_, _, p) in brute.items()}
    for r in report.collect():
        need, tagged, pick = brute[r["district"]]
        assert (r["tagged"], r["assigned"], r["shortfall"]) == (tagged, len(pick), need - len(pick))
        assert min(r["tagged"], r["target"]) + r["assigned"] + r["shortfall"] == r["target"]
    empty, told = placing.place(df.limit(0), want, placing.Stage("i", "shop", "commercial", F.lit(True), F.col("score"), "census"))
    assert empty.count() == told.count() == 0


def test_households_meet_what_homes_can_hold(spark):
    rows = [(i, "a", i % 3 > 0, i % 4 + 1, i * 7 % 11) for i in range(40)] + [(100, "b", True, 2, 1), (101, None, True, 2, 1)]
    df = spark.createDataFrame(rows, "bldg_id int, district string, urban boolean, floors int, s int").withColumn("use", F.lit(None).cast("string"))
    want = spark.createDataFrame([("a", 50, 45, 5), ("b", 9, 9, 0)], "district string, total int, town int, country int")
    out = {r["bldg_id"]: r["households"] for r in placing.households(df, want, F.lit(True), F.col("s"), F.col("floors")).collect()}
    assert sum(n for i, n in out.items() if i < 100) == 50 and sum(out[i] for i in range(40) if i % 3) == 45
    assert out[100] == 2 and out[101] == 0 and all(out[i] <= i % 4 + 1 for i in range(40))


def test_folds_balance(spark):
    df = spark.createDataFrame([(g,) for g, n in (("a", 50), ("b", 30), ("c", 25), ("d", 20), ("e", 5), ("f", 5)) for _ in range(n)], "g string")
    got = {r["g"]: r["fold"] for r in demand.greedy_folds(df, "g", 3).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 2, "e": 1, "f": 1}
    assert demand.greedy_folds(df.limit(0), "g", 3).count() == 0


def test_curves(spark):
    flat, none = [5.0] * 24, [0.0] * 24
    evening = [1.0] * 18 + [50.0] * 5 + [1.0]
    rows = [(k, *w, *w, *w) for k, w in (("flat", flat), ("none", none), ("evening", evening))]
    df = spark.createDataFrame(rows, ["k"] + [f"{p}{h}" for p in "ade" for h in range(24)])
    got = {r["k"]: r for r in demand.characteristics(df, ["k"], "a", "d", "e").collect()}
    assert (got["flat"]["shape"], got["flat"]["load_factor"], got["flat"]["peak_hour"], got["flat"]["weekday_weekend_ratio"]) == ("flat", 1.0, 0, 1.0)
    assert (got["none"]["shape"], got["none"]["peak_w"], got["none"]["peak_hour"], got["none"]["load_factor"]) == ("none", 0.0, None, None)
    assert got["evening"]["shape"] == "evening peak" and got["evening"]["peak_hour"] == 18


def test_rules_multiply_along_references(spark):
    rules = {"shop": [(F.lit(True), {"kiosk": 1.0})], "home": [(F.col("u"), {"town": 1.0}), (F.lit(True), {"farm": 1.0})], "mixed": [(F.lit(True), {"@shop": 0.5, "@home": 2.0, "kiosk": 0.25})]}
    df = spark.createDataFrame([(1, True), (2, False)], "id int, u boolean")
    got = {(r["id"], r["profile_id"]): r["weight"] for r in demand.profile_weights(df, "id", {"mixed": F.lit(3.0), "shop": F.lit(1.0)}, rules).collect()}
    assert got == {(1, "kiosk"): 0.8125, (1, "town"): 1.5, (2, "kiosk"): 0.8125, (2, "farm"): 1.5}
    with pytest.raises(ValueError):
        demand.expanded({"a": [(F.lit(True), {"@a": 1.0})]}, "a")


def test_backcast_bounds(spark):
    rng = random.Random(2)
    years = list(range(2016, 2024))
    rows = [(rng.choice("ab"), rng.choice([None, *years]), rng.randint(1, 50), *[rng.randint(1, 50) for _ in years]) for _ in range(300)]
    df = spark.createDataFrame(rows, "d string, first_y int, potential long, " + ", ".join(f"e{y} long" for y in years))
    out = demand.back_cast(df, "d", 2023, years, [2025], 0.03).collect()
    assert len(out) == 2 * 9 and all(0 <= r["presence_weight"] <= 1 for r in out if r["presence_weight"] is not None)
    for r in out:
        if r["kind"] == "base":
            assert r["stock_index"] == 1 and r["expected"] == sum(x[-1] for x in rows if x[0] == r["d"])


def test_shaping(spark):
    df = spark.createDataFrame([(1, {"a": 1.0, "b": 1.0}), (2, {"_x": 5.0}), (3, None), (4, {"b": 3.0, "a": 1.0})], "id int, p map<string,double>")
    got = {r["id"]: (r["v"], r["t"]) for r in df.select("id", shaping.vector(F.col("p"), ["a", "b", "c"]).alias("v")).select("id", "v", shaping.top_class(F.col("v"), ["a", "b", "c"]).alias("t")).collect()}
    assert got[1] == ([0.5, 0.5, 0.0], "a") and got[2][0] is None and got[3][0] is None and got[4] == ([0.25, 0.75, 0.0], "b")
    v = spark.createDataFrame([(10.0, 10.0, None, None), (31.0, 10.0, None, None), (16.0, 10.0, None, None), (5.0, None, 1.0, 9.0), (1.0, None, None, None)], "s double, v double, l double, h double")
    assert [r[0] for r in v.select(shaping.verdict(*(F.col(c) for c in "svlh"))).collect()] == ["ok", "fail", "check", "ok", None]
    old = spark.createDataFrame([(1, "o"), (2, "o"), (2, "o")], "k int, v string")
    assert sorted(map(tuple, shaping.upsert(old, old.where("k = 2").limit(1).withColumn("v", F.lit("n")), ["k"]).collect())) == [(1, "o"), (2, "n")]
    assert {r["k"]: r["missing"] for r in shaping.reconciled({"x": old.select("k"), "y": old.where("k = 1").select("k"), "z": old.limit(0).select("k")}, "k").collect()} == {1: "z", 2: "y,z"}


def test_notes(spark):
    rows = [(1, '{"label": "a", "probs": {"a": 1, "b": 3}, "abstain": false}', False, 1), (1, "no", False, 2), (2, '{"label": "a", "probs": {"a": 2}, "abstain": true}', False, 1), (3, '{"label": "a", "probs": {}}', True, 1), (4, None, False, 1)]
    df = spark.createDataFrame(rows, "id int, answer string, refused boolean, at int")
    got = {r["id"]: (r["label"], r["confidence"], r["abstain"]) for r in notes.parsed_labels(df, ["id"], "answer", F.col("refused"), "at").collect()}
    assert got == {1: ("unknown", None, True), 2: ("a", 1.0, True), 3: ("unknown", None, True), 4: ("unknown", None, True)}
    t = spark.createDataFrame([(1, "- 5 homes, see a.org\r\n* none\n- 7 of https://x.io/a) b"), (2, None), (3, "")], "id int, t string")
    assert [tuple(r) for r in notes.bullet_claims(t, "id", "t").orderBy("place").collect()] == [(1, 0, "5 homes, see a.org", "a.org"), (1, 1, "7 of https://x.io/a) b", "https://x.io/a")]
    z = spark.createDataFrame([("g", float(x)) for x in (1, 2, 3, 4, 100)] + [("h", 1.0)] * 6 + [("s", 1.0)], "g string, v double")
    got = {(r["g"], r["v"]): r["z"] for r in notes.robust_z(z, "g", "v").collect()}
    assert abs(got["g", 100.0] - 97 / 1.4826) < 1e-9 and got["h", 1.0] is None and got["s", 1.0] is None


def test_climate(spark):
    df = spark.createDataFrame([(20.0, 20.0), (20.0, 30.0), (20.0, 10.0)], "t double, d double")
    rh = [r[0] for r in df.select(climate.humidity(F.col("t"), F.col("d"))).collect()]
    assert rh[0] == 100 and rh[1] == 100 and abs(rh[2] - 52.55) < 0.2
    known = spark.createDataFrame([(0.1, 5)], "x double, e int")
    assert climate.looked_up(spark.createDataFrame([(0.1000001,)], "x double"), known, ["x"], 1, "e").first()["e"] == 5
    with pytest.raises(ValueError):
        climate.looked_up(spark.createDataFrame([(0.2,)], "x double"), known, ["x"], 1, "e")


def test_lapse_shift_comes_before_thresholds(spark):
    """Nodes whose temperature falls by a degree a unit of height: a lower place is warmer by that, and its degree days grow."""
    days = [(i, 0, f"2020-01-{d:02d}", 20.0 - 5 * i, 25.0 - 5 * i, 5.0 * i) for i in (0, 1) for d in range(1, 11)]
    df = spark.createDataFrame(days, "i long, j long, day string, mean double, top double, elev double").withColumn("day", F.to_date("day"))
    places = spark.createDataFrame([(1, 0.5, 0.0, 2.5), (2, 0.5, 0.0, 0.0), (3, 0.5, 0.0, 5.0)], "id int, x double, y double, elev double")
    got = {r["id"]: r for r in climate.composite(places, df, "id", [18.0]).collect()}
    assert [round(got[i]["mean"], 9) for i in (1, 2, 3)] == [17.5, 20.0, 15.0]
    assert [round(got[i]["over_18"], 9) for i in (1, 2, 3)] == [0.0, 20.0, 0.0] and got[2]["days"] == 10


def test_sinks(spark):
    df = spark.createDataFrame([(1, "a", float("nan"), 1.0, 2.0), (2, None, float("inf"), 1.0, 2.0), (3, "", 5.0, None, None)], "id long, s string, v double, lon double, lat double")
    at = f"{shared_folder(spark)}/t-{random.random()}"
    sinks.write_csv(df.select("id", "s"), f"{at}/csv")
    assert sorted(map(tuple, sinks.read_csv(spark, f"{at}/csv", df.select("id", "s").schema).collect())) == [(1, "a"), (2, None), (3, "")]
    sinks.write_geojson(df, f"{at}/geo", "lon", "lat")
    got = {r["id"]: (r["s"], r["v"], r["lon"]) for r in sinks.read_geojson(spark, f"{at}/geo", "id long, s string, v double").collect()}
    assert got == {1: ("a", None, 1.0), 2: (None, None, 1.0), 3: ("", 5.0, None)}
    sinks.write_partitioned(df, f"{at}/by", "s", "id")
    assert spark.read.parquet(f"{at}/by").count() == 3
    assert sinks.sample_rows(df, 2, "id", 1).collect() == sinks.sample_rows(df.repartition(3), 2, "id", 1).collect()
    calls = sinks.get_or_call(spark.createDataFrame([(1,), (1,), (2,)], "k long"), spark.createDataFrame([(2, 20)], "k long, value long"), "k", lambda k: k * 100)
    assert sorted(map(tuple, calls.collect())) == [(1, 100, False), (2, 20, True)]
    files = spark.createDataFrame([("a", "1.9", "p"), ("a", "1.10", "q"), ("b", "2", "r")], "name string, version string, path string")
    assert {r["name"]: r["path"] for r in sinks.latest(files, "name", "version").collect()} == {"a": "q", "b": "r"}
    assert settled(df.limit(0)).count() == 0


def test_stream_goes_on_where_it_stopped(spark):
    at = f"{shared_folder(spark)}/s-{random.random()}"
    rows = lambda h, ids: spark.createDataFrame([(i, i % 2, f"2020-01-01 {h:02d}:{i % 60:02d}:00", 1.0) for i in ids], "id long, k long, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    rows(1, range(10)).write.parquet(f"{at}/in", mode="append")
    schema = rows(1, [1]).schema
    run = lambda: write_until_done(hourly_load(read_stream(spark, f"{at}/in", schema), "k", "ts", "v", "id"), f"{at}/out", f"{at}/check")
    run()
    rows(1, range(5, 12)).write.parquet(f"{at}/in", mode="append")  # some come again
    run()
    rows(9, [100]).write.parquet(f"{at}/in", mode="append")
    run()
    run()
    got = {(r["k"], r["hour"].hour): (r["n"], r["total"]) for r in spark.read.parquet(f"{at}/out").collect()}
    assert got[0, 1] == (6, 6.0) and got[1, 1] == (6, 6.0)
    batch = {(r["k"], r["hour"].hour): r["n"] for r in hourly_load(rows(1, range(10)), "k", "ts", "v", "id").collect()}
    assert batch == {(0, 1): 5, (1, 1): 5}


def test_models_beat_the_baseline(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        x, n = rng.uniform(-2, 2), rng.randint(0, 40)
        p = 1 / (1 + math.exp(-2 * x))
        rows.append((i, i % 3, x if rng.random() < 0.9 else None, n, sum(rng.random() < p for _ in range(n))))
    df = spark.createDataFrame(rows, "id int, fold int, x double, n int, yes int").where("n > 0")
    got = {r["model"]: r["logloss"] for r in models.cross_validated(df, ["x"], "yes", "n", "fold", 3, ("logistic",)).collect()}
    assert got["ceiling"] < got["logistic"] < got["baseline"] - 0.1
    assert models.best_model(spark.createDataFrame([("b", 0.2), ("a", 0.2), ("baseline", 0.1)], "model string, logloss double")) == "a"


def test_running_sums_with_one_hot_value(spark):
    df = spark.createDataFrame([(i, "g", 1.0, 1) for i in range(500)], "id int, g string, v double, s int")
    assert sorted(r["_before"] for r in picks.running(df, "g", "v", F.col("s"), "id").collect()) == list(range(500))

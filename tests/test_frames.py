"""Sliced evaluation of large groups must give what the plain window gives."""

from __future__ import annotations

import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsguard.operators import frames as FR
from obsguard.operators import quantiles as QN
from obsguard.operators import temporal as TP
from obsguard.operators import joins as J
from obsguard.operators.joins import nearest_in_time, neighbour_pairs


@pytest.fixture(scope="module")
def skewed(spark):
    """One station with most rows, one with few, one with a burst at one instant, and a null station."""
    rng = random.Random(7)
    rows, i = [], 0
    for station, n in (("hot", 900), ("small", 7), ("burst", 120), (None, 90), ("single", 1)):
        t = 0
        for _ in range(n):
            t += 0 if station == "burst" else rng.choice([1, 5, 30, 60, 60, 3000]) * 60
            rows.append((i * 7919 % 2003, station, t, float(rng.choice([1, 1, 1, 2, 3, 9])) if rng.random() > 0.05 else None))
            i += 1
    df = spark.createDataFrame(rows, "id long, station string, t long, x double")
    # Ids say nothing about time; some times are unknown.
    ts = F.when(F.col("id") % 37 != 5, F.timestamp_seconds("t").cast("timestamp_ntz"))
    return df.withColumn("ts", ts).drop("t").persist()


CHECKS = [
    TP.step("step", "x", "ts", 3.0, 30, 90),
    TP.spike("spike", "x", 1.5),
    TP.persistence("still", "x", 4, 0.0, 75.0),
    TP.repeated_pattern("pattern", "x", 2, 2),
    TP.decreasing_accumulation("decrease", "x"),
    TP.rolling_z("z", "x", 10, 1.5),
    TP.enough_rows("enough", 8),
]


@pytest.mark.parametrize("days", [0.01, 0.2, 3.0])
def test_slices_equal_plain_windows(skewed, days):
    plain = TP.apply_checks(skewed, ["station"], ["ts", "id"], CHECKS, 1e6)
    sliced = TP.apply_checks(skewed, ["station"], ["ts", "id"], CHECKS, days)
    assert sliced.columns == plain.columns
    assert sliced.count() == skewed.count()
    assert sliced.exceptAll(plain).count() == 0
    flags = {r[0] for c in ("step", "spike", "still", "pattern", "decrease", "z") for r in plain.select(c).collect()}
    assert {"PASS", "SUSPECT", "NOT_CHECKED"} <= flags


def test_slices_are_consecutive_and_bounded(skewed):
    split, cuts = FR.with_slices(skewed, ["ts", "id"], 0.2, 100)
    rows = [(r["ts"] is not None, r["ts"], r["id"], r[cuts[0]], r[cuts[1]]) for r in split.filter("station = 'hot'").collect()]
    rows.sort(key=lambda r: (r[0], r[1] if r[0] else 0, r[2]))
    slices = [r[3:] for r in rows]
    changes = sum(a != b for a, b in zip(slices, slices[1:], strict=False))
    assert changes + 1 == len(set(slices)) > 5


def test_unknown_times_with_text_ids_stay_spread(spark):
    df = spark.range(20_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("record_id"), F.lit("s").alias("station"),
        F.lit(None).cast("timestamp_ntz").alias("ts"), (F.col("id") % 7).cast("double").alias("x"),
    )
    split, cuts = FR.with_slices(df, ["ts", "record_id"])
    sizes = [r[0] for r in split.groupBy("station", *cuts).count().select("count").collect()]
    assert max(sizes) < 100 and len(sizes) > 1000
    plan = TP.apply_checks(df, ["station"], ["ts", "record_id"], [TP.step("step", "x", "ts", 3.0, 30, 90)])
    assert plan.count() == 20_000


def test_text_order_is_cut_by_its_values(spark):
    df = spark.range(600).select("id", F.lit(1).alias("k"), F.concat(F.lit("f"), (F.col("id") % 4).cast("string")).alias("file"))
    plain = df.withColumn("o", TP.out_of_source_order("o", "id").stages[0](W.partitionBy("k").orderBy("file", "id"))["o"])
    sliced = TP.apply_checks(df, ["k"], ["file", "id"], [TP.out_of_source_order("o", "id")])
    assert sliced.select(*plain.columns).exceptAll(plain).count() == 0 and sliced.count() == 600


def test_building_a_plan_runs_no_job(spark, skewed):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    TP.apply_checks(skewed, ["station"], ["ts", "id"], CHECKS)
    QN.robust_statistics(skewed, ["station"], "x")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(size=700).round(3), "b": rng.integers(0, 5, 60).astype(float), "c": np.array([4.5])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, x double")
    out = QN.robust_statistics(df, ["g"], "x", {"p1": 0.01, "p75": 0.75, "p99": 0.99})
    for r in out.collect():
        vs = groups[r["g"]]
        for name, p in (("p1", 1), ("median", 50), ("p75", 75), ("p99", 99)):
            assert r[name] == pytest.approx(np.percentile(vs, p), abs=1e-9)
        assert r["mad"] == pytest.approx(np.median(np.abs(vs - np.median(vs))), abs=1e-8)
        assert r["mean"] == pytest.approx(vs.mean())
        assert r["n"] == len(vs)
        if len(vs) > 1:
            assert r["std"] == pytest.approx(vs.std(ddof=1))
        else:
            assert r["std"] is None


def test_nearest_in_time_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(4), rng.randrange(0, 20000), float(i)) for i in range(300)]
    pairs = [(a, b) for a in range(4) for b in range(4) if a != b]
    df = spark.createDataFrame(rows, "event_id long, station_id int, t long, value double").withColumn(
        "ts", F.timestamp_seconds("t").cast("timestamp_ntz")
    )
    p = spark.createDataFrame(pairs, "station int, neighbour int")
    got = {
        (r["event_id"], r["neighbour"]): r["neighbour_id"] for r in nearest_in_time(df, df, p, 600).collect()
    }
    want = {}
    for i, s, t, _ in rows:
        for a, b in pairs:
            near = [(abs(t2 - t), t2, j) for j, s2, t2, _ in rows if a == s and s2 == b and abs(t2 - t) <= 600]
            if near:
                want[(i, b)] = min(near)[2]
    assert got == want and len(want) > 100


def _flat(matched):
    return sorted(
        (r["event_id"], r["station"], m["neighbour"], m["neighbour_id"], m["neighbour_value"], m["gap_us"]) for r in matched.collect() for m in r["matches"]
    )


@pytest.mark.parametrize("held, candidates", [(100_000, 1_000_000), (50, 40)])
def test_nearest_around_equals_match_over_pairs(spark, monkeypatch, held, candidates):
    # few rows held and few candidates at once: groups and times go on over the batches a task is given
    monkeypatch.setattr(J, "MATCH_ROWS", held)
    monkeypatch.setattr(J, "MATCH_CANDIDATES", candidates)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    rng = random.Random(11)
    # cubes of 1,200 km: stations on both sides of their faces, at a pole, over the date line; one without a place, one listed twice
    places = [(f"s{i}", rng.uniform(-9, 9), rng.uniform(-9, 9)) for i in range(25)]
    places += [("p", 89.5, 10.0), ("q", 89.5, -170.0), ("d", 1.0, 179.9), ("e", 1.0, -179.9), ("n", None, 3.0), ("s0", *places[0][1:])]
    stations = spark.createDataFrame(places, "station_id string, latitude double, longitude double")
    names = sorted({p[0] for p in places}) + ["unknown"]
    rows = [
        (i, rng.choice(names), rng.randrange(0, 60_000, 100), None if i % 17 == 0 else float(rng.randrange(50))) for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "event_id long, station_id string, t long, value double").withColumn(
        "ts", F.when(F.col("event_id") % 41 != 0, F.timestamp_seconds("t").cast("timestamp_ntz"))
    )
    try:
        got = _flat(J.nearest_around(df, df, stations, 300.0, 1800))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs = neighbour_pairs(stations.dropDuplicates(), 300.0)
    want = sorted(tuple(r) for r in nearest_in_time(df, df, pairs, 1800).select("event_id", "station", "neighbour", "neighbour_id", "neighbour_value", "gap_us").collect())
    assert got == want and len(want) > 1000


def test_exchange_of_the_neighbour_match_grows_as_the_observations(spark):
    # four times the stations on the same ground, the same observations each: an exchanged row for each
    # pair of stations would make sixteen times the rows
    from coverage_queries import q_joins

    def exchanged(n, folder):
        spark.range(n).selectExpr("id AS c_custkey", "CAST(id AS STRING) AS c_name").write.parquet(f"{folder}/customer.parquet")
        spark.range(4 * n).selectExpr(
            "id AS event_id", f"id % {n} AS user_id", "CAST(timestamp_seconds(id * 977 % 86400) AS timestamp_ntz) AS ts",
            "CAST(id % 90 AS DOUBLE) AS value",
        ).write.parquet(f"{folder}/events.parquet")
        matched = q_joins.nearest(spark, folder)
        matched.collect()
        return _exchanged_rows(matched)

    with tempfile.TemporaryDirectory() as small, tempfile.TemporaryDirectory() as large:
        few, many = exchanged(2000, small), exchanged(8000, large)
    assert 8000 < few and many < 5 * few


def _exchanged_rows(df):
    """Rows written by all exchanges of the plan that ran."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_spatial_flags_from_arrays_of_matches(spark):
    from obsguard.operators.references import spatial_flags

    obs = spark.createDataFrame([(1, 10.0), (2, 100.0), (3, 5.0), (4, 60.0), (5, None)], "event_id long, value double")
    values = [(1, [9.0, 12.0, 80.0]), (2, [1.0, 59.0]), (3, [500.0]), (5, [1.0, 2.0])]
    matches = spark.createDataFrame(
        [(i, [(v,) for v in vs]) for i, vs in values], "event_id long, matches array<struct<neighbour_value: double>>"
    )
    got = {r[0]: tuple(r)[1:] for r in spatial_flags(obs, matches, 40.0).select(
        "event_id", "neighbours", "spatial_neighbor_difference", "spatial_isolated_extreme").collect()}
    assert got == {
        1: (3, "PASS", "PASS"), 2: (2, "SUSPECT", "SUSPECT"), 3: (1, "NOT_CHECKED", "NOT_CHECKED"),
        4: (0, "NOT_CHECKED", "NOT_CHECKED"), 5: (2, "NOT_CHECKED", "NOT_CHECKED"),
    }


def test_neighbour_pairs_across_pole_and_date_line(spark):
    places = [("a", 0.0, 179.5), ("b", 0.0, -179.5), ("c", 89.5, 0.0), ("d", 89.5, 180.0), ("e", -12.0, -77.0), ("f", -14.6, -77.0)]
    df = spark.createDataFrame(places, "station_id string, latitude double, longitude double")
    found = {(r[0], r[1]) for r in neighbour_pairs(df, 300.0).select("station", "neighbour").collect()}
    assert found == {("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("e", "f"), ("f", "e")}


def test_deviation_of_large_values_does_not_cancel(spark):
    rows = [("a", 1e9 + k, 2000 + k) for k in (0, 1, 2)] + [("b", 101325 + 0.01 * k, 1950 + k) for k in range(80)] + [("c", None, 1990), ("d", 7.0, 1990)]
    df = spark.createDataFrame(rows, "g string, x double, year int")
    out = {r["g"]: r for r in QN.robust_statistics(df, ["g"], "x", year="year").collect()}
    assert out["a"]["std"] == pytest.approx(1.0, abs=1e-9) and out["a"]["years"] == 3
    assert out["b"]["std"] == pytest.approx(np.std([0.01 * k for k in range(80)], ddof=1), abs=1e-7) and out["b"]["years"] == 80
    assert set(out) == {"a", "b", "d"} and out["d"]["std"] is None and out["d"]["mad"] == 0.0


def test_statistics_read_the_input_once(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = QN.robust_statistics(orders, ["o_orderpriority"], "o_totalprice", {"p1": 0.01}, "o_custkey")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_short_slices_are_evaluated_once(spark, skewed):
    """A group of few rows a slice costs one evaluation: it is stitched whole and its slices are left out."""
    days = 0.5
    split, cuts = FR.with_slices(skewed, ["ts", "id"], days, FR.SLICE_NUMBERS)
    sizes = {r["count"] for r in split.groupBy("station", *cuts).count().collect()}
    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x

    mark = F.udf(touch, "double")

    def compute(frame, w):
        return frame.withColumn("out", F.coalesce(F.lag(mark("x")).over(w), F.lit(-1.0)))

    out = FR.over_ordered_groups(skewed, ["station"], ["ts", "id"], 8, compute, days)
    assert max(sizes) <= FR.WHOLE_REACHES * 8 and out.count() == skewed.count()
    out.write.format("noop").mode("overwrite").save()
    assert seen.value == skewed.count()


def test_members_of_the_union_share_what_lies_below(spark):
    """Columns that are renamed before the frames must not keep the exchange from being used twice."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    renamed = events.selectExpr("event_id AS event_id", "ts", "user_id AS station", "value AS value").selectExpr("event_id AS id", "ts AS ts", "station", "value AS x")
    out = TP.apply_checks(renamed, ["station"], ["ts", "id"], [TP.step("step", "x", "ts", 3.0)])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert plan.count("Scan parquet") == 1 and "ReusedExchange" in plan

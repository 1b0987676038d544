"""Skew-safe order statistics against plain brute force, on both join paths."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tickloom.operators import charts, model, spread, updates
from tickloom.operators.bars import latest_per_symbol, ohlc_bars


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Keep the small test tables in several partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    # One symbol owns most rows; one is null; times repeat.
    symbols = ["hot"] * 8 + ["a", "b", None]
    return [
        (rng.choice(symbols), rng.randrange(400), i, float(rng.randrange(50)) / 2) for i in range(3000)
    ] + [("single", 5, 9999, 1.0)]


@pytest.fixture(scope="module")
def ticks(spark, rows):
    df = spark.createDataFrame(rows, "stock string, s long, event_id long, price double")
    return df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).repartition(7)


def by_symbol(rows):
    groups = {}
    for stock, s, i, price in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(stock, []).append((s, i, price))
    return groups


def test_row_numbers(ticks, rows):
    got = spread.row_numbers(ticks, ["stock"], ["ts", "event_id"], "rn", "n").collect()
    want = {
        (stock, i): (n + 1, len(group))
        for stock, group in by_symbol(rows).items()
        for n, (_, i, _) in enumerate(group)
    }
    assert len(got) == len(rows)
    assert {(r["stock"], r["event_id"]): (r["rn"], r["n"]) for r in got} == want


def test_range_partitions_grow_with_the_rows(spark, ticks, rows):
    asked = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, len(rows) // (4 * asked))
    assert spread.range_partitions(ticks) == []
    assert spread.range_partitions(ticks, size) == [-(-len(rows) // size)]
    chunked = spread.ordered_chunks(ticks, ["stock"], ["ts", "event_id"], size)
    assert chunked.select("__chunk").distinct().count() > 2 * asked
    assert chunked.count() == len(rows)


def test_running_total(ticks, rows):
    weighted = ticks.withColumn("w", F.col("event_id") % 5)
    chunked = spread.ordered_chunks(weighted, ["stock"], ["ts", "event_id"])
    assert chunked.select("__chunk").distinct().count() > 1
    hot = chunked.filter("stock = 'hot'").select("__chunk").distinct().count()
    assert hot > 1, "a hot key must span several partitions"
    got = spread.running_total(chunked, ["stock"], "w", "upto", "total").collect()
    want = {}
    for stock, group in by_symbol(rows).items():
        total = sum(i % 5 for _, i, _ in group)
        run = 0
        for _, i, _ in group:
            run += i % 5
            want[(stock, i)] = (run, total)
    assert {(r["stock"], r["event_id"]): (r["upto"], r["total"]) for r in got} == want


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_attach_per_key_paths_agree(ticks, rows, broadcast_rows):
    per_key = ticks.groupBy("stock").agg(F.count("*").alias("n"), F.max("price").alias("top"))
    got = spread.attach_per_key(
        ticks, per_key, ["stock"], "n", broadcast_rows=broadcast_rows, rows_per_slice=100
    )
    assert got.count() == len(rows)
    groups = by_symbol(rows)
    for r in got.select("stock", "n", "top").distinct().collect():
        assert (r["n"], r["top"]) == (len(groups[r["stock"]]), max(p for _, _, p in groups[r["stock"]]))


def test_salted_path_spreads_a_hot_key(ticks):
    per_key = ticks.groupBy("stock").agg(F.count("*").alias("n"))
    plan = spread.attach_per_key(ticks, per_key, ["stock"], "n", broadcast_rows=0, rows_per_slice=100)
    assert "__salt" in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("max_points, bucket", [(1000, 60), (100, 60), (7, 60), (7, 1), (50, 100000)])
def test_stride_sample(ticks, rows, max_points, bucket):
    got = charts.stride_sample(ticks, ["stock"], ["ts", "event_id"], max_points, bucket).collect()
    want = set()
    for stock, group in by_symbol(rows).items():
        step = max(1, len(group) // max_points)
        want |= {(stock, i) for _, i, _ in group[::step]}
        assert len(group[::step]) <= 2 * max_points
    assert len(got) == len(want)
    assert {(r["stock"], r["event_id"]) for r in got} == want


def test_box_summary(ticks, rows):
    got = {r["stock"]: r for r in charts.box_summary(ticks, ["stock"], "price").collect()}
    groups = by_symbol(rows)
    assert set(got) == set(groups)
    for stock, group in groups.items():
        values = sorted(p for _, _, p in group)
        if len(values) > 1:
            q1, q2, q3 = statistics.quantiles(values, n=4, method="inclusive")
        else:
            q1 = q2 = q3 = values[0]
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = [v for v in values if low <= v <= high]
        r = got[stock]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["whisker_low"], r["whisker_high"]) == (inside[0], inside[-1])
        assert (r["n"], r["outliers"]) == (len(values), len(values) - len(inside))


def test_relative_returns(ticks, rows):
    shifted = ticks.withColumn("price", F.col("price") + 1)
    got = charts.relative_returns(shifted, ["stock"], ["ts", "event_id"], "price").collect()
    groups = by_symbol(rows)
    for r in got:
        assert r["return"] == pytest.approx(r["price"] / (groups[r["stock"]][0][2] + 1) - 1)
    assert len(got) == len(rows)


def test_following_matches_lead(ticks, rows):
    unique = ticks.groupBy("stock", "ts", "s").agg(F.min("price").alias("price"))
    chunk = F.floor(F.col("s") / 50)
    got = spread.following(unique, ["stock"], "ts", chunk, "price", "next")
    want = {}
    groups = {}
    for r in unique.collect():
        groups.setdefault(r["stock"], []).append((r["s"], r["price"]))
    for stock, group in groups.items():
        group.sort()
        for (s, _), following in zip(group, [*group[1:], (None, None)]):
            want[(stock, s)] = following[1]
    assert {(r["stock"], r["s"]): r["next"] for r in got.collect()} == want


def test_bars_and_latest(ticks, rows):
    bars = {(r["stock"], r["bar_start"].timestamp()): r for r in ohlc_bars(ticks, "2 minutes").collect()}
    groups = {}
    for stock, s, i, price in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault((stock, s // 120 * 120), []).append(price)
    assert len(bars) == len(groups)
    for r in bars.values():
        assert r["low"] <= min(r["open"], r["close"]) and r["high"] >= max(r["open"], r["close"])
    got = sorted(
        ((r["stock"] or "", r["open"], r["close"], r["volume"]) for r in bars.values())
    )
    assert got == sorted((k[0] or "", g[0], g[-1], float(len(g))) for k, g in groups.items())
    latest = latest_per_symbol(ticks, ["ts", "event_id"], ["event_id"]).collect()
    assert {r["stock"]: r["event_id"] for r in latest} == {
        stock: group[-1][1] for stock, group in by_symbol(rows).items()
    }


def test_last_per_key_is_idempotent(ticks):
    once = updates.last_per_key(ticks, ["stock", "s"], ["event_id"])
    twice = updates.last_per_key(once, ["stock", "s"], ["event_id"])
    assert once.columns == ticks.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.count() == ticks.select("stock", "s").distinct().count()


def test_hashed_and_struct_picks_agree(spark, ticks):
    one = ticks.select("stock", "s", "event_id", "price").withColumn(
        "price", F.when(F.col("event_id") % 3 > 0, F.col("price"))
    )
    hashed = updates.last_per_key(one, ["stock"], ["event_id"])
    with_text = updates.last_per_key(one.withColumn("text", F.lit("x")), ["stock"], ["event_id"])
    assert sorted(map(str, hashed.collect())) == sorted(map(str, with_text.drop("text").collect()))


def test_live_rows_win(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], "stock string, d int, v double")
    new = spark.createDataFrame([("A", 2, 9.0), ("A", 3, 3.0)], "stock string, d int, v double")
    got = updates.history_then_live(old, new, ["stock", "d"]).collect()
    assert sorted(got) == [("A", 1, 1.0), ("A", 2, 9.0), ("A", 3, 3.0)]


def test_models_per_key_with_collinear_and_constant_features(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        x, z = rng.random(), rng.random()
        rows.append(("plain", x, z, 1 + 2 * x - 3 * z))
        rows.append(("collinear", x, 2 * x, 5 + x))
        rows.append(("constant", 4.0, z, 7 - z))
    rows.append(("single", 1.0, 2.0, 3.0))
    df = spark.createDataFrame(rows, "k string, x double, z double, y double")
    models = model.least_squares_per_key(df, ["k"], ["x", "z"], "y")
    plain = models.filter("k = 'plain'").first()
    assert (plain["intercept"], plain["coef_x"], plain["coef_z"]) == pytest.approx((1, 2, -3))
    scored = model.score_per_key(df, models, ["k"], ["x", "z"])
    assert scored.count() == len(rows)
    worst = scored.select(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert worst < 1e-6


def test_key_split_is_repeatable(ticks):
    keys = [F.col("stock"), F.col("event_id").cast("string")]
    train, test = model.split_by_key(ticks, 0.8, *keys)
    again, _ = model.split_by_key(ticks.repartition(2), 0.8, *keys)
    ids = lambda df: {r[0] for r in df.select("event_id").collect()}
    assert ids(train) == ids(again)
    assert not ids(train) & ids(test) and len(ids(train) | ids(test)) == ticks.count()


def test_live_versions_of_a_bar_have_a_defined_order(spark):
    old = spark.createDataFrame([("A", 1, 1.0, 0)], "stock string, d int, close double, at int")
    live = [("A", 1, 5.0, 2), ("A", 1, 6.0, 1)]
    for rows in (live, live[::-1]):
        new = spark.createDataFrame(rows, old.schema)
        assert updates.history_then_live(old, new, ["stock", "d"], ["at"]).first()["close"] == 5.0
        assert updates.history_then_live(old, new, ["stock", "d"]).first()["close"] == 6.0


def test_salted_join_of_rows_with_maps(spark):
    rows = spark.range(200).select((F.col("id") % 7).alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
    per_key = rows.groupBy("k").agg(F.count("*").alias("n"))
    for broadcast_rows in (0, 3, 100):
        got = spread.attach_per_key(rows, per_key, ["k"], "n", broadcast_rows=broadcast_rows, rows_per_slice=5)
        assert got.count() == 200 and got.filter("n IS NULL").count() == 0


def test_values_of_many_keys_come_with_one_shuffle(spark):
    """Few rows per key, one hot key and null keys: the same values on every path."""
    rng = random.Random(5)
    keys = [(None, 1), (None, None), (7, 7), *((i, i % 3) for i in range(300))]
    rows = [(*k, n, float(rng.randrange(9))) for n, k in enumerate(rng.choices(keys, k=900) + [(7, 7)] * 400)]
    df = spark.createDataFrame(rows, "a long, b long, n long, v double").repartition(5)
    want = {}
    for a, b, n, v in sorted(rows, key=lambda r: (r[3], r[2])):
        want.setdefault((a, b), (n, v))
    values = {"first": F.min_by("n", F.struct("v", "n")), "least": F.min("v")}
    for buckets, per_slice in ((131_072, 5_000_000), (64, 5_000_000), (64, 100), (64, 1)):
        got = spread.with_key_values(df, ["a", "b"], values, buckets, per_slice, rows_per_task=50).collect()
        assert sorted(r["n"] for r in got) == [r[2] for r in rows]
        assert {(r["a"], r["b"]): (r["first"], r["least"]) for r in got} == want


def test_series_returns(spark, monkeypatch):
    rows = [(1, 1, 5, 2.0, 0.0), (1, 2, 4, 4.0, 3.0), (1, 3, 4, 3.0, None), (2, 1, 1, None, 8.0), (2, 2, 2, 1.0, 4.0), (None, 1, 1, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "k long, id long, at long, x double, y double")
    want = {(1, 1, "x"): -1 / 3, (1, 2, "x"): 1 / 3, (1, 3, "x"): 0.0, (2, 1, "y"): 0.0, (2, 2, "y"): -0.5, (None, 1, "x"): 0.0, (None, 1, "y"): 0.0}
    for buckets in (131_072, 2):
        monkeypatch.setattr(spread.with_key_values, "__defaults__", (buckets, *spread.with_key_values.__defaults__[1:]))
        got = charts.series_returns(df, ["k"], ["at"], ["x", "y"])
        assert got.columns == ["k", "id", "at", "series", "value", "return"]
        assert {(r["k"], r["id"], r["series"]): r["return"] for r in got.collect()} == pytest.approx(want)

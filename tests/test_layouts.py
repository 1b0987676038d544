"""Roll-ups, rolling models, pruned and mixed files, and lists of keys as filters of a scan."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import charts, model
from tickloom.operators.spread import attach_per_key
from tickloom.sources import files
from tickloom.sources.sorted import files_in_range, read_range, write_sorted


def test_listed_keys_filter_the_scan(spark, tmp_path, monkeypatch):
    """Beyond the broadcast bound only rows of listed keys, and few others, reach the shuffle."""
    rows = spark.range(200_000).select((F.col("id") % 20_000).alias("k"), F.col("id").alias("v"))
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    listed = spark.range(0, 20_000, 40).select(F.col("id").alias("k"), F.lit(10).alias("n"), (F.col("id") * 2).alias("x"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        joined = attach_per_key(rows, listed, ["k"], "n", broadcast_rows=0, how="inner")
        plan = joined._jdf.queryExecution().executedPlan()
        assert "might_contain" in plan.toString()
        got = joined.collect()
        nodes = [plan]
        filtered = []
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            if node.nodeName() == "Filter" and "might_contain" in node.toString():
                filtered.append(node.metrics().apply("numOutputRows").value())
        assert filtered and 5_000 <= filtered[0] <= 8_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(r["v"] for r in got) == sorted(i for i in range(200_000) if i % 20_000 % 40 == 0)
    assert all(r["x"] == 2 * r["k"] for r in got)


def test_sketches_merge_to_the_same_bound(spark):
    rng = random.Random(3)
    data = [("A", d, rng.gauss(0, 1) ** 3) for d in range(20) for _ in range(3000)]
    data += [("B", d, 7.0) for d in range(3)] + [("B", 5, None), ("C", 1, None)]
    rows = spark.createDataFrame(data, "stock string, day int, price double")
    daily = charts.value_sketches(rows, ["stock", "day"], "price")
    assert daily.count() == 23
    halves = charts.merge_sketches(daily.filter("day < 9"), ["stock"]).unionByName(charts.merge_sketches(daily.filter("day >= 9"), ["stock"]))
    for sketches in (daily, halves):
        got = {r["stock"]: r for r in charts.box_of_sketches(charts.merge_sketches(sketches, ["stock"])).collect()}
        assert set(got) == {"A", "B"} and got["B"]["median"] == 7.0 and got["B"]["outlier_share"] == 0
        values = sorted(p for s, _, p in data if s == "A")
        assert (got["A"]["n"], got["A"]["least"], got["A"]["most"]) == (60_000, values[0], values[-1])
        for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            rank = sum(v <= got["A"][name] for v in values) / len(values)
            assert abs(rank - q) <= charts.SKETCH_RANK_ERROR
        reach = 1.5 * (got["A"]["q3"] - got["A"]["q1"])
        outside = sum(not got["A"]["q1"] - reach <= v <= got["A"]["q3"] + reach for v in values) / len(values)
        assert abs(outside - got["A"]["outlier_share"]) <= 2 * charts.SKETCH_RANK_ERROR + 1 / charts.OUTLIER_STEPS


def test_rolling_models_equal_models_of_their_rows(spark):
    rng = random.Random(5)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 6, 9, 10, 20)]
    data = []
    for day in days:
        for _ in range(12):
            a, b = rng.uniform(90, 110), rng.uniform(0, 5)
            data.append(("A", day, a, b, 3 + 2 * a - b + rng.gauss(0, 0.1)))
    data += [("A", days[0], None, 1.0, 1.0), ("B", days[0], 1.0, 2.0, 3.0)]
    rows = spark.createDataFrame(data, "stock string, day date, a double, b double, y double")
    sums = model.moment_sums(rows, ["stock", "day"], ["a", "b"], "y")
    rolled = model.rolling_moments(sums, ["stock"], "day", 4)
    got = {(r["stock"], r["day"]): r for r in model.models_of_moments(rolled, ["stock", "day"], ["a", "b"]).collect()}
    assert len(got) == 8 and got["B", days[0]]["coef_a"] == 0
    for day in days:
        own = rows.filter((F.col("stock") == "A") & F.col("day").between(day - dt.timedelta(days=3), day))
        want = model.least_squares_per_key(own, ["stock"], ["a", "b"], "y").first()
        for name in ("n", "intercept", "coef_a", "coef_b"):
            assert math.isclose(got["A", day][name], want[name], rel_tol=1e-5, abs_tol=1e-5)
    parts = [model.moment_sums(rows.filter(F.col("b") < 2), ["stock", "day"], ["a", "b"], "y"),
             model.moment_sums(rows.filter(F.col("b") >= 2), ["stock", "day"], ["a", "b"], "y")]
    merged = {(r["stock"], r["day"]): r for r in model.merge_moments(parts[0].unionByName(parts[1]), ["stock", "day"]).collect()}
    for r in sums.collect():
        assert math.isclose(merged[r["stock"], r["day"]]["s_0_1"], r["s_0_1"]) and merged[r["stock"], r["day"]]["n"] == r["n"]


def test_range_scans_open_few_files(spark, tmp_path):
    folder = str(tmp_path / "sorted")
    rows = spark.range(20_000).select(
        F.element_at(F.array(*map(F.lit, "AAAAAAAABC")), (F.col("id") % 10 + 1).cast("int")).alias("stock"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("event_id"),
    )
    write_sorted(rows, folder, order=["event_id"], rows_per_file=500)
    stored = len([f for f in os.listdir(f"{folder}/rows") if f.endswith(".parquet")])
    assert stored >= 40

    def lit(minute):
        return F.timestamp_seconds(F.lit(minute * 60)).cast("timestamp_ntz")

    for symbols, start, end in ((["A"], 1000, 1500), (["A", "C"], 0, 60), (["B"], 0, 20_000), (["D"], 0, 10), (["A"], 50_000, 60_000), ([], 0, 9)):
        found = read_range(spark, folder, symbols, lit(start), lit(end))
        want = rows.filter(F.col("stock").isin(symbols) & (F.col("event_id") >= start) & (F.col("event_id") < end))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        opened = files_in_range(spark, folder, symbols, lit(start), lit(end))
        assert len(opened) <= 6 and set(map(os.path.basename, found.inputFiles())) == set(map(os.path.basename, opened))


def test_files_of_different_headers(spark, tmp_path):
    texts = {
        "A": "Date,Open,Close\n2024-01-02,1,2\n2024-01-03,None,4\n",
        "B": "Close,Date,Open\n2.5,2024-01-02T10:00:00,1\n",
        "C": " Date , Open\n2024-01-02,7\n",
        "D": "Date,Open,Close,Note\n2024-01-05,3000000000,1,odd\n",
        "E+ F": "Date,Open,Close\nNone,None,None\n",
        "G": "Date,Open,Close\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    (tmp_path / "other.txt").write_text("not,a,table\n")
    found = files.read_mixed(spark, str(tmp_path))
    kinds = dict(found.dtypes)
    assert set(kinds) == {"Date", "Open", "Close", "Note", "Stock"}
    assert (kinds["Open"], kinds["Close"], kinds["Date"], kinds["Note"]) == ("bigint", "double", "timestamp", "string")
    got = {(r["Stock"], r["Open"], r["Close"], r["Note"]) for r in found.collect()}
    assert got == {("A", 1, 2.0, None), ("A", None, 4.0, None), ("B", 1, 2.5, None), ("C", 7, None, None),
                   ("D", 3000000000, 1.0, "odd"), ("E+ F", None, None, None)}
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        files.read_mixed(spark, str(tmp_path / "empty"))


def test_wider_types():
    assert files.wider("int", "double") == "double" and files.wider("bigint", "int") == "bigint"
    assert files.wider("date", "timestamp") == "timestamp" and files.wider("int", "date") == "string"

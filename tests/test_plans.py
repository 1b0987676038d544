"""Physical plans: what reaches the scan, and how often data is shuffled."""

import pytest
from pyspark.sql import functions as F

from tickloom import storage
from tickloom.operators import charts, messages, model, spread, updates
from tickloom.operators.bars import latest_per_symbol, ohlc_bars
from tickloom.plans import QUERIES
from tickloom.plans.tables import ticks


def plan_of(df):
    # The plan before adaptive execution, so that every node is listed once.
    return df._jdf.queryExecution().executedPlan().toString().split("== Final Plan ==")[0]


def test_symbol_filter_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["filter_symbol"](spark, folder))
    assert "EqualTo(event_type,view)" in plan
    plan = plan_of(QUERIES["json_extract"](spark, folder))
    assert "ReadSchema: struct<event_id:bigint,props:string>" in plan


def test_time_range_reaches_the_scan(spark, folder):
    plan = plan_of(QUERIES["bars_since_date"](spark, folder))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan


def test_bars_shuffle_once_and_combine_before(spark, folder):
    plan = plan_of(ohlc_bars(ticks(spark, folder)))
    assert plan.count("Exchange") == 1 and "partial_min_by" in plan
    primitive = plan_of(ohlc_bars(ticks(spark, folder), tie_break=None))
    assert "SortAggregate" not in primitive and "HashAggregate" in primitive


def test_last_of_fixed_width_rows_is_hashed(spark, folder):
    bars = storage.materialise(ohlc_bars(ticks(spark, folder)))
    plan = plan_of(updates.last_per_key(bars, ["stock"], ["bar_start"]))
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1
    newest = plan_of(latest_per_symbol(bars, ["bar_start"], ["bar_start", "close"]))
    assert "SortAggregate" not in newest


def test_models_per_symbol_shuffle_once(spark, folder):
    bars = storage.materialise(ohlc_bars(ticks(spark, folder)))
    plan = plan_of(model.least_squares_per_key(bars, ["stock"], ["open", "high", "low", "volume"], "close"))
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_per_symbol_values_are_broadcast_after_the_size_check(spark, folder):
    rows = ticks(spark, folder).select("stock", "ts", "event_id", "price")
    plan = plan_of(charts.relative_returns(rows, ["stock"], ["ts", "event_id"], "price"))
    assert "BroadcastHashJoin" in plan and "Window" not in plan and "hashpartitioning" not in plan


def test_returns_of_many_keys_shuffle_the_unmultiplied_rows_once(spark, folder, monkeypatch):
    monkeypatch.setattr(spread.with_key_values, "__defaults__", (64, *spread.with_key_values.__defaults__[1:]))
    plan = plan_of(QUERIES["returns_many_keys"](spark, folder))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "SortAggregate" not in plan
    # What is shuffled: the columns read, not yet series nor the structs that order them (_w0).
    assert plan.index("Generate") < plan.index("Window") < plan.index("AS _w0") < plan.index("Exchange")


def test_row_wise_work_has_no_shuffle(spark, folder):
    for name in ["market_open", "symbol_details_defaults", "html_profile", "date_formats", "quote_url"]:
        assert "AdaptiveSparkPlan" not in plan_of(QUERIES[name](spark, folder))


def test_messages_are_parsed_once(spark):
    sent = storage.materialise(spark.createDataFrame([("x",)], "value string"), "texts")
    assert plan_of(messages.accepted(sent)).count("from_json") == 1


def test_written_tables(spark):
    df = storage.materialise(spark.range(5).withColumn("x", F.col("id") * 2), "numbers")
    root = storage.application_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") in root
    assert "Range" not in plan_of(df) and df.count() == 5


def test_clearing_removes_only_working_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "working_root", lambda _: str(tmp_path))
    storage.materialise(spark.range(3), "numbers")
    (tmp_path / "other").mkdir()
    assert (tmp_path / "tickloom").exists()
    storage.clear(spark)
    assert not (tmp_path / "tickloom" / spark.sparkContext.applicationId).exists()
    assert (tmp_path / "other").exists()


def test_size_check(spark, monkeypatch):
    rows = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("k"))
    assert spread.fits_broadcast(rows) and not spread.fits_broadcast(rows, 9)
    assert spread.fits_broadcast(rows.limit(0), 0)
    monkeypatch.setattr(spread, "BROADCAST_BYTES", 5000)
    assert not spread.fits_broadcast(rows)


def test_working_folder_of_a_session_without_setting(spark):
    class Context:
        applicationId = "x"

        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        def __init__(self, context):
            self.sparkContext = context

    with pytest.raises(RuntimeError):
        storage.working_root(Session(Context("spark://host:7077")))
    local = Session(Context("local[2]"))
    assert storage.working_root(local) == storage.working_root(local)
    assert hasattr(spark.sparkContext, "getCheckpointDir")

"""Whole jobs over a folder of per-symbol files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom.plans import workflows


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    rng = random.Random(1)
    folder = tmp_path_factory.mktemp("data")
    for symbol in ("AAPL", "MSFT"):
        lines = ["Date,Open,High,Low,Close,Volume"]
        for i in range(200):
            o, h, low, v = 100 + rng.random(), 102 + rng.random(), 98 + rng.random(), float(rng.randrange(1000))
            close = 3 + 0.5 * o + 0.3 * h + 0.2 * low + 0.001 * v
            lines.append(f"2024-01-02T{i // 60:02d}:{i % 60:02d}:00,{o},{h},{low},{close},{v}")
        lines.append("2024-01-02T23:00:00,None,None,None,None,None")
        (folder / f"{symbol}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_predict_symbol_recovers_a_linear_price(spark, store):
    predictions, error = workflows.predict_symbol(spark, store, "AAPL")
    assert predictions.columns == ["features", "prediction", "Close"]
    assert dict(predictions.dtypes)["features"] == "array<double>"
    assert 10 < predictions.count() < 90
    assert error < 1e-6


def test_pooled_model_and_new_rows(spark, store):
    from tickloom.operators import model

    fitted, predictions, error = workflows.pooled_model(spark, store, policy="drop")
    assert error < 0.05 and predictions.count() > 50
    asked = spark.createDataFrame([(100.0, 102.0, 98.0, 500.0)], ["Open", "High", "Low", "Volume"])
    assert model.score(fitted, asked).first()["prediction"] == pytest.approx(103.7, abs=0.1)
    _, _, filled = workflows.pooled_model(spark, store)
    assert filled >= 0


def test_cleaned_bars(spark, store):
    rows = workflows.cleaned_bars(spark, store)
    assert rows.groupBy("Stock", "MarketClosed").count().count() == 4
    assert dict(rows.dtypes)["Close"] == "decimal(10,2)"


def test_dashboard_series(spark, store):
    assert workflows.dashboard_series(spark, store, "AAPL", []).count() == 0
    chosen = workflows.dashboard_series(spark, store, "AAPL", ["Area Chart"])
    assert chosen.count() == 3 * 201
    assert {r[0] for r in chosen.select("series").distinct().collect()} == {"Close", "High", "Low"}


def test_query_prices(spark, store):
    from tickloom.sources.files import load_symbol

    bars = load_symbol(spark, store, "MSFT")
    assert workflows.query_prices(spark, bars).count() == 200
    assert workflows.query_prices(spark, bars, "SELECT max(Close) AS top FROM stock").columns == ["top"]


def ticks(spark, last):
    return spark.createDataFrame(
        [("A", "2024-01-02 14:00:30", 1, 5.0), ("A", "2024-01-02 14:58:10", 2, 6.0), ("B", last, 3, 7.0)],
        "stock string, t string, event_id long, price double",
    ).withColumn("ts", F.col("t").cast("timestamp_ntz"))


def test_poll_sends_bars_while_open(spark):
    rows = ticks(spark, "2024-01-02 14:58:20")
    as_of = F.lit("2024-01-02 14:58:30").cast("timestamp_ntz")
    sent = {r["key"]: json.loads(r["value"]) for r in workflows.poll_messages(rows, "A,B,C", as_of).collect()}
    assert set(sent) == {"A", "B"}
    assert sent["A"]["open"] == 6.0 and sent["A"]["date"] == "2024-01-02T14:58:00"


def test_poll_sends_null_rows_while_closed(spark):
    rows = ticks(spark, "2024-01-02 23:00:00")
    as_of = F.lit("2024-01-02 23:00:10").cast("timestamp_ntz")
    sent = [json.loads(r["value"]) for r in workflows.poll_messages(rows, "A,B", as_of).collect()]
    assert [(m["stock"], m["date"], m["close"]) for m in sent] == [
        ("A", "2024-01-02T23:00:10", None),
        ("B", "2024-01-02T23:00:10", None),
    ]


def test_history_messages(spark):
    rows = ticks(spark, "2024-01-02 14:58:20")
    as_of = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    assert workflows.history_messages(rows, "", as_of).count() == 0
    assert workflows.history_messages(rows, "A", as_of).count() == 2
    assert workflows.history_messages(rows, "A,B", as_of).count() == 3

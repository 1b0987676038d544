"""Hand-made rows for the cases where the input or its order is easily misread."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickloom.functions import documents, texts, times
from tickloom.operators import clean, market, messages, model
from tickloom.schemas import BAR_TABLE, MEASURES
from tickloom.sinks.files import append_bars_by_symbol
from tickloom.sources import files
from tickloom.sources.ranges import of_symbols, symbol_list

HEADER = "Date,Open,High,Low,Close,Volume\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def bar_rows(spark, rows):
    return spark.createDataFrame(rows, BAR_TABLE)


def test_none_text_reads_as_null(spark, tmp_path):
    write(tmp_path / "A.csv", HEADER + "2024-01-02T10:00:00,1.0,2.0,0.5,1.5,10.0\n2024-01-02T20:00:00,None,None,None,None,None\n")
    fixed = files.load_symbol(spark, str(tmp_path), "A")
    assert fixed.filter(F.col("Open").isNull()).count() == 1
    inferred = files.read_bars_inferred(spark, str(tmp_path / "A.csv"))
    assert dict(inferred.dtypes)["Open"] == "double"
    assert clean.not_null(inferred).count() == 1


def test_inferring_without_null_text_keeps_strings(spark, tmp_path):
    write(tmp_path / "A.csv", HEADER + "2024-01-02T10:00:00,1.0,2.0,0.5,1.5,10.0\n2024-01-02T20:00:00,None,None,None,None,None\n")
    inferred = files.read_bars_inferred(spark, str(tmp_path / "A.csv"), null_value="")
    assert dict(inferred.dtypes)["Open"] == "string"
    assert clean.not_null(inferred).count() == 2


def test_all_null_column_infers_string(spark, tmp_path):
    write(tmp_path / "A.csv", HEADER + "2024-01-02T20:00:00,None,None,None,None,None\n")
    assert dict(files.read_bars_inferred(spark, str(tmp_path / "A.csv")).dtypes)["Open"] == "string"


def test_header_order(spark, tmp_path):
    write(tmp_path / "A.csv", "Date,Close,Open,High,Low,Volume\nx,9.0,1.0,2.0,3.0,4.0\n")
    assert files.load_symbol(spark, str(tmp_path), "A").first()["Open"] == 9.0
    with pytest.raises(Exception, match="(?i)header"):
        files.read_bars(spark, str(tmp_path / "A.csv"), check_header=True).collect()


def test_flag_before_and_after_filling(spark):
    rows = bar_rows(spark, [("a", 1.0, 1.0, 1.0, 1.0, 1.0), ("b", None, None, None, None, None)])
    before = {r["Date"]: r["MarketClosed"] for r in clean.clean_bars(rows).collect()}
    after = {r["Date"]: r["MarketClosed"] for r in clean.clean_bars(rows, flag_before_fill=False).collect()}
    assert before == {"a": 0, "b": 1}
    assert after == {"a": 0, "b": 0}
    assert clean.clean_bars(rows, policy="drop").count() == 1
    with pytest.raises(ValueError):
        clean.clean_bars(rows, policy="other")


def test_nan_is_missing(spark):
    rows = bar_rows(spark, [("a", math.nan, 1.0, 1.0, 1.0, 1.0)])
    assert clean.fill_missing(rows).first()["Open"] == 0.0
    assert clean.drop_missing(rows).count() == 0


def test_decimal_overflow_and_rounding(spark):
    rows = bar_rows(spark, [("a", 1.005, 2.675, 0.125, -0.125, 150000000.0)])
    row = clean.to_decimals(rows, volume_precision=10).first()
    assert [str(row[c]) for c in MEASURES[:4]] == ["1.01", "2.68", "0.13", "-0.13"]
    assert row["Volume"] is None
    assert str(clean.to_decimals(rows).first()["Volume"]) == "150000000.00"


def test_rows_without_features_are_an_error_unless_skipped(spark):
    rows = bar_rows(spark, [("a", 1.0, 1.0, 1.0, 1.0, None), ("b", 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert model.assemble(rows, on_missing="skip").count() == 1
    with pytest.raises(Exception, match="(?i)null"):
        model.assemble(rows).collect()


def test_session_times_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            instants = [F.timestamp_seconds(F.lit(s)) for s in (1704207600, 1704229200)]  # 15:00, 21:00 UTC
            bare = [F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02 15:00:00", "2024-01-02 21:00:00")]
            row = spark.range(1).select(*[times.market_open(t) for t in [*instants, *bare]]).first()
            assert list(row) == [True, False, True, False]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dates_of_zoned_text(spark):
    text = F.lit("2024-01-02T19:58:00-05:00")
    row = spark.range(1).select(
        times.session_date(text).alias("utc"), times.exchange_date(text).alias("exchange"),
        times.parse_time(F.lit("nonsense")).alias("bad"),
    ).first()
    assert row["utc"] == dt.date(2024, 1, 3)
    assert row["exchange"] == dt.date(2024, 1, 2)
    assert row["bad"] is None


@pytest.mark.parametrize(
    "utc, expected",
    [
        ("2024-01-02 13:29:59", False),
        ("2024-01-02 13:30:00", True),
        ("2024-01-02 19:59:59", True),
        ("2024-01-02 20:00:00", False),
        ("2024-01-06 16:00:00", False),
    ],
)
def test_session_edges(spark, utc, expected):
    at = F.lit(utc).cast("timestamp_ntz")
    assert spark.range(1).select(times.market_open(at)).first()[0] is expected
    assert spark.range(1).select(times.market_open(at.cast("timestamp"))).first()[0] is expected


def test_session_in_a_named_zone_and_now(spark):
    winter = F.lit("2024-01-02 13:30:00").cast("timestamp_ntz")
    summer = F.lit("2024-07-02 13:30:00").cast("timestamp_ntz")
    row = spark.range(1).select(
        times.market_open(winter, zone="America/New_York").alias("w"),
        times.market_open(summer, zone="America/New_York").alias("s"),
        times.market_open(F.lit(None).cast("timestamp_ntz")).alias("now"),
    ).first()
    assert (row["w"], row["s"]) == (False, True)
    assert row["now"] is not None


def test_messages_good_bad_and_nan(spark):
    good = '{"stock":"A","date":"d","open":NaN,"high":1.0,"low":null,"close":3,"volume":2}'
    bad = [
        "oops", '{"open":"x"}', '{"stock":"A"}', '{"date":"d","open":1}', '{"stock":"A","date":"d","close":"x"}',
        '{"stock":"A","date":"d","open":"x","high":"x","low":"x","close":"x","volume":"x"}',
        '{"stock":"A","date":"d","open":1} and more', '{"stock":"A","date":"d"}{"stock":"A","date":"d"}', None, "",
    ]
    sent = spark.createDataFrame([(m,) for m in [*bad, good]], "value string")
    assert {r["value"] for r in messages.rejected(sent).collect()} == set(bad)
    row = messages.accepted(sent).collect()
    assert len(row) == 1 and row[0].asDict().keys() == {"Date", *MEASURES, "stock"}
    assert math.isnan(row[0]["Open"]) and row[0]["High"] == 1.0 and row[0]["Low"] is None
    assert row[0]["Close"] == 3.0 and row[0]["Volume"] == 2.0


def test_null_measures_stay_in_messages(spark):
    rows = bar_rows(spark, [("d", None, None, None, None, None)])
    sent = messages.to_messages(messages.bar_to_message(rows, F.col("Date"), F.lit("A"))).first()
    assert sent["key"] == "A"
    assert sent["value"] == (
        '{"stock":"A","date":"d","open":null,"high":null,"low":null,"close":null,"volume":null}'
    )


def test_csv_line_spells_missing_values(spark):
    rows = bar_rows(spark, [("d", 1.0, None, 2.5, None, None)])
    line = rows.select(texts.csv_line(*[F.col(c) for c in ["Date", *MEASURES]])).first()[0]
    assert line == "d,1.0,None,2.5,None,None"


def test_symbol_lists(spark):
    assert symbol_list("") == [] and symbol_list(None) == [] and symbol_list("A,B") == ["A", "B"]
    rows = spark.createDataFrame([("A",), ("B",)], "stock string")
    assert of_symbols(rows, "").count() == 0
    assert of_symbols(rows, "A,X").count() == 1
    row = rows.limit(1).select(texts.split_symbols(F.lit("A,B")), texts.split_symbols(F.lit(""))).first()
    assert (row[0], row[1]) == (["A", "B"], [])
    now = rows.select(F.lit("2024-01-06 12:00:00").cast("timestamp_ntz").alias("ts"))
    assert market.heartbeats(now, "").count() == 0


def test_quote_address_and_bytes(spark):
    row = spark.range(1).select(
        texts.quote_url(F.lit("INFY.NS")).alias("u"), texts.to_text(texts.to_bytes(F.lit("é€"))).alias("t")
    ).first()
    assert row["u"] == "https://www.google.com/finance/quote/INFY:NASDAQ"
    assert row["t"] == "é€"


def test_empty_folder_gives_no_rows(spark, tmp_path):
    write(tmp_path / "note.txt", "not a table")
    assert files.read_all_symbols(spark, str(tmp_path)).count() == 0


def test_all_symbols_from_file_names(spark, tmp_path):
    write(tmp_path / "A.csv", HEADER + "d,1.0,1.0,1.0,1.0,1.0\n")
    write(tmp_path / "B F.csv", HEADER + "d,2.0,2.0,2.0,2.0,None\n")
    write(tmp_path / "C+G.csv", HEADER + "d,3.0,2.0,2.0,2.0,1.0\n")
    write(tmp_path / "readme.md", "ignored")
    rows = files.read_all_symbols(spark, str(tmp_path)).collect()
    assert sorted((r["Stock"], r["Open"]) for r in rows) == [("A", 1.0), ("B F", 2.0), ("C+G", 3.0)]


def test_bars_by_symbol_append_and_prune(spark, tmp_path):
    rows = bar_rows(spark, [("d", 1.0, None, 1.0, 1.0, 1.0)]).withColumn("stock", F.lit("A"))
    for symbol in ("A", "A", "B"):
        append_bars_by_symbol(rows.withColumn("stock", F.lit(symbol)), str(tmp_path / "store"))
    stored = files.read_all_symbols(spark, str(tmp_path / "store"), partitioned=True)
    assert stored.groupBy("Stock").count().orderBy("Stock").collect() == [("A", 2), ("B", 1)]
    assert "None" in next((tmp_path / "store" / "stock=A").glob("*.csv")).read_text()
    plan = stored.filter(F.col("Stock") == "A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(stock" in plan


def test_parquet_store_pushes_filters(spark, tmp_path):
    rows = bar_rows(spark, [("d", 1.0, 2.0, 1.0, 1.0, 1.0), ("e", None, None, None, None, None)])
    append_bars_by_symbol(rows.withColumn("stock", F.lit("A")), str(tmp_path / "store"), "parquet")
    stored = files.read_all_symbols(spark, str(tmp_path / "store"), partitioned=True, file_format="parquet")
    priced = clean.not_null(stored).select("High")
    plan = priced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(Open)]" in plan and "ReadSchema: struct<Open:double,High:double>" in plan
    assert [r[0] for r in priced.collect()] == [2.0]


def test_details_take_defaults(spark):
    rows = spark.createDataFrame([("A", '{"shortName":"Apple","marketCap":12}'), ("B", "broken")], "s string, d string")
    found = documents.symbol_details(rows, F.col("s"), F.lit("2024-01-02"), F.col("d")).collect()
    assert len(found[0]) == 15
    assert (found[0]["ShortName"], found[0]["MarketCap"], found[0]["Sector"]) == ("Apple", 12.0, "")
    assert (found[1]["ShortName"], found[1]["ShortRatio"]) == ("", 0.0)


def test_has_rows(spark):
    rows = spark.createDataFrame([("A",)], "stock string")
    assert market.has_rows(rows, "A") and not market.has_rows(rows, "B")

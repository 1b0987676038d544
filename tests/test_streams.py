"""Continuous queries: same result as batch, and nothing lost or repeated over a restart."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import messages
from tickloom.operators.updates import last_per_key
from tickloom.sinks.messages import publish_files, publish_kafka
from tickloom.sources.files import read_all_symbols
from tickloom.sources.streams import BAR_TOPIC, file_messages, kafka_messages, kafka_options
from tickloom.streaming import ingest


def bars(spark, day, n):
    return spark.range(n).select(
        F.element_at(F.array(F.lit("A"), F.lit("B")), (F.col("id") % 2 + 1).cast("int")).alias("stock"),
        F.concat(F.lit(day), F.lit("T10:"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("date"),
        *[F.col("id").cast("double").alias(c) for c in ["open", "high", "low", "close", "volume"]],
    )


def test_restart_adds_only_new_messages(spark, tmp_path):
    topic, store, progress = (str(tmp_path / n) for n in ("topic", "store", "progress"))
    bad = spark.createDataFrame([(None, "oops")], "key string, value string")
    publish_files(messages.to_messages(bars(spark, "2024-01-02", 10)).unionByName(bad), topic)

    def run():
        source = file_messages(spark, topic, files_per_trigger=1)
        ingest.ingest_bars(source, store, progress, available_now=True).awaitTermination()
        return read_all_symbols(spark, store, partitioned=True).count()

    assert run() == 10
    assert run() == 10
    publish_files(messages.to_messages(bars(spark, "2024-01-03", 6)), topic)
    assert run() == 16
    rejects = str(tmp_path / "rejects")
    source = file_messages(spark, topic)
    ingest.ingest_rejects(source, rejects, str(tmp_path / "p2"), available_now=True).awaitTermination()
    assert [r[0] for r in spark.read.text(rejects).collect()] == ["oops"]


def test_no_bar_is_late_and_the_last_version_counts(spark, tmp_path):
    """One symbol's whole month after another, then a revised bar: all are there, with their last values."""
    topic, store, progress, compact = (str(tmp_path / n) for n in ("topic", "store", "progress", "compact"))

    def run(rows):
        sent = spark.createDataFrame(rows, "stock string, date string, close double")
        sent = sent.select("stock", "date", *[F.lit(1.0).alias(c) for c in ("open", "high", "low")], "close", F.lit(1.0).alias("volume"))
        publish_files(messages.to_messages(sent.coalesce(1)), topic)
        bars = messages.accepted(file_messages(spark, topic, files_per_trigger=1))
        ingest.ingest_updates(bars, store, progress, available_now=True).awaitTermination()
        last = ingest.read_updates(spark, store, ["stock", "Date"]).collect()
        return {(r["stock"], r["Date"]): r["Close"] for r in last}

    days = [f"2024-01-{d:02d}" for d in range(1, 32)] + ["2024-02-01", "2024-02-02"]
    assert len(run([("A", d, 1.0) for d in days])) == 33
    assert len(run([("B", d, 2.0) for d in days])) == 66
    last = run([("A", "2024-01-01", 9.9), ("A", "2024-01-01", 9.8)])
    assert len(last) == 66 and last["A", "2024-01-01"] == 9.8 and last["B", "2024-01-01"] == 2.0
    ingest.compact_updates(spark, store, compact, ["stock", "Date"])
    assert spark.read.parquet(compact).count() == 66


def test_latest_follows_new_rows(spark, tmp_path):
    folder, store, progress = (str(tmp_path / n) for n in ("rows", "latest", "progress"))

    def run(day, n):
        bars(spark, day, n).write.mode("append").parquet(folder)
        rows = spark.readStream.schema(bars(spark, day, 1).schema).parquet(folder)
        ingest.publish_latest(rows, ["date"], ["date", "close"], store, progress, available_now=True).awaitTermination()
        return sorted(map(tuple, ingest.read_latest(spark, store).collect()))

    assert run("2024-01-02", 4) == [("A", "2024-01-02T10:02", 2.0), ("B", "2024-01-02T10:03", 3.0)]
    assert run("2024-01-03", 1) == [("A", "2024-01-03T10:00", 0.0), ("B", "2024-01-02T10:03", 3.0)]


def test_resent_rows_are_dropped_over_batches(spark, tmp_path):
    folder, store, progress = (str(tmp_path / n) for n in ("rows", "kept", "progress"))

    def run(rows):
        rows.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        ingest.ingest_updates(stream, store, progress, available_now=True).awaitTermination()
        return sorted((r["stock"], r["id"]) for r in ingest.read_updates(spark, store, ["stock", "id"]).collect())

    def rows(first, last, copies):
        ids = spark.range(first, last).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        return ids.select(F.lit("A").alias("stock"), "id", F.timestamp_seconds(F.col("id") + 1).alias("ts"))

    assert run(rows(0, 5, 40)) == [("A", i) for i in range(5)]
    assert run(rows(0, 8, 3)) == [("A", i) for i in range(8)]


def test_live_bars_leave_the_state_and_late_ticks_are_repaired(spark, tmp_path):
    folder, topic, progress = (str(tmp_path / n) for n in ("ticks", "bars", "progress"))
    schema = "stock string, ts timestamp, event_id long, price double"
    import datetime as dt

    def ticks(stock, days):
        return [(stock, dt.datetime(2024, 1, d, 10), d, float(d)) for d in days]

    for part in (ticks("A", range(1, 5)), ticks("A", [20]), ticks("A", [21]), ticks("B", range(1, 5))):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = ingest.publish_live_bars(stream, topic, progress, available_now=True)
    query.awaitTermination()
    removed = sum(s["numRowsRemoved"] for p in query.recentProgress for s in p["stateOperators"])
    assert removed > 0
    stored = spark.read.schema(schema).parquet(folder)
    assert ingest.repair_bars(stored, topic) == 4
    assert ingest.repair_bars(stored, topic) == 0
    sent = messages.parse_messages(ingest.read_messages(spark, topic), keep=["arrival"])
    assert last_per_key(sent, ["stock", "date"], ["arrival"]).count() == 10


def test_live_bars_grow_with_later_ticks(spark, tmp_path):
    folder, topic, progress = (str(tmp_path / n) for n in ("ticks", "bars", "progress"))

    def run(ticks):
        df = spark.createDataFrame(ticks, "stock string, ts string, event_id long, price double")
        df = df.withColumn("ts", F.col("ts").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(df.schema).parquet(folder)
        ingest.publish_live_bars(stream, topic, progress, available_now=True).awaitTermination()
        parsed = messages.parse_messages(ingest.read_messages(spark, topic), keep=["arrival"])
        final = last_per_key(parsed, ["stock", "date"], ["arrival"])
        return {(r["date"], r["open"], r["close"], r["volume"]) for r in final.collect()}

    assert run([("A", "2024-01-02 10:00:10", 1, 5.0)]) == {("2024-01-02T10:00:00", 5.0, 5.0, 1.0)}
    assert run([("A", "2024-01-02 10:01:10", 2, 7.0), ("A", "2024-01-02 10:02:00", 3, 8.0)]) == {
        ("2024-01-02T10:00:00", 5.0, 7.0, 2.0),
        ("2024-01-02T10:02:00", 8.0, 8.0, 1.0),
    }


def test_broker_options_and_missing_connector(spark):
    options = kafka_options("host:9092", BAR_TOPIC, "readers", max_per_trigger=1000)
    assert options["maxOffsetsPerTrigger"] == "1000" and "minPartitions" not in options
    assert options["subscribe"] == "stock_prices" and options["startingOffsets"] == "earliest"
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "host:9092")
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_kafka(spark.createDataFrame([("k", "v")], "key string, value string"), "host:9092", "t")

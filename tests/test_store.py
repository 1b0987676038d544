"""Stores with several writers: order of arrival, restarts, repairs beside a going stream, merging and pruning."""

import datetime as dt
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as bar_operators
from tickloom.operators import messages
from tickloom.operators.updates import last_per_key
from tickloom.streaming import ingest, store

KEYS = ["stock", "id"]


def rows(spark, first, last, value):
    return spark.range(first, last).select(F.lit("A").alias("stock"), "id", F.lit(value).alias("value"))


def stream(spark, folder, some):
    some.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(some.schema).parquet(folder)


def current(spark, folder):
    return {r["id"]: r["value"] for r in ingest.read_updates(spark, folder, KEYS).collect()}


def test_a_second_stream_adds_to_the_first(spark, tmp_path):
    kept, a, b = (str(tmp_path / n) for n in ("kept", "a", "b"))

    def run(source, progress, some):
        ingest.ingest_updates(stream(spark, source, some), kept, progress, available_now=True).awaitTermination()

    run(a, f"{a}-progress", rows(spark, 0, 4, "backfill"))
    run(a, f"{a}-progress", rows(spark, 4, 6, "backfill"))
    run(b, f"{b}-progress", rows(spark, 3, 5, "live"))
    assert current(spark, kept) == {0: "backfill", 1: "backfill", 2: "backfill", 3: "live", 4: "live", 5: "backfill"}
    # A lost checkpoint: the source is read again and arrives last; then the first stream goes on.
    run(b, f"{b}-other-progress", rows(spark, 9, 10, "again"))
    run(a, f"{a}-progress", rows(spark, 0, 1, "last"))
    want = {0: "last", 1: "backfill", 2: "backfill", 3: "live", 4: "live", 5: "backfill", 9: "again"}
    assert current(spark, kept) == want
    assert len(store.finished(spark, kept)) == 5
    assert ingest.fold_updates(spark, kept, KEYS, fan=2) == 1
    assert current(spark, kept) == want and len(store.finished(spark, kept)) == 2
    assert store.prune(spark, kept) == 0 and store.prune(spark, kept, keep=0) == 4
    assert current(spark, kept) == want
    run(a, f"{a}-progress", rows(spark, 1, 2, "on"))
    assert current(spark, kept) == {**want, 1: "on"}


def test_a_repeated_batch_is_skipped_also_after_folds(spark, tmp_path):
    folder = str(tmp_path / "s")
    assert store.append(rows(spark, 0, 3, "a"), folder, "w", 0)
    assert not store.append(rows(spark, 0, 3, "a"), folder, "w", 0)
    assert store.append(rows(spark, 0, 3, "b"), folder, "v", 0)
    assert store.append(rows(spark, 0, 3, "c"), folder, "w", 1)
    assert store.append(rows(spark, 0, 3, "d"), folder)
    store.fold(spark, folder, lambda some: some, fan=4)
    store.prune(spark, folder, keep=0)
    assert [b.name for b in store.finished(spark, folder)] == ["batches=1-4"]
    for writer, number in (("w", 0), ("w", 1), ("v", 0)):
        assert not store.append(rows(spark, 0, 3, "again"), folder, writer, number)
    assert store.append(rows(spark, 0, 3, "e"), folder, "v", 1)
    assert store.read(spark, folder).count() == 15
    # Unfinished work is never read.
    shutil.copytree(f"{folder}/batches=5-5", f"{folder}/_work/left")
    assert store.read(spark, folder).count() == 15
    with pytest.raises(FileNotFoundError):
        store.read(spark, str(tmp_path / "none"))


def test_two_writers_take_one_number(spark, tmp_path, monkeypatch):
    """A writer that lists the folder before another one finishes gets the next number."""
    folder = str(tmp_path / "s")
    store.append(rows(spark, 0, 1, "a"), folder, "w", 0)
    before, listed = store._all, []

    def stale(session, path):
        listed.append(before(session, path))
        return [] if len(listed) == 2 else listed[-1]

    monkeypatch.setattr(store, "_all", stale)
    assert store.append(rows(spark, 0, 1, "b"), folder, "v", 0)
    assert [b.last for b in store.finished(spark, folder)] == [1, 2]


def test_folds_are_nested_or_apart_and_leave_large_batches():
    def batches(*sizes):
        return {store.Batch(i, i, f"batches={i}-{i}"): size for i, size in enumerate(sizes, 1)}

    def spans(found, target, fan):
        return [(g[0].first, g[-1].last) for g in store.groups_to_fold(found, target, fan)]

    assert spans(batches(*[1] * 9), 100, 2) == [(1, 8)]
    assert spans(batches(*[1] * 7), 100, 2) == [(1, 4), (5, 6)]
    assert spans(batches(1, 1, 90, 1, 1, 1, 1, 1), 50, 2) == [(1, 2), (5, 8)]
    assert spans(batches(*[1] * 3), 100, 4) == [] and spans({}, 100, 4) == []
    for seed in range(20):
        sizes = [(seed * 31 + i * 17) % 23 for i in range(70)]
        found = [(a, b) for target in (5, 20, 60, 500) for a, b in spans(batches(*sizes), target, 3)]
        assert all(b < c or d < a or (a <= c and d <= b) or (c <= a and b <= d) for a, b in found for c, d in found)


def test_a_store_of_small_files_is_compacted(spark, tmp_path):
    folder = str(tmp_path / "s")
    for n in range(9):
        some = spark.range(n * 10, n * 10 + 10).withColumn("stock", F.concat(F.lit("0"), (F.col("id") % 2).cast("string")))
        store.append(some.repartition(5), folder, "w", n, by=["stock"])
    big = spark.range(100_000).select((F.col("id") + 1000).alias("id"), F.lit("00").alias("stock"))
    store.append(big, folder, "w", 9, by=["stock"])
    before = sorted(map(tuple, store.read(spark, folder).select("id", "stock").collect()))
    large = f"{folder}/batches=10-10"
    seen = os.stat(large).st_mtime_ns
    open_before = store.read(spark, folder).select("id")
    store.fold(spark, folder, lambda some: some, target_bytes=100_000, by=["stock"], fan=2)
    assert [b.name for b in store.finished(spark, folder)] == ["batches=1-8", "batches=9-9", "batches=10-10"]
    assert sorted(map(tuple, store.read(spark, folder).select("id", "stock").collect())) == before
    assert os.stat(large).st_mtime_ns == seen
    assert all(len([f for f in os.listdir(f"{folder}/batches=1-8/stock=0{i}") if f.endswith(".parquet")]) == 1 for i in (0, 1))
    assert open_before.count() == len(before)  # a reader from before goes on


TICK = "stock string, ts timestamp, event_id long, price double"


def ticks(stock, days, price=None):
    return [(stock, dt.datetime(2024, 1, d, 10), d, float(price or d)) for d in days]


def last_messages(spark, topic):
    parsed = messages.parse_messages(ingest.read_messages(spark, topic), keep=["arrival"])
    last = last_per_key(parsed.drop("value"), ["stock", "date"], ["arrival"])
    return {(r["stock"], r["date"][:16]): (r["open"], r["close"], r["volume"]) for r in last.collect()}


def test_repairs_survive_the_stream_that_goes_on(spark, tmp_path):
    folder, topic, progress = (str(tmp_path / n) for n in ("ticks", "bars", "progress"))

    def run(some):
        source = stream(spark, folder, spark.createDataFrame(some, TICK))
        ingest.publish_live_bars(source, topic, progress, available_now=True).awaitTermination()

    run(ticks("A", [1, 2]))
    run(ticks("A", [20]))
    run(ticks("B", [1]))  # late
    assert ("B", "2024-01-01T10:00") not in last_messages(spark, topic)
    assert ingest.repair_bars(spark.read.parquet(folder), topic) == 1
    assert last_messages(spark, topic)["B", "2024-01-01T10:00"] == (1.0, 1.0, 1.0)
    run(ticks("A", [21]))
    run(ticks("A", [22]))
    found = last_messages(spark, topic)
    assert found["B", "2024-01-01T10:00"] == (1.0, 1.0, 1.0) and len(found) == 6
    assert ingest.repair_bars(spark.read.parquet(folder), topic) == 0


def test_merged_bars_take_late_ticks_by_themselves(spark, tmp_path):
    folder, target, progress = (str(tmp_path / n) for n in ("ticks", "bars", "progress"))

    def run(some, at=progress, source=folder):
        rows = stream(spark, source, spark.createDataFrame(some, TICK))
        ingest.publish_merged_bars(rows, target, at, available_now=True).awaitTermination()

    run(ticks("A", range(1, 20)))
    run(ticks("B", range(1, 5)))
    late = [("A", dt.datetime(2024, 1, 3, 9, 59, 59), 0, 7.0), ("A", dt.datetime(2024, 1, 3, 10, 1), 99, 8.0)]
    run(late)
    run(ticks("C", [1]), f"{progress}-2", f"{folder}-2")  # another stream into the same folder
    found = last_messages(spark, f"{target}/messages")
    assert len(found) == 25 and found["C", "2024-01-01T10:00"] == (1.0, 1.0, 1.0)
    assert found["A", "2024-01-03T10:00"] == (3.0, 8.0, 2.0) and found["A", "2024-01-03T09:58"] == (7.0, 7.0, 1.0)
    # The late ticks' batch has published their own two bars only.
    sent = ingest.read_messages(spark, f"{target}/messages").groupBy("arrival").count().collect()
    assert {r["arrival"]: r["count"] for r in sent} == {1: 19, 2: 4, 3: 2, 4: 1}
    both = spark.read.parquet(folder, f"{folder}-2")
    want = sorted(map(tuple, bar_operators.ohlc_bars(both).collect()))
    for _ in range(2):
        assert sorted(map(tuple, ingest.read_merged_bars(spark, target).select(*bar_operators.ohlc_bars(both).columns).collect())) == want
        ingest.fold_bar_states(spark, target, fan=2)
        store.prune(spark, f"{target}/states", keep=0)


def test_streams_fold_their_own_stores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ingest, "FOLD_EVERY", 8)
    folder, latest, progress = (str(tmp_path / n) for n in ("rows", "latest", "progress"))
    for n in range(17):
        spark.createDataFrame([("A", n, n), ("B", 100 - n, n)], "stock string, at long, price long").coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema("stock string, at long, price long").option("maxFilesPerTrigger", 1).parquet(folder)
    ingest.publish_latest(source, ["at"], ["price"], latest, progress, available_now=True).awaitTermination()
    assert sorted(map(tuple, ingest.read_latest(spark, latest).collect())) == [("A", 16), ("B", 0)]
    assert len(store.finished(spark, latest)) <= 3 and len(os.listdir(latest)) <= 12
    other = spark.createDataFrame([("A", 3, 33), ("C", 1, 1)], "stock string, at long, price long")
    rows_ = stream(spark, f"{folder}-2", other)
    ingest.publish_latest(rows_, ["at"], ["price"], latest, f"{progress}-2", available_now=True).awaitTermination()
    assert sorted(map(tuple, ingest.read_latest(spark, latest).collect())) == [("A", 16), ("B", 0), ("C", 1)]


def test_a_stop_between_two_sinks_adds_nothing(spark, tmp_path, monkeypatch):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))
    texts = ['{"stock":"007","date":"d","open":1}', "oops", None, "", '{"stock":"A","date":"d","open":"x"}', '{"stock":"A"}',
             '{"date":"d"}', '{"stock":"A","date":"d"} {}', "5", '{"stock":"A","date":"d","open":NaN}']
    rows_ = stream(spark, source, spark.createDataFrame([(t,) for t in texts], "value string"))
    real, calls = store.append, []

    def failing(*args, **named):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("stopped between the sinks")
        return real(*args, **named)

    monkeypatch.setattr(store, "append", failing)
    for _ in range(2):
        try:
            ingest.route_messages(rows_, target, progress, available_now=True).awaitTermination()
        except Exception as error:
            assert "between the sinks" in str(error)
    good = store.read(spark, f"{target}/bars").collect()
    assert sorted(r["stock"] for r in good) == ["007", "A"]
    found = sorted(((r["reason"], r["value"]) for r in store.read(spark, f"{target}/rejects").collect()), key=str)
    assert [r for r, _ in found] == [
        "no date", "no symbol", "no text", "not json", "not json", "not one object", "wrong type", "wrong type"
    ]
    judged = messages.judged(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert judged.filter("reason IS NULL").count() == messages.accepted(judged.select("value")).count() == 2
    assert len(found) == 8


def test_silences_are_reported_once(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("source", "target", "progress"))

    def run(*times):
        made = [(s, dt.datetime(2024, 1, 2, 15, 0) + dt.timedelta(minutes=m)) for s, m in times]
        rows_ = stream(spark, source, spark.createDataFrame(made, "stock string, ts timestamp"))
        ingest.ingest_silences(rows_, target, progress, "10 minutes", "5 minutes", available_now=True).awaitTermination()
        return sorted((r["stock"], r["last_seen"].hour * 60 + r["last_seen"].minute - 900, r["seen"]) for r in spark.read.parquet(target).collect())

    assert run(("A", 0), ("A", 4), ("B", 0), ("B", 16)) == [("B", 0, 1)]
    assert run(("A", 30), ("B", 25)) == [("A", 4, 2), ("B", 0, 1)]
    # The market has closed when B falls silent.
    assert run(("A", 61), ("A", 400)) == [("A", 4, 2), ("A", 30, 1), ("A", 61, 1), ("B", 0, 1), ("B", 25, 2)]


def test_the_rest_stands_without_the_optional_folders(tmp_path):
    """The contract loads without the language-data part, whether the pipeline file is there or not."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(os.path.join(root, "tickloom"), tmp_path / "tickloom", ignore=skip)
    for name in ("__spark_entry__.py", "check.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    code = "import __spark_entry__ as e; print(sorted(n for n in e.queries() if n.startswith(('op', 'pipe'))), len(e.queries()) > 80)"
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert done.stdout.strip() == "[] True", done.stderr
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)

"""Streaming queries, worked off to the end and read back."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import parse_time
from tickloom.operators import messages
from tickloom.operators.updates import last_per_key
from tickloom.plans.registry import query
from tickloom.plans.tables import FEED, SESSION, TICKS, bars_sql, feed_table, table, ticks
from tickloom.schemas import MEASURES, TICK_TABLE
from tickloom.sinks.messages import publish_files
from tickloom.sources.files import load_symbol, read_all_symbols
from tickloom.sources.streams import file_messages, table_stream
from tickloom.storage import new_path
from tickloom.streaming import ingest, store


def _publish_feed(spark: SparkSession, folder: str) -> str:
    """The feed as keyed JSON messages in a new folder, with one unreadable message per day."""
    topic = new_path(spark, "topic")
    rows = feed_table(spark, folder)
    sent = messages.to_messages(messages.bar_to_message(rows, F.col("Date"), F.col("stock")))
    days = rows.select(F.substring("Date", 1, 10).alias("day")).distinct()
    damaged = days.select(
        F.lit(None).cast("string").alias("key"), F.concat(F.lit("{oops "), "day").alias("value")
    )
    publish_files(sent.unionByName(damaged), topic)
    return topic


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream of ticks; streams need zoned timestamps."""
    schema = table(spark, folder, "events").schema
    events = table_stream(spark, folder, "events.parquet", schema)
    return events.select(
        F.col("event_type").alias("stock"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        "event_id",
    )


@query(
    FEED
    + """ SELECT bar_start AS "Date", open AS "Open", high AS "High", low AS "Low", close AS "Close",
volume AS "Volume", stock AS "Stock" FROM feed"""
)
def stream_bars_ingest(spark: SparkSession, folder: str) -> DataFrame:
    topic, target = _publish_feed(spark, folder), new_path(spark, "target")
    source = file_messages(spark, topic)
    ingest.ingest_bars(source, target, new_path(spark, "progress"), available_now=True).awaitTermination()
    stored = read_all_symbols(spark, target, partitioned=True)
    return stored.withColumn("Date", parse_time(F.col("Date")).cast("timestamp_ntz"))


@query(TICKS + " SELECT DISTINCT '{oops ' || strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d') AS value FROM ticks")
def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    topic, target = _publish_feed(spark, folder), new_path(spark, "rejects")
    source = file_messages(spark, topic)
    ingest.ingest_rejects(source, target, new_path(spark, "progress"), available_now=True).awaitTermination()
    return spark.read.text(target)


@query(TICKS + " SELECT CAST(price AS VARCHAR) AS price, true AS has_time FROM ticks")
def stream_tick_ingest(spark: SparkSession, folder: str) -> DataFrame:
    topic, target = new_path(spark, "topic"), new_path(spark, "ticks")
    publish_files(messages.to_text_messages(ticks(spark, folder), "stock", "price"), topic)
    source = file_messages(spark, topic)
    ingest.ingest_ticks(source, target, new_path(spark, "progress"), available_now=True).awaitTermination()
    stored = spark.read.schema(TICK_TABLE).option("header", True).csv(target)
    return stored.select("price", F.to_timestamp("time").isNotNull().alias("has_time"))


@query(
    TICKS
    + """ SELECT stock, max(ts) AS ts, arg_max(price, row(ts, event_id)) AS price FROM ticks GROUP BY stock"""
)
def stream_latest_per_symbol(spark: SparkSession, folder: str) -> DataFrame:
    latest = new_path(spark, "latest")
    ingest.publish_latest(
        _event_stream(spark, folder),
        ["ts", "event_id"],
        ["ts", "price"],
        latest,
        new_path(spark, "progress"),
        available_now=True,
    ).awaitTermination()
    return ingest.read_latest(spark, latest).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    TICKS
    + f""" SELECT s.stock, t.ts AS date FROM ticks t,
(SELECT unnest(string_split('AAPL,MSFT,GOOGL', ',')) AS stock) s WHERE NOT {SESSION.format(t='t.ts')}"""
)
def stream_heartbeats(spark: SparkSession, folder: str) -> DataFrame:
    target = new_path(spark, "heartbeats")
    times = _event_stream(spark, folder).select("ts")
    ingest.ingest_heartbeats(
        times, "AAPL,MSFT,GOOGL", target, new_path(spark, "progress"), available_now=True
    ).awaitTermination()
    return spark.read.parquet(target).select("stock", F.col("date").cast("timestamp_ntz").alias("date"))


def _in_runs(spark: SparkSession, rows: DataFrame, parts: list[Column], run) -> None:
    """Add the rows of each part to a folder and ``run`` a stream over the folder: a micro-batch, and a restart, each."""
    topic = new_path(spark, "rows")
    for part in parts:
        rows.filter(part).write.mode("append").parquet(topic)
        run(spark.readStream.schema(rows.schema).parquet(topic)).awaitTermination()


def _numbered(column: Column, count: int) -> list[Column]:
    return [column == n for n in range(count)]


def _zoned_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks(spark, folder).drop("props").withColumn("ts", F.col("ts").cast("timestamp"))


@query(TICKS + " SELECT stock, ts, price, event_id FROM ticks")
def stream_updates_only(spark: SparkSession, folder: str) -> DataFrame:
    """Every tick arrives twice, in different micro-batches, as after a restart of the sender."""
    updates, progress = new_path(spark, "updates"), new_path(spark, "progress")
    twice = _zoned_ticks(spark, folder).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    parts = _numbered(F.pmod(F.col("event_id") + F.col("copy"), F.lit(3)), 3)
    _in_runs(
        spark, twice, parts, lambda rows: ingest.ingest_updates(rows.drop("copy"), updates, progress, available_now=True)
    )
    kept = ingest.read_updates(spark, updates, ["stock", "ts", "event_id"])
    return kept.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(TICKS + " SELECT stock, date_trunc('hour', ts) AS hour, arg_max(price, row(ts, event_id)) AS price FROM ticks GROUP BY ALL")
def stream_updates_last(spark: SparkSession, folder: str) -> DataFrame:
    """One symbol after another over the same days, every value revised by the next tick of its hour."""
    updates, progress = new_path(spark, "revisions"), new_path(spark, "progress")
    rows = _zoned_ticks(spark, folder).withColumn("hour", F.date_trunc("hour", "ts"))
    order = ["ts", "event_id"]
    parts = _numbered(F.pmod(F.xxhash64("stock"), F.lit(4)), 4)
    _in_runs(
        spark, rows, parts, lambda some: ingest.ingest_updates(some, updates, progress, order, available_now=True)
    )
    compact = new_path(spark, "compact")
    ingest.compact_updates(spark, updates, compact, ["stock", "hour"])
    last = spark.read.parquet(compact)
    return last.select("stock", F.col("hour").cast("timestamp_ntz").alias("hour"), "price")


CUT = "2024-01-16"


@query(
    TICKS
    + f""",
sent AS (
  SELECT *, 0 AS writer FROM ticks WHERE ts < TIMESTAMP '{CUT}'
  UNION ALL SELECT *, 1 FROM ticks WHERE ts >= TIMESTAMP '{CUT}' - INTERVAL 5 DAY AND event_id % 2 = 0
  UNION ALL SELECT *, 2 FROM ticks WHERE event_id % 3 = 0
)
SELECT stock, date_trunc('hour', ts) AS hour, arg_max(price, row(writer, ts, event_id)) AS price,
       CAST(arg_max(writer, row(writer, ts, event_id)) AS INTEGER) AS writer
FROM sent GROUP BY ALL"""
)
def stream_backfill_then_live(spark: SparkSession, folder: str) -> DataFrame:
    """A backfill, a live stream in two runs, and a new stream after a lost checkpoint, all into one folder.

    The streams overlap; of a symbol's hour the row that arrived last counts. Small batches are merged between the
    streams and after them.
    """
    updates, order = new_path(spark, "updates"), ["writer", "ts", "event_id"]
    rows = _zoned_ticks(spark, folder).withColumn("hour", F.date_trunc("hour", "ts"))
    cut = F.lit(CUT).cast("timestamp")
    live = (F.col("ts") >= cut - F.expr("INTERVAL 5 DAY")) & (F.col("event_id") % 2 == 0)
    early = F.col("ts") < cut + F.expr("INTERVAL 5 DAY")
    for writer, parts in enumerate([[F.col("ts") < cut], [live & early, live & ~early], [F.col("event_id") % 3 == 0]]):
        progress, own = new_path(spark, "progress"), rows.withColumn("writer", F.lit(writer))
        _in_runs(
            spark, own, parts, lambda some, at=progress: ingest.ingest_updates(some, updates, at, order, available_now=True)
        )
        ingest.fold_updates(spark, updates, ["stock", "hour"], fan=2)
    last = ingest.read_updates(spark, updates, ["stock", "hour"])
    return last.select("stock", F.col("hour").cast("timestamp_ntz").alias("hour"), "price", "writer")


def _last_bars(sent: DataFrame) -> DataFrame:
    """The last message of each bar, as bars."""
    parsed = messages.parse_messages(sent, keep=["arrival"])
    final = last_per_key(parsed.drop("value"), ["stock", "date"], ["arrival"])
    start = parse_time(F.col("date")).cast("timestamp_ntz").alias("bar_start")
    return final.select("stock", start, *[c.lower() for c in MEASURES])


@query(TICKS + bars_sql("2 minutes") + " SELECT * FROM bars")
def stream_live_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars from ticks that come symbol by symbol, published as messages, repaired while the stream goes on.

    All but the first symbols are late for the stream's state; their bars come from the stored ticks. The
    last message of each bar counts.
    """
    topic, stored = new_path(spark, "bars"), new_path(spark, "stored-ticks")
    progress, kept = new_path(spark, "progress"), new_path(spark, "progress")

    def run(rows: DataFrame):
        query = ingest.publish_live_bars(rows, topic, progress, available_now=True)
        query.awaitTermination()
        ingest.append_table(rows, stored, kept, available_now=True).awaitTermination()
        ingest.repair_bars(spark.read.parquet(stored), topic)
        return query

    _in_runs(spark, _zoned_ticks(spark, folder), _numbered(F.pmod(F.xxhash64("stock"), F.lit(3)), 3), run)
    return _last_bars(ingest.read_messages(spark, topic))


@query(TICKS + bars_sql("2 minutes") + " SELECT * FROM bars")
def stream_bars_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Bars from partial states: symbols one after another, then late ticks of every bar while the stream runs on.

    The last message of each bar counts; the states are merged on the way.
    """
    target, progress = new_path(spark, "bars"), new_path(spark, "progress")
    late = F.col("event_id") % 10 == 0
    parts = [(F.pmod(F.xxhash64("stock"), F.lit(3)) == n) & ~late for n in range(3)] + [late]

    def run(rows: DataFrame):
        query = ingest.publish_merged_bars(rows, target, progress, available_now=True)
        query.awaitTermination()
        ingest.fold_bar_states(spark, target, fan=2)
        return query

    _in_runs(spark, _zoned_ticks(spark, folder), parts, run)
    return _last_bars(ingest.read_messages(spark, f"{target}/messages"))


@query(
    FEED
    + """,
days AS (SELECT DISTINCT substr("Date", 1, 10) AS day FROM feed_table),
bad AS (
  SELECT unnest([
    {'value': '{oops ' || day, 'reason': 'not json'},
    {'value': '{"stock":"' || day || '"}', 'reason': 'no date'},
    {'value': '{"date":"' || day || '"}', 'reason': 'no symbol'},
    {'value': '{"stock":"x","date":"' || day || '","open":"dear"}', 'reason': 'wrong type'},
    {'value': '{"stock":"x","date":"' || day || '"},{"stock":"y"}', 'reason': 'not one object'}
  ], recursive := true) FROM days
)
SELECT stock, "Date" AS date, "Close" AS close, NULL AS value, NULL AS reason FROM feed_table
UNION ALL SELECT NULL, NULL, NULL, value, reason FROM bad"""
)
def stream_routed(spark: SparkSession, folder: str) -> DataFrame:
    """Bar messages and five kinds of faults a day, parsed once and sent to two stores, over a restart."""
    target, progress = new_path(spark, "routed"), new_path(spark, "progress")
    rows = feed_table(spark, folder)
    sent = messages.to_messages(messages.bar_to_message(rows, F.col("Date"), F.col("stock"))).select("value")
    day = F.substring("Date", 1, 10)
    damaged = [
        F.concat(F.lit("{oops "), day),
        F.concat(F.lit('{"stock":"'), day, F.lit('"}')),
        F.concat(F.lit('{"date":"'), day, F.lit('"}')),
        F.concat(F.lit('{"stock":"x","date":"'), day, F.lit('","open":"dear"}')),
        F.concat(F.lit('{"stock":"x","date":"'), day, F.lit('"},{"stock":"y"}')),
    ]
    bad = rows.select(F.explode(F.array(*damaged)).alias("value")).distinct()
    parts = _numbered(F.pmod(F.xxhash64("value"), F.lit(2)), 2)
    _in_runs(
        spark, sent.unionByName(bad), parts, lambda some: ingest.route_messages(some, target, progress, available_now=True)
    )
    good = store.read(spark, f"{target}/bars").select("stock", F.col("Date").alias("date"), F.col("Close").alias("close"))
    return good.unionByName(store.read(spark, f"{target}/rejects").drop("arrival"), allowMissingColumns=True)


@query(
    TICKS
    + f""",
followed AS (SELECT stock, ts, lead(ts) OVER (PARTITION BY stock ORDER BY ts) AS next FROM ticks),
gaps AS (
  SELECT stock, ts AS last_seen, ts + INTERVAL 30 MINUTE AS silent_at FROM followed
  WHERE (next IS NULL OR next > ts + INTERVAL 30 MINUTE)
    AND ts + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM ticks)
),
sessions AS (
  SELECT *, lag(last_seen) OVER (PARTITION BY stock ORDER BY last_seen) AS before FROM gaps
)
SELECT stock, last_seen, silent_at, (SELECT count(*) FROM ticks t
         WHERE t.stock = s.stock AND t.ts <= s.last_seen AND (s.before IS NULL OR t.ts > s.before)) AS seen
FROM sessions s WHERE {SESSION.format(t='silent_at')}"""
)
def stream_silent_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """When a symbol had sent nothing for half an hour while the market was open, over a restart."""
    target, progress = new_path(spark, "silent"), new_path(spark, "progress")
    rows = _zoned_ticks(spark, folder).select("stock", "ts")
    cut = F.lit(CUT).cast("timestamp")
    _in_runs(
        spark, rows, [F.col("ts") < cut, F.col("ts") >= cut],
        lambda some: ingest.ingest_silences(some, target, progress, available_now=True),
    )
    found = spark.read.parquet(target)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_seen", "silent_at")})


@query(
    FEED
    + """ SELECT "Date", "Open", "High", "Low", "Close", "Volume" FROM feed_table WHERE stock = 'click'"""
)
def stored_symbol_bars(spark: SparkSession, folder: str) -> DataFrame:
    """One symbol read back from the Parquet target that a stream wrote: only its folder is opened."""
    topic, target = _publish_feed(spark, folder), new_path(spark, "target")
    ingest.ingest_bars(
        file_messages(spark, topic), target, new_path(spark, "progress"), available_now=True, file_format="parquet"
    ).awaitTermination()
    return load_symbol(spark, target, "click", partitioned=True, file_format="parquet")

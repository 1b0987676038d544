"""Continuous queries. Each returns a started ``StreamingQuery``; its checkpoint folder keeps the position.

``available_now=True`` works off what is there and stops; otherwise the query polls at ``every``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.functions.times import clock_text, iso_text, market_open
from tickloom.operators.bars import bar_states, bar_table, bars_of_states, merge_states, ohlc_bars
from tickloom.operators.market import heartbeats
from tickloom.operators.messages import (
    accepted,
    bar_to_message,
    judged,
    parse_messages,
    rejected,
    stored_bars,
    to_messages,
)
from tickloom.operators.updates import current_rows, last_per_key
from tickloom.schemas import MEASURES
from tickloom.storage import materialise
from tickloom.streaming import store

# Polling intervals of bars and of single quotes.
BAR_TRIGGER = "10 seconds"
QUOTE_TRIGGER = "30 seconds"
# Columns that tell in which order stored updates arrived.
ARRIVAL = [store.ARRIVAL, "position"]
# A store is folded and pruned each time a stream has finished so many batches.
FOLD_EVERY = 64


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _writer(batch: DataFrame) -> str:
    """The identity of the stream a micro-batch belongs to; a restart from its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _fold_now_and_then(batch: DataFrame, number: int, folder: str, merge, by: list[str] | None = None) -> None:
    if number % FOLD_EVERY == FOLD_EVERY - 1:
        store.fold(batch.sparkSession, folder, merge, by=by)
        store.prune(batch.sparkSession, folder)


def _append(rows: DataFrame, folder: str, file_format: str = "csv") -> DataStreamWriter:
    writer = rows.writeStream.format(file_format).outputMode("append").option("path", folder)
    if file_format == "csv":
        writer = writer.option("header", True).option("nullValue", "None")
    return writer


def ingest_bars(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = BAR_TRIGGER,
    file_format: str = "csv",
    files_per_symbol: int = 2,
) -> StreamingQuery:
    """Parse bar messages and append them to the symbol's folder, exactly once.

    Every message is stored, also one sent again; ``ingest_updates`` keeps the order of arrival, so that
    the last version of a bar can be told. A trigger writes at most ``files_per_symbol`` files per symbol, from as
    many tasks.
    """
    rows = accepted(messages)
    rows = rows.repartition("stock", F.pmod(F.hash("Date"), F.lit(files_per_symbol)))
    writer = _append(rows, folder, file_format).partitionBy("stock")
    return _start(writer, checkpoint, available_now, every)


def ingest_updates(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    order: list[str] | None = None,
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Store the rows of a stream with their order of arrival; ``read_updates`` gives the last per key.

    Nothing is dropped: there is no watermark, so neither late rows nor revised values are lost, and no
    key depends on the times of another. Any number of streams may write to one folder, such as a backfill, a
    live stream and a new stream after a lost checkpoint: their triggers get arrival numbers one after another, and a
    repeated trigger is skipped. Within a trigger rows are ordered by ``order`` (such as the offset; the
    same columns for all streams of a folder), then by position.
    """

    def keep(batch: DataFrame, number: int) -> None:
        place = F.struct(*(order or []), F.monotonically_increasing_id().alias("at"))
        store.append(batch.withColumn("position", place), folder, _writer(batch), number)

    return _start(rows.writeStream.foreachBatch(keep), checkpoint, available_now, every)


def read_updates(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The last version of each key that ``ingest_updates`` has stored."""
    return current_rows(store.read(spark, folder), keys, ARRIVAL)


def fold_updates(spark: SparkSession, folder: str, keys: list[str], target_bytes: int = 128 << 20, fan: int = 8) -> int:
    """Merge small batches of updates, keeping the last version of each key; how many batches were written.

    Streams may go on writing and readers reading meanwhile; ``store.prune`` removes what was merged.
    """
    return len(store.fold(spark, folder, lambda rows: last_per_key(rows, keys, ARRIVAL), target_bytes, fan=fan))


def compact_updates(spark: SparkSession, folder: str, target: str, keys: list[str], by: str = "stock") -> None:
    """Write the last versions of a folder of updates to ``target``, in few files per value of ``by``."""
    current = read_updates(spark, folder, keys)
    current.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(target)


def ingest_rejects(
    messages: DataFrame, folder: str, checkpoint: str, available_now: bool = False, every: str = BAR_TRIGGER
) -> StreamingQuery:
    """Keep unreadable messages as text beside the good ones instead of stopping."""
    return _start(_append(rejected(messages), folder, "text"), checkpoint, available_now, every)


def route_messages(
    messages: DataFrame, folder: str, checkpoint: str, available_now: bool = False, every: str = BAR_TRIGGER
) -> StreamingQuery:
    """Store readable messages as bars in ``<folder>/bars`` and all others, with a reason, in ``<folder>/rejects``.

    Each message is parsed once for both. Either store has a trigger's rows exactly once, also where the stream
    ended between the two. Read them with ``store.read``.
    """

    def route(batch: DataFrame, number: int) -> None:
        rows = judged(batch).persist()
        try:
            store.append(stored_bars(rows), f"{folder}/bars", _writer(batch), number, by=["stock"])
            rejects = rows.filter(F.col("reason").isNotNull()).select("value", "reason")
            store.append(rejects, f"{folder}/rejects", _writer(batch), number)
        finally:
            rows.unpersist()

    return _start(messages.select("value").writeStream.foreachBatch(route), checkpoint, available_now, every)


def ingest_ticks(
    messages: DataFrame, folder: str, checkpoint: str, available_now: bool = False, every: str = QUOTE_TRIGGER
) -> StreamingQuery:
    """Append (arrival time, price text) for each tick message."""
    rows = messages.select(
        clock_text(F.current_timestamp()).alias("time"), F.col("value").alias("price")
    )
    return _start(_append(rows, folder), checkpoint, available_now, every)


def ingest_heartbeats(
    times: DataFrame,
    symbols: str,
    folder: str,
    checkpoint: str,
    ts: str = "ts",
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Append one row without measures per symbol and closed-market time."""
    rows = heartbeats(times, symbols, ts)
    return _start(_append(rows, folder, "parquet"), checkpoint, available_now, every)


def publish_latest(
    rows: DataFrame,
    order: list[str],
    columns: list[str],
    folder: str,
    checkpoint: str,
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Keep the newest row per symbol by ``order``, over all streams that write to the folder.

    A trigger stores the newest rows of its own; ``read_latest`` merges them, so the stream has no state and a
    new one goes on where another ended. Old triggers are folded into one and removed now and then.
    """
    names = list(dict.fromkeys(["stock", *order, *columns]))

    def newest(rows: DataFrame) -> DataFrame:
        return last_per_key(rows, ["stock"], ["position", store.ARRIVAL])

    def publish(batch: DataFrame, number: int) -> None:
        latest = last_per_key(batch.select(*names), ["stock"], order)
        latest = latest.select("stock", *columns, F.struct(*order).alias("position"))
        store.append(latest, folder, _writer(batch), number)
        _fold_now_and_then(batch, number, folder, newest)

    return _start(rows.writeStream.foreachBatch(publish), checkpoint, available_now, every)


def read_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest row of each symbol that ``publish_latest`` has stored."""
    return current_rows(store.read(spark, folder), ["stock"], ["position", store.ARRIVAL])


def publish_live_bars(
    ticks: DataFrame,
    folder: str,
    checkpoint: str,
    interval: str = "2 minutes",
    delay: str = "1 hour",
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Form bars from a tick stream and publish each bar again whenever it changes.

    A trigger's messages are the next to arrive in the folder (``read_messages``), so the last message of a
    (symbol, date) holds its final bar. Bars older than ``delay`` leave the state; ticks that come later
    than that are not seen here: store the ticks as well and run ``repair_bars``, or use ``publish_merged_bars``.
    """

    def publish(batch: DataFrame, number: int) -> None:
        store.append(_bar_messages(batch), folder, _writer(batch), number)

    bars = ohlc_bars(ticks.withWatermark("ts", delay), interval)
    return _start(bars.writeStream.outputMode("update").foreachBatch(publish), checkpoint, available_now, every)


def _bar_messages(bars: DataFrame) -> DataFrame:
    stored = bar_table(bars, iso_text(F.col("bar_start")))
    return to_messages(bar_to_message(stored, F.col("Date"), F.col("stock")))


def read_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All published messages (key, value) with their ``arrival``."""
    return store.read(spark, folder)


def repair_bars(ticks: DataFrame, folder: str, interval: str = "2 minutes") -> int:
    """Publish again, from all stored ``ticks``, the bars whose last message misses late ticks.

    The messages are the next to arrive in ``folder``, also while streams go on writing to it. Returns how
    many bars were wrong or missing.
    """
    spark = ticks.sparkSession
    sent = read_messages(spark, folder)
    last = current_rows(parse_messages(sent, keep=["arrival"]).drop("value"), ["stock", "date"], ["arrival"])
    whole = bar_table(ohlc_bars(ticks, interval), iso_text(F.col("bar_start")))
    whole = bar_to_message(whole, F.col("Date"), F.col("stock"))
    measures = F.struct(*[c.lower() for c in MEASURES])
    told = last.select("stock", "date", measures.alias("__sent"))
    wrong = whole.join(told, ["stock", "date"], "left").filter(~measures.eqNullSafe(F.col("__sent"))).drop("__sent")
    repairs = materialise(to_messages(wrong), "repairs")
    count = repairs.count()
    if count:
        store.append(repairs, folder)
    return count


def _daily_states(rows: DataFrame) -> DataFrame:
    return merge_states(rows).withColumn("day", F.to_date("bar_start"))


def publish_merged_bars(
    ticks: DataFrame,
    folder: str,
    checkpoint: str,
    interval: str = "2 minutes",
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Form bars from ticks in any order, however late, and publish each bar again whenever it changes.

    A trigger stores the partial bars of its ticks in ``<folder>/states``; merged with those stored before, they
    give the bars it publishes in ``<folder>/messages``. So a late tick costs its own bar: nothing is kept in
    memory, no other day is read, and the ticks are not needed again. Several streams may share a folder.
    Old triggers are folded now and then.
    """
    states = f"{folder}/states"

    def publish(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        partial = bar_states(batch, interval).withColumn("day", F.to_date("bar_start")).persist()
        try:
            store.append(partial, states, _writer(batch), number, by=["day"])
            days = partial.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
            touched = partial.select("stock", "bar_start", "day")
            stored = store.read(spark, states).filter(F.col("day").between(F.lit(days["a"]), F.lit(days["b"])))
            merged = merge_states(stored.join(touched, ["stock", "bar_start", "day"], "left_semi"))
            store.append(_bar_messages(bars_of_states(merged)), f"{folder}/messages", _writer(batch), number)
        finally:
            partial.unpersist()
        _fold_now_and_then(batch, number, states, _daily_states, ["day"])

    return _start(ticks.writeStream.foreachBatch(publish), checkpoint, available_now, every)


def read_merged_bars(spark: SparkSession, folder: str) -> DataFrame:
    """All bars from the states that ``publish_merged_bars`` has stored."""
    return bars_of_states(merge_states(store.read(spark, f"{folder}/states")))


def fold_bar_states(spark: SparkSession, folder: str, target_bytes: int = 128 << 20, fan: int = 8) -> int:
    """Merge small batches of partial bars into one each; how many batches were written."""
    return len(store.fold(spark, f"{folder}/states", _daily_states, target_bytes, ["day"], fan))


def ingest_summaries(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    summarise: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    available_now: bool = False,
    every: str = BAR_TRIGGER,
) -> StreamingQuery:
    """Store a mergeable summary of each trigger's rows, such as moments or quantile sketches per symbol and day.

    ``merge`` adds up summaries; it folds old triggers now and then. ``merge(store.read(spark, folder))`` is the
    summary of all rows of all streams that write to the folder, late ones included.
    """

    def keep(batch: DataFrame, number: int) -> None:
        store.append(summarise(batch), folder, _writer(batch), number)
        _fold_now_and_then(batch, number, folder, merge)

    return _start(rows.writeStream.foreachBatch(keep), checkpoint, available_now, every)


def ingest_silences(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    interval: str = "30 minutes",
    delay: str = "10 minutes",
    ts: str = "ts",
    available_now: bool = False,
    every: str = BAR_TRIGGER,
    **session,
) -> StreamingQuery:
    """Append a row (stock, last_seen, silent_at, seen) when a symbol has sent nothing for ``interval``.

    A symbol's rows form sessions that end ``interval`` after their last row; a session is reported once the
    watermark, ``delay`` behind the newest row of any symbol, has passed its end, if the market is open then. The
    state has one entry per symbol and open session, counts merge before the shuffle.
    """
    sessions = (
        rows.withWatermark(ts, delay)
        .groupBy("stock", F.session_window(ts, interval).alias("__session"))
        .agg(F.max(ts).alias("last_seen"), F.count("*").alias("seen"))
    )
    silent = sessions.select("stock", "last_seen", F.col("__session.end").alias("silent_at"), "seen")
    silent = silent.filter(market_open(F.col("silent_at"), **session))
    return _start(_append(silent, folder, "parquet"), checkpoint, available_now, every)


def append_table(
    rows: DataFrame, folder: str, checkpoint: str, available_now: bool = False, every: str = BAR_TRIGGER
) -> StreamingQuery:
    """Append the rows of any stream as Parquet, exactly once."""
    return _start(_append(rows, folder, "parquet"), checkpoint, available_now, every)

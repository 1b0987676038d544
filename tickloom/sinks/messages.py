"""Publishing keyed messages."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def publish_files(messages: DataFrame, folder: str) -> None:
    """Append (key, value) messages as files a file stream can pick up."""
    messages.select("key", "value").write.mode("append").parquet(folder)


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) messages to a topic. Needs Spark's Kafka connector on the class path."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_kafka_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str = "10 seconds"
) -> StreamingQuery:
    """Send a stream of (key, value) messages to a topic at a fixed interval."""
    return (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=every)
        .start()
    )

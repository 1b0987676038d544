"""Streaming message sources. All give the columns ``key`` and ``value`` as text."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Topics of bar messages and of price ticks.
BAR_TOPIC = "stock_prices"
TICK_TOPIC = "conn-events"


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options: from the earliest offset, in batches of bounded size.

    ``max_per_trigger`` keeps the first batch over a long topic from taking all of it;
    ``min_partitions`` divides topic partitions, such as that of a hot symbol, over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    optional = {
        "groupIdPrefix": group,
        "maxOffsetsPerTrigger": max_per_trigger,
        "minPartitions": min_partitions,
    }
    options.update({key: str(value) for key, value in optional.items() if value is not None})
    return options


def kafka_messages(spark: SparkSession, servers: str, topic: str = BAR_TOPIC, **options) -> DataFrame:
    """A topic as a stream; further arguments as for ``kafka_options``. Needs Spark's Kafka connector.

    The position is kept in the query's checkpoint, so a restart neither loses nor repeats messages.
    """
    source = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return source.select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_messages(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Message files with a ``key`` and ``value`` column in Parquet, in place of a broker."""
    reader = spark.readStream.schema("key string, value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, folder: str, file_name: str, schema: StructType) -> DataFrame:
    """One table file of a folder as a stream of its rows."""
    return spark.readStream.schema(schema).option("pathGlobFilter", file_name).parquet(folder)

"""Session settings the library is written for."""

from pyspark.sql import SparkSession

# UTC keeps zone-less and zoned timestamps in agreement; AQE merges small shuffle partitions and splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Bloom filters of listed keys, tested in the scan before a shuffled join: for scans from 1 GB, lists up to 256 MB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    # Streaming state on local disk instead of the executor's heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def builder(app_name: str = "tickloom", **extra: str) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        b = b.config(key, value)
    return b


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark

"""Session settings for streams."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application that keeps stream state in RocksDB.

    ``partitions`` is the number of state partitions. It is fixed for the life of a
    checkpoint, so choose it for the state to come.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    if partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session

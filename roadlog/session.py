"""Session settings (engine defaults and object-store access)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Settings that can also be applied to a session somebody else created.
RUNTIME_CONF = {
    # calendar columns must not depend on where the job runs
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the state of a stream (open days, seen readings) may outgrow the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # a JSON object that repeats a key keeps the last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the engine defaults on an existing session, where it has others, and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def sized_conf(shuffle_bytes: int, partition_bytes: int = 128 << 20, minimum: int = 200) -> dict[str, str]:
    """Shuffle settings for jobs that shuffle about ``shuffle_bytes``.

    The adaptive planner joins small shuffle partitions but does not cut large
    ones (hot join keys aside), so the initial number follows the data:
    partitions of ``partition_bytes`` that a task can sort in memory.
    """
    partitions = max(minimum, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def object_store_conf(
    credentials_provider: str = "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    packages: str | None = None,
    **options: str,
) -> dict[str, str]:
    """Settings for reading ``s3a://`` paths.

    ``options`` are further ``fs.s3a`` keys with ``_`` for ``.``, for example
    ``endpoint='...'`` or ``access_key='...'``.  Pass the result to
    :func:`build_session`; ``packages`` names the connector when the cluster
    image does not already contain it.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider": credentials_provider,
    }
    if packages:
        conf["spark.jars.packages"] = packages
    for name, value in options.items():
        conf["spark.hadoop.fs.s3a." + name.replace("_", ".")] = value
    return conf


def build_session(
    app_name: str = "roadlog",
    master: str | None = None,
    driver_memory: str = "2g",
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the engine defaults, then ``conf`` on top."""
    builder = SparkSession.builder.appName(app_name).config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

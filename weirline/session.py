"""Session defaults for cluster runs; every value can be overridden."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

CLUSTER_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE starts from many small partitions, merges them up to the advisory
    # size and splits the ones a hot join key has blown up.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Sides are broadcast on measured size only; no plan carries a hint for a
    # frame that grows with the data.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Keep shuffle blocks of executors that are being taken away.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}

LOCAL_OVERRIDES = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.files.maxPartitionBytes": "16m",
    # Below this a join side costs less to copy than to shuffle in one process.
    "spark.sql.autoBroadcastJoinThreshold": "2m",
    "spark.driver.memory": "12g",
    "spark.decommission.enabled": "false",
    "spark.storage.decommission.enabled": "false",
}


_MIB = 1 << 20


def sizing(
    input_bytes: int, partition_bytes: int = 512 * _MIB, block_bytes: int = 8 << 10
) -> dict[str, str]:
    """Scan split and initial shuffle partitions for an input size.

    A shuffle partition holds about ``partition_bytes`` at any size. Map tasks x
    partitions blocks stay at ``block_bytes`` or more on average, because splits
    grow with the input. At 100 TB: 1.6 GiB splits and 204,800 partitions; AQE
    merges what turns out small.
    """
    split = max(input_bytes * block_bytes // partition_bytes, 128 * _MIB)
    partitions = max(input_bytes // partition_bytes, 200)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }


def build_session(
    app_name: str = "weirline",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
    input_bytes: int = 1 << 40,
) -> SparkSession:
    """Get or create a session sized for ``input_bytes``; a ``local[...]`` master
    gets laptop-sized values."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**CLUSTER_DEFAULTS, **sizing(input_bytes)}
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.update(LOCAL_OVERRIDES)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Session settings that follow from the size of the data."""

from __future__ import annotations

MIB = 1 << 20
GIB = 1 << 30


def cluster_settings(
    shuffle_bytes: int, partition_bytes: int = 256 * MIB, broadcast_bytes: int = 128 * MIB
) -> dict[str, str]:
    """Spark SQL settings for queries whose largest shuffle holds ``shuffle_bytes``.

    Shuffles start with partitions of about ``partition_bytes``, which adaptive
    execution then merges where less data arrives and splits where a join is
    skewed. Lookups up to ``broadcast_bytes`` are broadcast.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }

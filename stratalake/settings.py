"""Session settings that follow from the amount of data."""

from __future__ import annotations

MIB = 1024 * 1024


def session_settings(shuffled_bytes: int, partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves so many bytes.

    Shuffle partitions are sized to fit an executor's memory without spilling. Adaptive
    execution merges partitions that turn out small and splits join partitions that turn out
    large, but it cannot add partitions to a shuffle, hence the count is set here. Bloom filters keep
    rows that a join would drop out of its shuffle.
    """
    partitions = max(200, -(-shuffled_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(2 * partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": str(8 * partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }

"""Session settings the jobs in this package rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Every rule on timestamps is stated in UTC; AQE splits skewed joins and sizes partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tables that are dealt by one key column stay where they are in a join on more columns
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # index names and run names in folder names stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a running session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it gets a folder in the warehouse.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_{spark.sparkContext.applicationId}"


def byte_setting(spark: SparkSession, name: str) -> int:
    """A size setting in bytes, whatever unit it is written in."""
    text = spark.conf.get(name).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    if text[-1:] in units:
        return int(text[:-1]) << units[text[-1]]
    return int(text)

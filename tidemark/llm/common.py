"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialise

#: Largest Arrow batch a Python task holds, in bytes and rows; long texts end a batch early.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if v is None else v for v in column.cast(kind).to_pylist()]


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, and the shuffle files of the job go as soon as the table is written."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return materialise(df, label)
    finally:
        conf.set(name, before)


def written(spark: SparkSession, parts: Iterator[DataFrame], label: str) -> DataFrame:
    """Write one result after another to a scratch table and read them as one."""
    out = None
    for part in parts:
        part = materialise(part, f"{label}-{uuid.uuid4().hex[:6]}")
        out = part if out is None else out.unionByName(part)
    return out


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable id of every linked node.

    ``links`` has columns ``a`` and ``b`` (64-bit ids) and may repeat links. Returns
    ``node, root`` for the nodes that occur in a link. Rounds alternate between hanging
    every larger neighbour on a node's smallest neighbour and doing the same for the
    smaller ones. Both are aggregations and joins on one id, so the work of a round
    is in proportion to the links, and a round's table is written to the shared folder.
    """
    pairs = (
        links.filter("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = materialise(pairs, "links")
    last = None
    for _ in range(max_rounds):
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.filter("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                             F.col("m").alias("v"))
        pairs = materialise(kept.filter("u <> v").distinct(), "small-star")
        state = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == last:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        last = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

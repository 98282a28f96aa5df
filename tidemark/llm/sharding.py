"""Sharding by rendezvous hashing over weighted shards, with gapless slots."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialise

#: Rows that one slot group (a part of a shard numbered by one task) should hold.
GROUP_ROWS = 50_000
#: Equal rows are counted first and dealt out again in runs of this length.
RUN_ROWS = 10_000


def score(key: Column, shard: int, weight: float) -> Column:
    """Weighted rendezvous score ``-weight / ln(u)`` of a key on one shard, u in (0, 1)."""
    u = (F.pmod(F.xxhash64(key, F.lit(shard)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return F.lit(-float(weight)) / F.log(u)


def winner(key: Column, weights: list[tuple[int, float]]) -> Column:
    """The shard with the highest score; a null key hashes like any other."""
    scores = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in weights]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0]).getField("shard")


def shard_documents(docs: DataFrame, weights: list[tuple[int, float]],
                    added: tuple[int, float] | None = None, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Place documents by the law ``key``: key and shard set alone decide the shard.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. ``size`` is the
    UTF-8 length plus 1 (null text: 1, checksum 0). ``grown_shard`` is the shard once
    ``added`` has joined: a row either stays or moves to the added shard, since the other
    scores do not change. ``slot`` counts 0, 1, ... within a shard, by key within groups
    of a hash, without gaps. Rows with equal key and text fall into one shard and get
    slots of their own; null keys are one key. Only key and text are read. Empty input,
    empty result.
    """
    raw = F.col(text).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
    )
    # equal rows are counted before the shuffle, so a key held by a third of all rows is no hot group
    counted = materialise(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n")), "shard-rows")
    grown = weights + [added] if added else weights
    groups = max(1, math.ceil(counted.count() / len(weights) / GROUP_ROWS))
    placed = counted.withColumn("shard", winner(F.col("doc_id"), weights)).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit("slot")), F.lit(groups))
    )
    starts = placed.groupBy("shard", "part").agg(F.sum("n").alias("held"))
    # one row per shard and part
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("shard", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("shard", "part")
        .orderBy("doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    runs = (
        placed.join(starts, ["shard", "part"])
        .withColumn("first", first)
        .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN_ROWS).cast("long"))))
    )
    runs = runs.hint("rebalance")
    last = F.least(F.col("n") - 1, F.col("run") + (RUN_ROWS - 1))
    one = runs.withColumn("i", F.explode(F.sequence(F.col("run"), last)))
    moved = winner(F.col("doc_id"), grown) if added else F.lit(None)
    return one.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("i")).cast("long").alias("slot"),
        moved.cast("int").alias("grown_shard"),
    )

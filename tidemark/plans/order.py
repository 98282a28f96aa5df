"""Order-dependent operators without one big task.

All of them start from the same sorted copy of the input. A range shuffle on the
order columns cuts the rows into slices of like size, whatever the key skew is, as
its bounds are sampled from the data. Each row then carries the number of its slice
and its position in it. What has to cross slice borders is one small row per slice
(or per slice and group), never the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialise
from tidemark.plans.sizing import estimated_bytes
from tidemark.session import byte_setting

#: the planner takes a table of unknown size for the largest there is
MOST_SLICES = 100_000
SLICE = "_slice"
POS = "_pos"


def slice_count(df: DataFrame) -> int:
    """Slices that keep a task within one input split, and no fewer than tasks anyhow."""
    spark = df.sparkSession
    split = byte_setting(spark, "spark.sql.files.maxPartitionBytes")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_SLICES, max(tasks, estimated_bytes(df) // split))


def sorted_slices(df: DataFrame, order: list, n: int) -> DataFrame:
    """``df`` in the total order ``order``, with its slice number and position.

    The copy is written down because slice numbers must stay the same for all the
    later passes. Keep ``df`` narrow: drop payload columns first.
    """
    # rows with equal order columns would all fall into one slice; a hash of the row parts them
    hashable = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    order = [*order, F.xxhash64(*hashable)] if hashable else order
    numbered = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id keeps the partition above bit 33 and the row below it
    placed = numbered.select(
        *df.columns,
        F.shiftright("_at", 33).cast("int").alias(SLICE),
        F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias(POS),
    )
    return materialise(placed, "slices")


def number_rows(df: DataFrame, order: list, name: str, slices: int | None = None) -> DataFrame:
    """Add the 0-based place of each row in the total order."""
    sliced = sorted_slices(df, order, slices or slice_count(df))
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per slice, so both the window and the broadcast are bounded by the slice count
    starts = (
        sliced.groupBy(SLICE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return sliced.join(F.broadcast(starts), SLICE).select(
        *df.columns, (F.col("_start") + F.col(POS)).alias(name)
    )


def last_before(
    df: DataFrame, order: list, value: str, when: Column, name: str, slices: int | None = None
) -> DataFrame:
    """Add the ``value`` of the nearest earlier row for which ``when`` holds."""
    n = slices or slice_count(df)
    sliced = sorted_slices(df.withColumn("_hit", when), order, n)
    hit = F.when(F.col("_hit"), F.struct(F.col(value).alias("v")))
    inside = Window.partitionBy(SLICE).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.filter("_hit")
        .groupBy(SLICE)
        .agg(F.max_by(F.struct(F.col(value).alias("v")), POS).alias("_end"))
    )
    # slices without a hit still need the carry, so start from all slice numbers
    carry = (
        sliced.select(SLICE)
        .distinct()
        .join(carried, SLICE, "left")
        .select(SLICE, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    )
    local = sliced.repartition(n, SLICE).withColumn("_local", F.last(hit, ignorenulls=True).over(inside))
    return local.join(F.broadcast(carry), SLICE).select(
        *df.columns, F.coalesce("_local", "_carry").getField("v").alias(name)
    )


def rank_in_groups(
    df: DataFrame, order: list, groups: dict[str, list[str]], slices: int | None = None
) -> DataFrame:
    """Add, for each entry of ``groups``, the 1-based place of a row within its group.

    A group of any size is ranked in parts: by slice, plus the rows the group has in
    earlier slices.
    """
    n = slices or slice_count(df)
    sliced = sorted_slices(df, order, n)
    # slices have like sizes, so this one shuffle serves the windows of all groups
    out = sliced.repartition(n, SLICE)
    for name, cols in groups.items():
        inside = Window.partitionBy(SLICE, *cols).orderBy(POS)
        earlier = (
            Window.partitionBy(*cols).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
        # at most one row per group and slice
        starts = (
            sliced.groupBy(SLICE, *cols)
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(
                F.col(SLICE).alias("_at"),
                *[F.col(c).alias(f"_g{i}") for i, c in enumerate(cols)],
                F.sum("_n").over(earlier).alias("_start"),
            )
            .filter(F.col("_start").isNotNull())
        )
        # null is a group like any other
        same = F.col(SLICE) == F.col("_at")
        for i, c in enumerate(cols):
            same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        out = (
            out.withColumn("_place", F.row_number().over(inside))
            .join(starts, same, "left")
            .withColumn(name, (F.col("_place") + F.coalesce("_start", F.lit(0))).cast("long"))
            .drop("_place", *starts.columns)
        )
    return out.select(*df.columns, *groups)

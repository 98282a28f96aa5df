"""Writes to an index, as table operations: replace, partial update, delete, bulk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.folding import last_known, survives, surviving_value

KEYS = ["_index", "_id"]


def upsert(target: DataFrame, docs: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Replace or add whole documents. ``docs`` has one row per key."""
    kept = target.join(docs.select(*keys), keys, "left_anti")
    return kept.unionByName(docs, allowMissingColumns=True)


def merge_fields(target: DataFrame, patch: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Overwrite the fields a patch names in ``_fields``; add documents that are absent.

    A named field that is null is set to null. ``patch`` has one row per key.
    """
    return _overlay(target, patch.withColumn("_replace", F.lit(False)), keys)


def delete(target: DataFrame, ids: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return target.join(ids.select(*keys), keys, "left_anti")


def fold_ops(ops: DataFrame, fields: list[str], seq: str, keys: list[str] = KEYS) -> DataFrame:
    """The one operation per key that equals its queued operations in order.

    ``op`` is INDEX, UPDATE (fields listed in ``_fields``) or DELETE. Updates after an
    INDEX fold into it; updates after a DELETE make a new document.
    """
    has = lambda f: (F.col("op") == "INDEX") | (
        (F.col("op") == "UPDATE") & F.array_contains("_fields", f)
    )
    folded = ops.groupBy(*keys).agg(
        F.max(seq).alias("_last"),
        F.max(F.when(F.col("op") == "INDEX", F.col(seq))).alias("_reset"),
        F.max(F.when(F.col("op") == "DELETE", F.col(seq))).alias("_cleared"),
        *[column for f in fields for column in last_known(f, seq, has(f))],
    )
    whole = F.col("_reset").isNotNull() | F.col("_cleared").isNotNull()
    return folded.select(
        *keys,
        F.when(F.col("_last") == F.col("_cleared"), "DELETE")
        .when(whole, "INDEX")
        .otherwise("UPDATE")
        .alias("op"),
        F.col("_last").alias(seq),
        *[surviving_value(f, ops.schema[f].dataType).alias(f) for f in fields],
        F.array_compact(F.array(*[F.when(survives(f), F.lit(f)) for f in fields])).alias("_fields"),
    )


def apply_ops(
    target: DataFrame, ops: DataFrame, fields: list[str], seq: str, keys: list[str] = KEYS
) -> DataFrame:
    """The target after a bulk of mixed operations."""
    folded = fold_ops(ops, fields, seq, keys)
    gone = folded.filter("op = 'DELETE'")
    patch = folded.filter("op <> 'DELETE'").withColumn("_replace", F.col("op") == "INDEX")
    return _overlay(delete(target, gone, keys), patch.drop("op", seq), keys)


def _overlay(target: DataFrame, patch: DataFrame, keys: list[str]) -> DataFrame:
    # Left joins keep the large target in place when the patch is small enough to
    # broadcast; only its key columns are read a second time, to find the new keys.
    fields = [c for c in target.columns if c not in keys]
    named = [c for c in patch.columns if c not in (*keys, "_fields", "_replace")]
    renamed = patch.select(
        *keys, "_fields", "_replace", *[F.col(f).alias(f"_new_{f}") for f in named]
    )

    def merged(field: str) -> Column:
        if field not in named:
            return F.when(F.col("_replace"), F.lit(None)).otherwise(F.col(field)).alias(field)
        take = F.col("_replace") | F.array_contains("_fields", field)
        return F.when(take, F.col(f"_new_{field}")).otherwise(F.col(field)).alias(field)

    joined = target.join(renamed, keys, "left").withColumn(
        "_replace", F.coalesce("_replace", F.lit(False))
    ).withColumn("_fields", F.coalesce("_fields", F.array().cast("array<string>")))
    touched = joined.select(*keys, *[merged(f) for f in fields])
    present = target.select(*keys).join(renamed.select(*keys), keys, "left_semi")
    added = patch.drop("_fields", "_replace").join(present, keys, "left_anti")
    return touched.unionByName(added, allowMissingColumns=True)


def ops_per_index(ops: DataFrame) -> DataFrame:
    return ops.groupBy("_index").agg(F.count(F.lit(1)).alias("operations"))


def split_rejects(docs: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Documents that pass all ``checks``, and (index, id, error) of those that do not.

    ``checks`` maps an error text to the condition a good document meets.
    """
    errors = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(e)) for e, ok in checks.items()])
    )
    marked = docs.withColumn("_errors", errors)
    good = marked.filter(F.size("_errors") == 0).drop("_errors")
    bad = marked.filter(F.size("_errors") > 0).select(
        *KEYS, F.array_join("_errors", "; ").alias("error")
    )
    return good, bad


def topic(server: str, schema: Column, table: Column) -> Column:
    """Destination name of a table's changes."""
    return F.concat_ws(".", F.lit(server), schema, table)


def write_by_topic(changes: DataFrame, path: str, server: str) -> None:
    """Changes in one folder per destination."""
    routed = changes.withColumn("topic", topic(server, F.col("schema"), F.col("table")))
    routed.write.mode("append").partitionBy("topic").parquet(path)

"""Applying row changes to keyed tables.

A change row has the key columns, ``op`` (c create, r read, u update, d delete,
t truncate), an order number, the value columns and ``_unchanged``: names of columns
whose value the log did not repeat. Null, absent and unchanged are three states.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import UNAVAILABLE, unavailable
from tidemark.operators.folding import last_known, survives, surviving_value


def last_change(changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last change of each key."""
    rest = [c for c in changes.columns if c not in keys]
    top = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_r"))
    return top.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def fill_unchanged(
    new: Column, old: Column, unchanged: Column, kind: str = "string",
    placeholder: str = UNAVAILABLE,
) -> Column:
    """A new value; where unchanged, the old value of the same message, else the stand-in."""
    return F.when(unchanged, F.coalesce(old, unavailable(kind, placeholder))).otherwise(new)


def fill_undelivered(
    new: dict[str, Column], columns: list[str], old: dict[str, Column], kind: str = "string",
    placeholder: str = UNAVAILABLE,
) -> dict[str, Column]:
    """Values of a message that leaves unchanged large columns out altogether."""
    return {
        c: new[c]
        if c in new
        else F.coalesce(old.get(c, F.lit(None).cast(kind)), unavailable(kind, placeholder))
        for c in columns
    }


def fold_changes(
    changes: DataFrame, keys: list[str], columns: list[str], seq: str, large: list[str] | None = None
) -> DataFrame:
    """At most one change per key with the effect of all its changes, in the same shape.

    A key's changes fall into spans: a create or read starts one, a delete ends one.
    Only the last span counts, so an unchanged value is never taken from before a delete
    or create. ``large`` lists the columns that can be marked unchanged; the others
    travel together. The result can be folded again with later changes.
    """
    large = [c for c in columns if large is None or c in large]
    plain = [c for c in columns if c not in large]
    opens = F.col("op").isin("c", "r")
    full = F.col("op") != "d"
    row = F.struct(*[F.col(c) for c in plain]) if plain else F.struct(F.lit(0).alias("none"))
    known = lambda c: full & ~F.coalesce(
        F.array_contains("_unchanged", c), F.lit(False)
    )
    folded = changes.groupBy(*keys).agg(
        F.max(seq).alias("_last"),
        F.max(F.when(opens, F.col(seq))).alias("_reset"),
        F.max(F.when(F.col("op") == "d", F.col(seq))).alias("_cleared"),
        F.max_by(row, F.when(full, F.col(seq))).alias("_row"),
        *[column for c in large for column in last_known(c, seq, known(c))],
    )
    deleted = F.col("_last") == F.col("_cleared")
    fresh = F.col("_reset").isNotNull() | F.col("_cleared").isNotNull()
    types = {f.name: f.dataType for f in changes.schema}
    values = {c: surviving_value(c, types[c]) for c in large}
    values |= {c: F.when(~F.coalesce(deleted, F.lit(False)), F.col("_row")[c]) for c in plain}
    return folded.select(
        *keys,
        F.when(deleted, "d").when(fresh, "c").otherwise("u").alias("op"),
        F.col("_last").alias(seq),
        *[values[c].alias(c) for c in columns],
        F.array_compact(
            F.array(*[F.when(~survives(c), F.lit(c)) for c in large]).cast("array<string>")
        ).alias("_unchanged"),
    )


def merge_folded(
    target: DataFrame,
    folded: DataFrame,
    keys: list[str],
    columns: list[str],
    placeholder: str = UNAVAILABLE,
) -> DataFrame:
    """The target after one folded change per key.

    Two left joins instead of a full outer join: if the folded side fits the broadcast
    threshold, the target is not shuffled. New keys are found from key columns alone.
    """
    types = {f.name: f.dataType.simpleString() for f in folded.schema}
    change = folded.select(
        *keys,
        F.col("op").alias("_op"),
        F.col("_unchanged"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
    )
    open_field = lambda c: F.array_contains("_unchanged", c)
    stand_in = lambda c: unavailable(types[c], placeholder)

    def merged(c: str) -> Column:
        return (
            F.when(F.col("_op").isNull(), F.col(c))
            .when(~open_field(c), F.col(f"_new_{c}"))
            .when(F.col("_op") == "u", F.col(c))
            .otherwise(stand_in(c))
            .alias(c)
        )

    kept = (
        target.select(*keys, *columns)
        .join(change, keys, "left")
        .filter("_op IS NULL OR _op <> 'd'")
        .select(*keys, *[merged(c) for c in columns])
    )
    present = target.select(*keys).join(change.select(*keys), keys, "left_semi")
    added = (
        change.filter("_op <> 'd'")
        .join(present, keys, "left_anti")
        .select(
            *keys,
            *[F.when(open_field(c), stand_in(c)).otherwise(F.col(f"_new_{c}")).alias(c)
              for c in columns],
        )
    )
    return kept.unionByName(added)


def from_folded(
    folded: DataFrame, keys: list[str], columns: list[str], placeholder: str = UNAVAILABLE
) -> DataFrame:
    """The table that folded changes make when there was none before."""
    types = {f.name: f.dataType.simpleString() for f in folded.schema}
    return folded.filter("op <> 'd'").select(
        *keys,
        *[
            F.when(F.array_contains("_unchanged", c), unavailable(types[c], placeholder))
            .otherwise(F.col(c))
            .alias(c)
            for c in columns
        ],
    )


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    columns: list[str],
    seq: str,
    large: list[str] | None = None,
    truncates: bool = False,
    placeholder: str = UNAVAILABLE,
) -> DataFrame:
    """A keyed table after a batch of changes, in order of ``seq``.

    With ``truncates`` a truncate row clears the target and all changes before it;
    without, such rows are skipped.
    """
    rows = changes.filter("op <> 't'")
    if truncates:
        cleared = changes.filter("op = 't'").agg(F.max(seq)).scalar()
        rows = rows.filter(cleared.isNull() | (F.col(seq) > cleared))
        target = None if target is None else target.filter(cleared.isNull())
    folded = fold_changes(rows, keys, columns, seq, large)
    if target is None:
        return from_folded(folded, keys, columns, placeholder)
    return merge_folded(target, folded, keys, columns, placeholder)


def hand_over(
    snapshot: DataFrame,
    snapshot_lsn: int,
    changes: DataFrame,
    keys: list[str],
    columns: list[str],
    order: str,
    large: list[str] | None = None,
) -> DataFrame:
    """A snapshot taken at a log position, plus the changes behind it, each once.

    ``order`` is the unsigned-safe order of the changes (see ``functions.lsn.rank``).
    """
    later = changes.filter(F.col(order) > F.lit(snapshot_lsn))
    return apply_changes(snapshot, later, keys, columns, order, large)


def schema_drift(
    table: DataFrame, message: DataFrame, ignore_missing_large: bool = False,
    metadata: bool = True,
) -> DataFrame:
    """What differs between known columns and those of messages.

    Both frames have ``table, column, type, length, scale, nullable``; the first also
    ``large``, the second ``root_type`` (for types derived from another). The result is
    one row per difference; no row means no refresh is needed.
    """
    t = table.select(
        "table", "column", F.lit(True).alias("_in_table"), "large",
        *[F.col(c).alias(f"t_{c}") for c in ("type", "length", "scale", "nullable")],
    )
    m = message.select(
        "table", "column", F.lit(True).alias("_in_message"), F.col("root_type").alias("m_root"),
        *[F.col(c).alias(f"m_{c}") for c in ("type", "length", "scale", "nullable")],
    )
    both = t.join(m, ["table", "column"], "full_outer")
    here = F.col("_in_table").isNotNull() & F.col("_in_message").isNotNull()
    missing = F.col("_in_message").isNull()
    if ignore_missing_large:
        missing = missing & ~F.coalesce("large", F.lit(False))
    retyped = (F.col("t_type") != F.col("m_type")) & (
        F.col("t_type") != F.coalesce("m_root", "m_type")
    )
    found = [
        F.when(F.col("_in_table").isNull(), F.lit("added")),
        F.when(missing, F.lit("missing")),
        F.when(here & retyped, F.lit("type")),
    ]
    if metadata:
        zero = F.lit(0)
        found += [
            F.when(here & ~F.col("t_length").eqNullSafe(F.col("m_length")), F.lit("length")),
            F.when(here & (F.coalesce("t_scale", zero) != F.coalesce("m_scale", zero)),
                   F.lit("scale")),
            F.when(here & (F.col("t_nullable") != F.col("m_nullable")), F.lit("nullable")),
        ]
    return both.select(
        "table", "column", F.explode(F.array_compact(F.array(*found))).alias("difference")
    )


def observed_columns(log: DataFrame) -> DataFrame:
    """The columns that new rows of the log carry, per table, for ``schema_drift``."""
    return (
        log.select("table", F.explode(F.arrays_zip("new_tuple", "new_typeinfo")).alias("z"))
        .select(
            "table",
            F.col("z.new_tuple.column_name").alias("column"),
            F.col("z.new_tuple.column_type").alias("type"),
            F.col("z.new_typeinfo.modifier").alias("modifier"),
            F.col("z.new_typeinfo.value_optional").alias("nullable"),
        )
        .distinct()
    )

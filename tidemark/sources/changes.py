"""The change log as a DataFrame, batch or stream, and its typed decoding."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import values as V

#: operation codes of a log row, with the names used from here on
OPS = {0: "c", 1: "u", 2: "d", 3: "begin", 4: "commit"}

DATUM = (
    T.StructType()
    .add("column_name", "string")
    .add("column_type", "long")
    .add("datum_int32", "integer")
    .add("datum_int64", "long")
    .add("datum_float", "float")
    .add("datum_double", "double")
    .add("datum_bool", "boolean")
    .add("datum_string", "string")
    .add("datum_bytes", "binary")
    .add("datum_point", T.StructType().add("x", "double").add("y", "double"))
    .add("datum_missing", "boolean")
)
TYPE_INFO = T.StructType().add("modifier", "string").add("value_optional", "boolean")
#: a log row as delivered: the message plus its place in the log
LOG_SCHEMA = (
    T.StructType()
    .add("seq", "long")
    .add("lsn", "long")
    .add("transaction_id", "integer")
    .add("commit_time", "long")
    .add("table", "string")
    .add("op", "integer")
    .add("new_tuple", T.ArrayType(DATUM))
    .add("old_tuple", T.ArrayType(DATUM))
    .add("new_typeinfo", T.ArrayType(TYPE_INFO))
)


def read_changes(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    schema: T.StructType = LOG_SCHEMA,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """A log kept as files. The schema is given, so nothing is inferred from the data."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).options(**options).format(fmt).load(path)


def op_name(code: Column) -> Column:
    """Name of an operation code; null for codes this version does not know."""
    pairs = [F.lit(part) for pair in OPS.items() for part in pair]
    return F.create_map(*pairs)[code]


def supported(log: DataFrame) -> DataFrame:
    """Rows with a known operation that carry what the operation needs."""
    filled = F.coalesce(F.size("new_tuple"), F.lit(0)) > 0
    return log.filter(F.col("op").isin(list(OPS)) & (~F.col("op").isin(0, 1) | filled))


def marker(name: str, undelivered: bool) -> Column:
    """Whether the log did not repeat the value of a column."""
    missing = F.coalesce(F.col(f"_n_{name}")["datum_missing"], F.lit(False))
    if undelivered:
        absent = F.col("_new").isNotNull() & ~F.map_contains_key(F.col("_new"), F.lit(name))
        missing = missing | F.coalesce(absent, F.lit(False))
    return missing


def decode_changes(
    log: DataFrame,
    columns: dict[str, str],
    options: dict | None = None,
    undelivered: tuple[str, ...] = (),
    strict: bool = True,
    converters: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Turn datum arrays into one typed column per table column.

    ``columns`` maps names to short type names. The result has ``before`` and ``after``
    structs and ``_unchanged``: the columns whose new value the log did not repeat and
    whose old value is not in the message either. ``undelivered`` names large columns
    that count as unchanged when they are missing from the message altogether. ``converters`` maps
    a regular expression on the column name to a user's own rule, which gets the tagged
    value and goes first.
    Everything happens within a row, so there is no shuffle and no explode.
    """
    own = {
        c: rule for pattern, rule in reversed((converters or {}).items()) for c in columns if re.fullmatch(pattern, c)
    }
    named = lambda x: F.struct(V.identifier(x["column_name"]), x)
    maps = log.withColumns(
        {
            "_new": F.map_from_entries(F.transform("new_tuple", named)),
            "_old": F.map_from_entries(F.transform("old_tuple", named)),
            "op": op_name(F.col("op")),
        }
    )
    # one step per level, so that no level repeats the work of the one below
    datums = maps.withColumns(
        {
            **{f"_n_{c}": F.col("_new")[c] for c in columns},
            **{f"_o_{c}": F.col("_old")[c] for c in columns},
        }
    )
    sides = {"_after_": "_n_", "_before_": "_o_"}
    typed = datums.withColumns(
        {
            f"{side}{c}": own[c](F.col(f"{datum}{c}")) if c in own else V.from_datum(kind, F.col(f"{datum}{c}"), options)
            for side, datum in sides.items()
            for c, kind in columns.items()
        }
        | {f"_marker_{c}": marker(c, c in undelivered) for c in columns}
    )
    if strict:
        # a boolean reads any text, and a type without a rule may be left out
        checked = [
            c for c, k in columns.items() if V.TYPE_ALIASES.get(k, k) not in ("bool", "unknown") and c not in own
        ]
        typed = typed.withColumns(
            {
                f"{side}{c}": V.required(
                    V.datum_text(F.col(f"{datum}{c}")), F.col(f"{side}{c}"), c
                )
                for side, datum in sides.items()
                for c in checked
            }
        )
    after = F.struct(
        *[
            F.when(F.col(f"_marker_{n}"), F.col(f"_before_{n}"))
            .otherwise(F.col(f"_after_{n}"))
            .alias(n)
            for n in columns
        ]
    )
    before = F.struct(*[F.col(f"_before_{n}").alias(n) for n in columns])
    left_open = F.array(
        *[F.when(F.col(f"_marker_{n}") & F.col(f"_before_{n}").isNull(), F.lit(n)) for n in columns]
    )
    table = V.table_id(F.col("table"))
    return typed.select(
        "seq",
        "lsn",
        V.transaction_id(F.col("transaction_id")).alias("txid"),
        F.timestamp_micros("commit_time").alias("commit_ts"),
        table["schema"].alias("schema"),
        table["table"].alias("table"),
        "op",
        F.when(F.col("op").isin("u", "d") & F.col("_old").isNotNull(), before).alias("before"),
        F.when(F.col("op").isin("c", "u"), after).alias("after"),
        F.when(F.col("op").isin("c", "u"), F.array_compact(left_open)).alias("_unchanged"),
    )


def table_changes(decoded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows for ``operators.merge``: the key and the new values as plain columns.

    A delete has its key in the old row only. An update whose old row has another key
    becomes a delete of that key and a create of the new one.
    """
    fields = decoded.schema["after"].dataType
    rest = [f for f in fields if f.name not in keys]
    old, new = F.col("before"), F.col("after")

    def row(op: Column, side: Callable[[str], Column], value: Callable, unchanged: Column) -> Column:
        return F.struct(
            op.alias("op"),
            *[side(k).alias(k) for k in keys],
            *[value(f).cast(f.dataType).alias(f.name) for f in rest],
            unchanged.alias("_unchanged"),
        )

    none = F.array().cast("array<string>")
    moved = F.lit(False)
    for k in keys:
        moved = moved | F.coalesce(old[k] != new[k], F.lit(False))
    moved = moved & (F.col("op") == "u")
    plain = row(
        F.when(moved, "c").otherwise(F.col("op")),
        lambda k: F.coalesce(new[k], old[k]),
        lambda f: new[f.name],
        F.coalesce("_unchanged", none),
    )
    # a key column that the old row leaves out has not changed
    gone = row(F.lit("d"), lambda k: F.coalesce(old[k], new[k]), lambda f: F.lit(None), none)
    changes = F.explode(F.when(moved, F.array(gone, plain)).otherwise(F.array(plain)))
    return decoded.select("seq", "lsn", changes.alias("r")).select("seq", "lsn", "r.*")

"""What both vector searches share: valid rows, candidates, matrices, ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Most rows and queries that meet in one task.
BLOCK_ROWS = 32_768
BLOCK_QUERIES = 2_048


def valid_vectors(df: DataFrame, zero: bool, component=lambda x: x) -> DataFrame:
    """``n, vec_id, vector`` of the rows that take part; ``n`` tells rows apart, also where ids repeat.

    Null ids, null vectors and those with a null or non-finite component take no part, nor do
    vectors without a component other than zero unless ``zero``. Components go through ``component``.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    keep = F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite
    if not zero:
        keep = keep & F.exists("vector", lambda x: x != 0)
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.coalesce(keep, F.lit(False)))
    rows = rows.select(F.monotonically_increasing_id().alias("n"), "vec_id", F.transform("vector", component).alias("vector"))
    return stored(rows, "vectors")


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """The rows that can be among the k best of any query.

    Equal vectors score alike and ties go to the smaller id, so of each group of equal
    vectors only the k + 1 rows of smallest id can be in a result. Spark limits the groups
    before the shuffle, so one vector held by a third of all rows is no hot group.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "n"))
    return vectors.withColumn("_place", place).filter(f"_place <= {k + 1}").drop("_place")


def ranked(found: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows of each ``query`` by ``order``, with their ``rank``."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return found.withColumn("rank", place.cast("int")).filter(f"rank <= {k}")


def matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column as (row numbers, matrix), one entry per vector length."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    out = []
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        out.append((at, flat[starts[at][:, None] + np.arange(d)[None, :]]))
    return out


def matrices(table: pa.Table, name: str = "vector") -> list[tuple[np.ndarray, np.ndarray]]:
    column = table.column(name).combine_chunks()
    return matrix(column) if len(column) else []


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def own_places(query_n: np.ndarray, row_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the queries' own rows in a (queries, rows) matrix."""
    if not len(row_n):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(row_n)
    at = np.searchsorted(row_n, query_n, sorter=order).clip(max=len(row_n) - 1)
    found = row_n[order[at]] == query_n
    return np.flatnonzero(found), order[at][found]

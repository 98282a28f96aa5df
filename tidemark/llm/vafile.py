"""Exact top-k inner products by a vector-approximation file.

The file has a byte per component: the number of one of 256 cells between the ends that the
component has over all rows. It is scanned twice, without the exact vectors: for the kth highest
lower bound of each query, then for the rows whose upper bound reaches it. Exact vectors are
fetched by joins in bound order: those of the k highest upper bounds first; they settle a
kth score, and after that only rows whose upper bound reaches that score are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors as V
from tidemark.llm.common import arrow_map, stored
from tidemark.llm.hard_negatives import BOTTOM, MATRIX, TOP, cells

#: Cells per component; a cell number takes one byte.
CELLS = 256


def grid(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Lowest value and cell width of each component, over all rows, by vector length."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, x in V.matrix(batch.column(0)):
                d, lo, hi = x.shape[1], x.min(axis=0), x.max(axis=0)
                if d in held:
                    lo, hi = np.minimum(lo, held[d][0]), np.maximum(hi, held[d][1])
                held[d] = (lo, hi)
        out = [(d, i, int(lo[i]), int(hi[i])) for d, (lo, hi) in held.items() for i in range(d)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["d", "i", "lo", "hi"]
        )

    found = arrow_map(rows.select("vector"), ends, "d long, i long, lo long, hi long")
    found = found.groupBy("d", "i").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    out: dict[int, list] = {0: []}
    for d, _, lo, hi in found.orderBy("d", "i").collect():  # one row per component
        out.setdefault(d, []).append((float(lo), float(-(-(hi - lo + 1) // CELLS))))  # whole widths
    return {d: (np.array([c[0] for c in cs]), np.array([c[1] for c in cs])) for d, cs in out.items()}


def approximated(rows: DataFrame, sent) -> DataFrame:
    """The approximation file: ``n, vec_id`` and ``cells``, a byte per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list = [b""] * batch.num_rows
            for at, x in V.matrix(batch.column(2)):
                lo, width = sent.value[x.shape[1]]
                code = np.clip((x - lo) // width, 0, CELLS - 1).astype(np.uint8)
                for i, row in zip(at.tolist(), code):
                    codes[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(codes, pa.binary())], names=["n", "vec_id", "cells"]
            )

    return arrow_map(rows.select("n", "vec_id", "vector"), run, "n long, vec_id long, cells binary")


def _bounds(file: pa.Table, queries: pa.Table, sent):
    """(query places, row places, middles, slacks): a product is within its middle plus or minus
    the query's slack. A query's own row has the middle minus infinity."""
    codes = file.column("cells").to_pylist()
    sizes = np.array([len(c) for c in codes])
    row_n, own = V.numbers(file, "n"), V.numbers(queries, "n")
    for at, q in V.matrices(queries):
        d = q.shape[1]
        places = np.flatnonzero(sizes == d)
        if not len(places):
            continue
        lo, width = sent.value[d]
        code = np.frombuffer(b"".join(codes[i] for i in places.tolist()), np.uint8).reshape(len(places), d)
        middle = lo + code * width + (width - 1) / 2  # between a cell's first and last whole number
        largest = np.abs(middle).max(axis=0)
        step = max(1, MATRIX // len(places))
        for s in range(0, len(at), step):
            part, qf = at[s : s + step], q[s : s + step].astype(float)
            # half a cell, and what rounding of floats can add
            slack = np.abs(qf) @ ((width - 1) / 2 + 1e-6 * (width > 1 << 20) * width) + 1e-9 * (np.abs(qf) @ largest)
            centre = qf @ middle.T
            centre[V.own_places(own[part], row_n[places])] = -np.inf
            yield part, places, centre, slack


def _floors(sent, k: int):
    """Each query's k highest lower bounds in one cell of rows and queries."""

    def run(file: pa.Table, queries: pa.Table) -> pa.Table:
        own = V.numbers(queries, "n")
        query, low = [np.empty(0, np.int64)], [np.empty(0)]
        for part, places, centre, slack in _bounds(file, queries, sent):
            if len(places) > k:
                centre = np.partition(centre, len(places) - k, axis=1)[:, -k:]
            bound = np.clip(centre - slack[:, None], BOTTOM, TOP)
            query.append(np.repeat(own[part], centre.shape[1])[np.isfinite(centre).ravel()])
            low.append(bound[np.isfinite(centre)])
        return pa.table({"query": np.concatenate(query), "low": np.concatenate(low)})

    return run


def _reached(sent, k: int):
    """Pairs of one cell whose upper bound reaches the query's floor.

    Bounds without slack are the scores themselves, as those of a zero query, which all rows
    reach: of such a query only the k pairs that come first in the result's order go on.
    """

    def run(file: pa.Table, queries: pa.Table) -> pa.Table:
        own, row_n, row_id = V.numbers(queries, "n"), V.numbers(file, "n"), V.numbers(file, "vec_id")
        floor = queries.column("floor").to_numpy()
        out = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
        for part, places, centre, slack in _bounds(file, queries, sent):
            # scores beyond a long stop at its ends, so bounds do
            high = np.clip(centre + slack[:, None], BOTTOM, TOP)
            reached = (high >= floor[part][:, None]) & np.isfinite(centre)
            for i in np.flatnonzero(slack == 0):
                j = np.flatnonzero(reached[i])
                reached[i, j[np.lexsort((row_id[places[j]], -high[i, j]))[k:]]] = False
            i, j = np.nonzero(reached)
            for o, values in zip(out, (own[part[i]], row_n[places[j]], high[i, j])):
                o.append(values)
        return pa.table({c: np.concatenate(o) for c, o in zip(("query", "row", "high"), out)})

    return run


def row_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of like rows; those beyond a long stop at its ends."""
    # in Python integers, as the magnitude of the least long is none
    largest = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    if largest(x) * largest(q) * x.shape[1] <= TOP:
        return np.einsum("ij,ij->i", x, q, dtype=np.int64)
    sums = [sum(a * b for a, b in zip(v, w)) for v, w in zip(x.tolist(), q.tolist())]
    return np.array([min(max(s, BOTTOM), TOP) for s in sums], dtype=np.int64)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.zeros(batch.num_rows, dtype=np.int64)
        for (at, x), (_, q) in zip(V.matrix(batch.column(3)), V.matrix(batch.column(4))):
            scores[at] = row_products(x, q)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(scores)], names=["query", "query_id", "vec_id", "score"]
        )


def exact_scores(pairs: DataFrame, rows: DataFrame, queries: DataFrame, block_queries: int) -> DataFrame:
    """``query, query_id, vec_id, score`` of each pair ``query, row``.

    A row that many queries ask for is fetched once for each block of queries, so no join
    has more than a block's pairs under one key on that side.
    """
    blocks = F.ceil(F.lit(queries.count() / block_queries)).cast("long")
    asked = pairs.select("query", "row", F.pmod(F.xxhash64("query"), F.greatest(blocks, F.lit(1))).alias("block"))
    fetched = asked.select("row", "block").distinct().join(
        rows.select(F.col("n").alias("row"), "vec_id", "vector"), "row"
    )
    known = queries.select(F.col("n").alias("query"), F.col("vec_id").alias("query_id"), F.col("vector").alias("wanted"))
    both = asked.join(fetched, ["row", "block"]).join(known, "query")
    return arrow_map(both.select("query", "query_id", "vec_id", "vector", "wanted"), _score,
                     "query long, query_id long, vec_id long, score long")


def top_products(embeddings: DataFrame, every: int, k: int, factor: int = 256, block_rows: int = V.BLOCK_ROWS,
                 block_queries: int = V.BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest integer inner products, exactly.

    Components become ``floor(factor * x)``. Queries are the rows whose id is divisible by ``every``;
    a query's own row is not its candidate, vectors meet those of their own length, ties go
    to the smaller id. Null vectors, null ids, null and non-finite components take no part;
    zero and empty vectors do. Rows are rows: those that repeat an id are further candidates and
    queries, each query row with ranks of its own. Components and scores beyond a long stop at its
    ends. Empty input, empty result.
    """
    spark = embeddings.sparkSession
    whole = V.valid_vectors(embeddings, zero=True, component=lambda x: F.floor(x * factor).cast("long"))
    sent = spark.sparkContext.broadcast(grid(whole))  # two numbers per component
    rows = stored(V.candidates(whole, k), "vector-rows")
    file = stored(approximated(rows, sent), "va-file")
    queries = whole.filter(f"vec_id % {every} = 0")

    lows = cells(file, queries, block_rows, block_queries).applyInArrow(_floors(sent, k), "query long, low double")
    floors = V.ranked(lows, k, F.desc("low")).groupBy("query").agg(
        F.when(F.count(F.lit(1)) == k, F.min("low")).alias("kth")
    )
    bounded = queries.join(floors, F.col("n") == F.col("query"), "left").select(
        "n", "vector", F.coalesce("kth", F.lit(float(BOTTOM))).alias("floor")
    )
    bounded = stored(bounded, "query-floors")
    reach = cells(file, bounded, block_rows, block_queries).applyInArrow(
        _reached(sent, k), "query long, row long, high double"
    )
    reach = stored(reach, "reached")

    # no window over all pairs of a query: the first k are cut before the shuffle, the rest lie behind the kth
    heads = stored(V.ranked(reach, k, F.desc("high"), "row"), "first-pairs")
    first = stored(exact_scores(heads, rows, queries, block_queries), "first-scores")
    kth = first.groupBy("query").agg(F.min("score").alias("kth"))
    last = heads.filter(f"rank = {k}").select("query", F.col("high").alias("last_high"), F.col("row").alias("last_row"))
    behind = "(high < last_high or (high = last_high and row > last_row)) and high >= kth"
    rest = reach.join(last.join(kth, "query"), "query").filter(behind).select("query", "row")
    found = first.unionByName(exact_scores(rest, rows, queries, block_queries))
    return V.ranked(found, k, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")

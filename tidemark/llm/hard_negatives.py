"""Hard negatives: rows of another label that score just below an anchor's positives.

Anchors meet all rows in blocks. A block keeps, for each anchor, only what can be in the
result, so what is shuffled afterwards is a few rows per anchor and block. There a secondary
sort brings each anchor's pairs in descending score: positives open windows, negatives
fall into the open ones, and nothing of an anchor is held but its windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import vectors as V
from tidemark.llm.common import arrow_map, stored

#: Most rows and anchors that meet in one task.
BLOCK_ROWS = 32_768
BLOCK_ANCHORS = 8_192
#: Rows below which a block is not worth a task of its own.
LEAST_ROWS = 2_048
#: Cells of a score matrix that are held at once.
MATRIX = 1 << 22
TOP, BOTTOM = (1 << 63) - 1, -(1 << 63)
#: A packed key: anchor, descending score, kind (positives first), id; big-endian without sign.
KEY_BYTES = 25
POSITIVE, NEGATIVE = 0, 1


def labelled_rows(df: DataFrame, factor: int) -> DataFrame:
    """``n, vec_id, label, vector`` of the rows that take part; ``n`` tells rows apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    keep = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    parts = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * factor).cast("long"))
    rows = df.filter(F.coalesce(keep, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), parts.alias("vector")
    )
    return stored(rows.withColumn("n", F.monotonically_increasing_id()), "labelled-rows")


def cells(rows: DataFrame, anchors: DataFrame, block_rows: int, block_anchors: int):
    """Both tables dealt into cells: each anchor meets each row in exactly one."""
    spark = rows.sparkSession
    n, m = rows.count(), anchors.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row_blocks = max(1, math.ceil(n / block_rows), min(tasks, n // LEAST_ROWS))
    anchor_blocks = max(1, math.ceil(m / block_anchors))
    block = lambda blocks: F.pmod(F.xxhash64("n"), F.lit(blocks))
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    left = rows.withColumn("r", block(row_blocks)).withColumn("q", every(anchor_blocks))
    right = anchors.withColumn("q", block(anchor_blocks)).withColumn("r", every(row_blocks))
    return left.groupBy("r", "q").cogroup(right.groupBy("r", "q"))


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond a long stop at its ends."""
    if x.shape[1] == 0:
        return np.zeros((len(q), len(x)), dtype=np.int64)
    # in Python integers, as the magnitude of the least long is none
    largest = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    bound = largest(x) * largest(q) * x.shape[1]
    if bound < 1 << 53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    if bound <= TOP:
        return q @ x.T
    exact = q.astype(object) @ x.T.astype(object)
    return np.clip(exact, BOTTOM, TOP).astype(np.int64)


def _score_blocks(rows: pa.Table, anchors: pa.Table):
    """(anchor places, row places, scores) for vectors of equal length, a matrix at a time.

    Row places go by ascending id.
    """
    order = np.argsort(_column(rows, "vec_id"), kind="stable")
    by_length = dict((x.shape[1], (at, x)) for at, x in _matrices(rows.take(pa.array(order))))
    for at, q in _matrices(anchors):
        if q.shape[1] not in by_length:
            continue
        places, x = by_length[q.shape[1]]
        step = max(1, MATRIX // max(1, len(x)))
        for s in range(0, len(at), step):
            yield at[s : s + step], order[places], products(x, q[s : s + step])


def _matrices(table: pa.Table):
    column = table.column("vector").combine_chunks()
    return V.matrix(column) if len(column) else []


def first_of(scores: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of the wanted scores; of equal ones the first places."""
    at = np.flatnonzero(wanted)
    if len(at) > k:
        found = scores[at]
        kth = np.partition(found, len(at) - k)[len(at) - k]
        above = at[found > kth]
        at = np.concatenate([above, at[found == kth][: k - len(above)]])
    return at


def _positives(k: int):
    """Each anchor's k best rows of its label in one cell."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        row_n, row_id, row_label = (_column(rows, c) for c in ("n", "vec_id", "label"))
        own, label = _column(anchors, "n"), _column(anchors, "label")
        out = [[np.empty(0, np.int64)] for _ in range(3)]
        if len(own) and len(row_n):
            for at, places, scores in _score_blocks(rows, anchors):
                labels, ns = row_label[places], row_n[places]
                for i, a in enumerate(at):
                    best = first_of(scores[i], (labels == label[a]) & (ns != own[a]), k)
                    out[0].append(np.full(len(best), own[a]))
                    out[1].append(scores[i][best])
                    out[2].append(row_id[places[best]])
        return pa.table({c: np.concatenate(o) for c, o in zip(("anchor", "score", "vec_id"), out)})

    return run


def bounds(score: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest whole score within ``low`` and ``high`` parts of ``score``."""
    return -(-score * low[0] // low[1]), score * high[0] // high[1]


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, vec_id: np.ndarray) -> np.ndarray:
    """Keys that sort as bytes by anchor, descending score, kind and id."""
    flip = np.uint64(1 << 63)
    out = np.empty((len(anchor), KEY_BYTES), np.uint8)
    parts = ((0, anchor.astype(np.int64).view(np.uint64) ^ flip), (8, ~(score.astype(np.int64).view(np.uint64) ^ flip)),
             (17, vec_id.astype(np.int64).view(np.uint64) ^ flip))
    for start, values in parts:
        out[:, start : start + 8] = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 16] = kind
    return out


def unpacked(keys: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, score, kind and id of packed keys."""
    flip = np.uint64(1 << 63)
    read = lambda s: np.ascontiguousarray(keys[:, s : s + 8]).view(">u8").reshape(-1).astype(np.uint64)
    return ((read(0) ^ flip).view(np.int64), (~read(8) ^ flip).view(np.int64), keys[:, 16], (read(17) ^ flip).view(np.int64))


def _key_table(anchor, anchor_id, keys: np.ndarray) -> pa.Table:
    column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(KEY_BYTES), len(keys), [None, pa.py_buffer(keys.tobytes())])
    return pa.table({"anchor": anchor, "anchor_id": anchor_id, "key": column.cast(pa.binary())})


def _pairs(k: int, low, high):
    """Packed pairs of a cell: each window's k first negatives of another label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        row_id, row_label = _column(rows, "vec_id"), _column(rows, "label")
        own, own_id, label = (_column(anchors, c) for c in ("n", "vec_id", "label"))
        windows = [sorted({bounds(s, low, high) for s in scores}) for scores in anchors.column("scores").to_pylist()]
        none = np.empty(0, np.int64)
        found = [[none], [none], [none], [none]]
        if len(own) and len(row_id):
            for at, places, scores in _score_blocks(rows, anchors):
                labels = row_label[places]
                for i, a in enumerate(at):
                    other = labels != label[a]
                    best = [first_of(scores[i], other & (scores[i] >= max(lo, BOTTOM)) & (scores[i] <= hi), k)
                            for lo, hi in windows[a] if lo <= hi]
                    if best:
                        best = np.unique(np.concatenate(best))
                        values = (np.full(len(best), own[a]), np.full(len(best), own_id[a]), scores[i][best], row_id[places[best]])
                        for o, v in zip(found, values):
                            o.append(v)
        anchor, anchor_id, score, vec_id = map(np.concatenate, found)
        return _key_table(anchor, anchor_id, packed(anchor, score, NEGATIVE, vec_id))

    return run


def _positive_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, anchor_id, score, vec_id = (c.to_numpy() for c in batch.columns)
        table = _key_table(anchor, anchor_id, packed(anchor, score, POSITIVE, vec_id))
        yield from table.to_batches()


def _emit(k: int, low, high):
    """Read sorted keys; an anchor's state is its open windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, windows = None, []
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, KEY_BYTES)
            out = []
            values = zip(batch.column(1).to_pylist(), *(c.tolist() for c in unpacked(keys)))
            for anchor_id, anchor, score, kind, vec_id in values:
                if anchor != current:
                    current, windows = anchor, []
                if kind == POSITIVE:
                    lo, hi = bounds(score, low, high)
                    if lo <= hi:
                        windows.append([lo, hi, score, vec_id, 0])
                    continue
                for w in windows:
                    if w[0] <= score <= w[1] and w[4] < k:
                        w[4] += 1
                        out.append((anchor_id, w[3], w[4], vec_id, w[2], score))
                # scores only fall: a full window, or one above them, is closed
                windows = [w for w in windows if w[4] < k and score >= w[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.int32() if i == 2 else pa.int64()) for i in range(6)],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
            )

    return run


def mine(
    embeddings: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    factor: int = 256,
    block_rows: int = BLOCK_ROWS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. A pair's score is the inner product
    of ``floor(factor * x)``; higher first, ties to the smaller id. An anchor's positives are
    its first ``positives`` other rows of its label. For each of them the first ``negatives`` rows of
    another label whose score lies within ``low`` and ``high`` parts of the positive's. All rows
    are compared; the result is exact.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Rows are rows: those that repeat an id are further anchors and candidates, and only the
    anchor's own row is left out. Vectors meet those of their own length; empty ones score 0.
    Components and scores beyond a long stop at its ends. Empty table, empty result.
    """
    rows = labelled_rows(embeddings, factor)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    first = cells(rows, anchors, block_rows, block_anchors).applyInArrow(_positives(positives), "anchor long, score long, vec_id long")
    by_rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id"))
    best = stored(first.withColumn("rank", by_rank).filter(F.col("rank") <= positives).drop("rank"), "positives")
    scored = best.groupBy("anchor").agg(F.collect_list("score").alias("scores"))  # at most ``positives`` each
    # anchors without a positive have no windows
    ready = stored(anchors.join(scored, F.col("n") == F.col("anchor")).drop("anchor"), "anchors")
    pairs = cells(rows, ready, block_rows, block_anchors).applyInArrow(
        _pairs(negatives, low, high), "anchor long, anchor_id long, key binary"
    )
    own = ready.select(F.col("n").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    opened = arrow_map(best.join(own, "anchor").select("anchor", "anchor_id", "score", "vec_id"), _positive_keys,
                       "anchor long, anchor_id long, key binary")
    # the secondary sort: dealt by anchor, sorted by the whole key
    dealt = stored(pairs, "negative-pairs").unionByName(opened).repartition("anchor").sortWithinPartitions("key")
    return arrow_map(
        dealt, _emit(negatives, low, high),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )


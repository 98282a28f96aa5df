"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors as V
from tidemark.llm.common import arrow_map, stored
from tidemark.llm.hard_negatives import cells

#: The forest is fitted on at most this many rows; every row is indexed.
SAMPLE = 20_000
TREES = 16
#: A node with at most this many sampled rows is a leaf.
LEAF = 16
#: Part of all leaves that the shared queue gives a query. On 64 components without clusters
#: 0.07 meets about two thirds of the rows; the README has the recall that was measured.
SHARE = 0.07


class Tree:
    """Hyperplanes in arrays; a child below zero is the leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, rng: np.random.Generator, leaf: int):
        self.normals, self.offsets, self.children = [], [], []
        self.leaves = 0
        self.root = self._grow(sample, np.arange(len(sample)), rng, leaf, 0)
        d = sample.shape[1]
        self.normals = np.array(self.normals).reshape(-1, d)
        self.offsets = np.array(self.offsets)
        self.children = np.array(self.children, dtype=np.int64).reshape(-1, 2)

    def _grow(self, sample, at, rng, leaf, depth) -> int:
        if len(at) > leaf and depth < 40:
            for _ in range(4):  # two equal points give no plane
                a, b = sample[rng.choice(at, 2, replace=False)]
                normal = a - b
                norm = np.linalg.norm(normal)
                if norm > 0:
                    normal = normal / norm
                    side = sample[at] @ normal
                    offset = float(np.median(side))
                    left, right = at[side < offset], at[side >= offset]
                    if len(left) and len(right):
                        node = len(self.normals)
                        self.normals.append(normal)
                        self.offsets.append(offset)
                        self.children.append([0, 0])
                        self.children[node] = [
                            self._grow(sample, left, rng, leaf, depth + 1),
                            self._grow(sample, right, rng, leaf, depth + 1),
                        ]
                        return node
        self.leaves += 1
        return -self.leaves

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.full(len(x), self.root)
        while (live := np.flatnonzero(node >= 0)).size:
            at = node[live]
            side = np.einsum("ij,ij->i", x[live], self.normals[at]) >= self.offsets[at]
            node[live] = self.children[at, side.astype(np.int64)]
        return -1 - node


class Forest:
    def __init__(self, sample: np.ndarray, trees: int, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        self.trees = [Tree(sample, rng, leaf) for _ in range(trees)]
        self.stride = max((t.leaves for t in self.trees), default=1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree, numbered through the forest."""
        return np.stack([t.leaf_of(x) + i * self.stride for i, t in enumerate(self.trees)])

    def probe(self, x: np.ndarray, share: float) -> list[int]:
        """The best leaves of all trees, from one queue ordered by the worst margin on the way."""
        margins = [(t.normals @ x - t.offsets).tolist() for t in self.trees]
        queue = [(-np.inf, i, t.root) for i, t in enumerate(self.trees)]
        heapq.heapify(queue)
        probes = max(len(self.trees), int(np.ceil(share * sum(t.leaves for t in self.trees))))
        found: list[int] = []
        while queue and len(found) < probes:
            worst, i, node = heapq.heappop(queue)
            if node < 0:
                found.append(i * self.stride - 1 - node)
                continue
            m = margins[i][node]
            left, right = self.trees[i].children[node].tolist()
            heapq.heappush(queue, (max(worst, -m), i, right))
            heapq.heappush(queue, (max(worst, m), i, left))
        return found


def fit(rows: DataFrame, sample: int, trees: int, leaf: int, seed: int) -> dict[int, Forest]:
    """A forest for each vector length, from a sample of at most ``sample`` rows.

    The sample and its order depend on the rows alone, not on how they are dealt.
    """
    share = min(1.0, 1.05 * sample / max(1, rows.count()))
    mark = F.xxhash64("vec_id", "vector", F.lit(seed))
    picked = rows.select("vec_id", "vector", mark.alias("mark")).filter(
        F.pmod("mark", F.lit(1 << 20)) < share * (1 << 20)
    )
    by_size: dict[int, list] = {}
    for (v,) in picked.orderBy("mark", "vec_id").limit(sample).select("vector").collect():
        by_size.setdefault(len(v), []).append(v)
    return {d: Forest(np.array(vs), trees, leaf, seed) for d, vs in by_size.items()}


def _indexed(forests):
    """The leaf of each row in each tree; none for a length that the sample has not met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves: list = [[]] * batch.num_rows
            for at, x in V.matrix(batch.column(2)):
                if x.shape[1] in forests.value:
                    for i, row in zip(at.tolist(), forests.value[x.shape[1]].codes(x).T.astype(np.int32)):
                        leaves[i] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int32()))], names=["n", "vec_id", "vector", "leaves"]
            )

    return run


def _probed(forests, share: float):
    """The leaves that the shared queue gives each query, as a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for v in batch.column(2).to_pylist():
                forest = forests.value.get(len(v))
                if forest is None:
                    maps.append(b"")
                    continue
                wanted = np.zeros(forest.stride * len(forest.trees), dtype=bool)
                wanted[forest.probe(np.array(v), share)] = True
                maps.append(np.packbits(wanted).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(maps, pa.binary())], names=["n", "vec_id", "vector", "wanted"]
            )

    return run


def _search(k: int):
    """Each query's k nearest among the rows of one cell that share a leaf with its probes."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        row_n, row_id = V.numbers(rows, "n"), V.numbers(rows, "vec_id")
        own, own_id = V.numbers(queries, "n"), V.numbers(queries, "vec_id")
        by_length = {x.shape[1]: (at, x) for at, x in V.matrices(rows)}
        leaves = rows.column("leaves").combine_chunks() if len(row_n) else None
        maps = queries.column("wanted").to_pylist()
        none = np.empty(0, np.int64)
        out = [[none], [none], [none], [np.empty(0)]]
        for at, points in V.matrices(queries):
            if points.shape[1] not in by_length:
                continue
            places, x = by_length[points.shape[1]]
            codes = None
            if maps[at[0]]:  # the length was met by the sample
                _, codes = V.matrix(leaves.take(pa.array(places)))[0]
                codes = np.ascontiguousarray(codes.T)
            for i, point in zip(at.tolist(), points):
                near = np.ones(len(x), dtype=bool)
                if codes is not None:
                    wanted = np.unpackbits(np.frombuffer(maps[i], np.uint8)).view(bool)
                    near = wanted[codes].any(axis=0)
                near = np.flatnonzero(near & (row_n[places] != own[i]))
                dist = np.sqrt(((x[near] - point) ** 2).sum(axis=1))
                if len(near) > k:
                    close = dist <= np.partition(dist, k - 1)[k - 1]
                    near, dist = near[close], dist[close]
                ids = row_id[places[near]]
                best = np.lexsort((ids, dist))[:k]
                for o, values in zip(out, (np.full(len(best), own[i]), np.full(len(best), own_id[i]), ids[best], dist[best])):
                    o.append(values)
        return pa.table({c: np.concatenate(o) for c, o in zip(("query", "query_id", "vec_id", "score"), out)})

    return run


def nearest(embeddings: DataFrame, every: int, k: int, sample: int = SAMPLE, trees: int = TREES,
            leaf: int = LEAF, share: float = SHARE, seed: int = 7, block_rows: int = V.BLOCK_ROWS,
            block_queries: int = V.BLOCK_QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for rows whose id is divisible by ``every``.

    Euclidean distance in double precision; ties go to the smaller id; a query's own row is not its
    neighbour and vectors meet those of their own length. Null, empty, zero and non-finite
    vectors and null ids take no part. Rows are rows: those that repeat an id are further candidates
    and queries, each query row with ranks of its own. The forest is fitted on a bounded sample; each
    row then falls into one leaf of each tree. A query takes ``share`` of the leaves from one priority
    queue over all trees, and the rows in them are ranked by exact distance. Rows and queries meet
    in blocks, by a shuffle on two block numbers. Empty input, empty result.
    """
    spark = embeddings.sparkSession
    valid = V.valid_vectors(embeddings, zero=False)
    rows = stored(V.candidates(valid, k), "vector-rows")
    forests = spark.sparkContext.broadcast(fit(rows, sample, trees, leaf, seed))
    schema = "n long, vec_id long, vector array<double>"
    index = stored(arrow_map(rows, _indexed(forests), f"{schema}, leaves array<int>"), "forest-index")
    # a query's probes take far longer than its bytes suggest, so the number of tasks is set here
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = valid.filter(f"vec_id % {every} = 0").repartition(tasks, "n")
    queries = stored(arrow_map(picked, _probed(forests, share), f"{schema}, wanted binary"), "probes")
    found = cells(index, queries, block_rows, block_queries).applyInArrow(
        _search(k), "query long, query_id long, vec_id long, score double"
    )
    return V.ranked(found, k, "score", "vec_id").select("query_id", "rank", "vec_id", "score")

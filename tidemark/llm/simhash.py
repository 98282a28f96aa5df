"""SimHash near-duplicates, found through Golay-code keys.

The perfect binary Golay code has 4096 codewords of 23 bits, and every 23-bit word is
within 3 bits of exactly one. Decoding a word and all words one bit away gives a few
nearby codewords; two words that differ in at most 2 bits have one of them in common.

A fingerprint is cut into three segments of 22, 21 and 21 bits, each padded to 23. If two
fingerprints differ in at most 4 bits, one of two things holds:

- some segment is equal, and then one of the other two differs in at most 2 bits. Key: the
  equal segment and each nearby codeword of the other one (6 ordered pairs of segments);
- all segments differ, so at least two of them differ in exactly one bit. The one
  with an even number of ones is then decoded as it is, the other one from all words one
  bit away. Key: a codeword of either segment, and whether their parities agree.

So no link is missed. Fingerprints that share a key are compared bit by bit.

A key of very many different fingerprints would be one task's work. Its fingerprints meet in another
way: two of them differ in at most 4 bits if and only if some word is within 2 bits of both. No
word has more than 2,081 fingerprints within 2 bits, and all of those are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, components, popcount, text_bytes
from tidemark.plans.scratch import materialise

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Segment bounds in the fingerprint.
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16
#: Comparisons made at once inside a key.
CELLS = 1 << 22
#: Keys of more different fingerprints than this are not compared in one task.
HOT = 50_000


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(size, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        octets = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, columns: list[str] = ["doc_id"]) -> DataFrame:
    """``columns`` and ``fp``, the fingerprint as a signed long, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in text_bytes(batch.column(0))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(fps.view(np.int64))], names=[*columns, "fp"])

    kept = docs.select("text", *columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return arrow_map(kept, run, f"{schema}, fp long")


@lru_cache(maxsize=1)
def decoder() -> np.ndarray:
    """Index of the one codeword within 3 bits, for each 23-bit word."""
    messages = np.arange(1 << 12)
    words = np.zeros(1 << 12, dtype=np.int64)
    for bit in range(12):
        words ^= np.where(messages >> bit & 1, GENERATOR << bit, 0)
    one = 1 << np.arange(23)
    errors = [0, *one]
    errors += [one[a] | one[b] for a in range(23) for b in range(a)]
    errors += [one[a] | one[b] | one[c] for a in range(23) for b in range(a) for c in range(b)]
    table = np.zeros(1 << 23, dtype=np.int16)
    for e in errors:
        table[words ^ e] = messages
    return table


def segments(fps: np.ndarray) -> list[np.ndarray]:
    return [(fps >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints: (row numbers, keys), each key of a row once."""
    table, rows, keys = decoder(), [], []
    every = np.arange(len(fps))
    parts = segments(fps)
    near, odd = [], []
    for x, (_, width) in zip(parts, SEGMENTS):
        ball = table[x[:, None] ^ np.concatenate(([0], 1 << np.arange(width)))[None, :]].astype(np.int64)
        near.append(ball)
        odd.append((popcount(x) & 1).astype(bool))

    def add(pattern: int, at: np.ndarray, payload: np.ndarray) -> None:
        pairs = np.unique(np.stack([at, payload | pattern << 40]), axis=1)
        rows.append(pairs[0])
        keys.append(pairs[1])

    def once(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct codewords of each row, as (rows, codewords)."""
        codes = np.sort(codes, axis=1)
        first = np.ones(codes.shape, dtype=bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        at, column = np.nonzero(first)
        return at, codes[at, column]

    pattern = 0
    for j in range(3):
        at, codes = once(near[j])
        for i in range(3):
            if i != j:
                add(pattern, at, parts[i][at] << 12 | codes)
                pattern += 1
    # an even segment offers its own codeword, an odd one those of all words one bit away
    chosen = []
    for s in range(3):
        codes = np.where(odd[s][:, None], near[s], near[s][:, :1])
        codes[:, 0] = np.where(odd[s], codes[:, 1], codes[:, 0])
        chosen.append(once(codes))
    for i, j in ((0, 1), (0, 2), (1, 2)):
        count_j = np.bincount(chosen[j][0], minlength=len(fps))
        start_j = np.cumsum(count_j) - count_j
        at, codes = chosen[i]
        times = count_j[at]
        left = np.repeat(np.arange(len(at)), times)
        inner = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        other = chosen[j][1][start_j[at[left]] + inner]
        agree = (odd[i] ^ odd[j])[at[left]].astype(np.int64)
        add(pattern, every[at[left]], agree << 24 | codes[left] << 12 | other)
        pattern += 1
    return np.concatenate(rows), np.concatenate(keys)


def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within ``fps`` (distinct), at most one fewer than members.

    The search goes from found members to those not found yet only, so a dense
    group takes few rounds over what is left of it, not all its pairs.
    """
    left, a, b = fps, [], []
    while len(left) > 1:
        frontier, left = [left[:1]], left[1:]
        while frontier and len(left):
            front = frontier.pop()
            step = max(1, CELLS // len(left))
            if len(front) > step:
                frontier.append(front[step:])
                front = front[:step]
            close = popcount(front[:, None] ^ left[None, :]) <= radius
            hit = close.any(axis=0)
            if hit.any():
                a.append(front[close.argmax(axis=0)[hit]])
                b.append(left[hit])
                frontier.append(left[hit])
                left = left[~hit]
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each key; rows come sorted by key, a key may span batches."""

    def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        sizes = np.diff(cuts)
        at = cuts[:-1][sizes == 2]
        two = popcount(fps[at] ^ fps[at + 1]) <= RADIUS if len(at) else np.zeros(0, dtype=bool)
        a, b = [fps[at[two]]], [fps[at[two] + 1]]
        for i in np.flatnonzero(sizes > 2):
            x, y = forest(np.unique(fps[cuts[i] : cuts[i + 1]]))
            a.append(x)
            b.append(y)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"]
        )

    waiting: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        waiting.append((keys, batch.column(1).to_numpy().view(np.uint64)))
        if keys[-1] == waiting[0][0][0]:
            continue  # still inside one key
        held_keys = np.concatenate([w[0] for w in waiting])
        held = np.concatenate([w[1] for w in waiting])
        end = np.searchsorted(held_keys, held_keys[-1])
        yield found(held_keys[:end], held[:end])
        waiting = [(held_keys[end:], held[end:])]
    if waiting:
        yield found(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]))


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all of ``fps`` (column ``fp``, distinct) within ``RADIUS`` bits."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), 1024):
                part = values[at : at + 1024]
                rows, keys = golay_keys(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(part[rows].view(np.int64))], names=["key", "fp"]
                )

    keyed = arrow_map(fps.select("fp"), expand, "key long, fp long")
    hot = materialise(keyed.groupBy("key").count().filter(F.col("count") > HOT).select("key"), "hot-keys")
    cold = keyed.join(hot, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    crowded = materialise(keyed.join(hot, "key", "left_semi").select("fp").distinct(), "crowded")
    return arrow_map(cold, _links, "a long, b long").unionByName(ball_links(crowded))


def ball_links(fps: DataFrame) -> DataFrame:
    """Links ``a, b`` that join ``fps`` (distinct) within 4 bits, through the words within 2 bits.

    A word's fingerprints, 2,081 at most, are linked to its smallest one; work and rows are in
    proportion to the fingerprints, however alike they are.
    """
    bit = lambda i: F.when(F.col(i) < 64, F.expr(f"shiftleft(1L, {i})")).otherwise(F.lit(0).cast("long"))
    words = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))  # 64: no bit
    words = words.select("fp", "i", F.explode(F.sequence(F.least(F.col("i") + 1, F.lit(64)), F.lit(64))).alias("j"))
    words = words.select("fp", F.col("fp").bitwiseXOR(bit("i")).bitwiseXOR(bit("j")).alias("word"))
    near = words.groupBy("word").agg(F.collect_list("fp").alias("near")).filter(F.size("near") > 1)
    linked = near.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    return linked.filter("a <> b").distinct()


def classes(marked: DataFrame, of: str = "component_id") -> DataFrame:
    """``fp, component_id`` for every fingerprint in ``marked`` (columns ``doc_id``, ``fp``).

    With ``of="root"`` the smallest fingerprint stands for a class instead of its smallest id.
    Equal fingerprints are one node, so a text copied into a third of all rows is one too.
    """
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = components(materialise(fingerprint_links(nodes), "fingerprint-links"))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    if of == "root":
        return rooted.select("fp", "root")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row.

    Fingerprints are over 4-word shingles of the whole text; null and blank texts have
    fingerprint zero and are linked like any other. ``component_id`` is the smallest
    doc_id that links of at most 4 differing bits reach (null ids are ignored; null if
    there are no others). Repeated rows stay. Only ``doc_id`` and ``text`` are read. Empty
    input, empty result.
    """
    marked = materialise(fingerprints(docs), "simhash")
    out = marked.join(classes(marked), "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

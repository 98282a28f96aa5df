"""Byte-level BPE by a rank queue: encode whole texts to token ids and decode them.

Merging keeps the parts of pre-tokens in a linked list over byte positions. A queue holds a
bucket of positions for each merge rank that occurs, and a hierarchy of 64-way bitmaps
over the ranks: find-first-set on three words gives the lowest rank in use, whose
positions are merged from left to right. A merge changes at most two pairs;
their old entries stay in the queue and are skipped when met. All new pre-tokens of
a group of texts lie in one array and share one queue; no pair reaches over a pre-token's end. So n
bytes take O(n log n) steps, in however few pre-tokens, and the queue's upkeep is paid per rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_map

#: Pre-tokens whose ids a worker remembers before it starts anew.
MEMO = 500_000
#: Characters of texts whose new pre-tokens share a queue.
GROUP_CHARS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def byte_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """Rank of each pair of bytes, -1 for those that are no token."""
    table = np.full(1 << 16, -1, dtype=np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            table[token[0] << 8 | token[1]] = rank
    return table


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    return merge_all([piece], ranks, byte_pairs(ranks))[0]


def merge_all(pieces: list[bytes], ranks: dict[bytes, int], pairs: np.ndarray) -> list[list[int]]:
    """Ids of each pre-token, by one queue for all of them."""
    get = ranks.get
    out = [[whole] if (whole := get(piece)) is not None else None for piece in pieces]
    todo = [i for i, ids in enumerate(out) if ids is None and pieces[i]]
    data = b"".join([pieces[i] for i in todo])
    if not data:
        return [ids or [] for ids in out]
    sizes = np.array([len(pieces[i]) for i in todo])
    ends = np.cumsum(sizes)
    n = len(data)
    after = list(range(1, n + 1))
    before = np.arange(-1, n - 1)
    before[ends - sizes] = -1
    before = before.tolist()
    limit = np.repeat(ends, sizes).tolist()
    octets = np.frombuffer(data, np.uint8).astype(np.int64)
    first = np.append(pairs[octets[:-1] << 8 | octets[1:]], -1)
    first[ends - 1] = -1
    #: rank of the pair that starts at a position, -1 if it is no token
    at = first.tolist()
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0) :]
    used, starts = np.unique(first[order], return_index=True)
    buckets = dict(zip(used.tolist(), (part.tolist() for part in np.split(order, starts[1:])))) if len(used) else {}
    words: dict[int, int] = {}
    groups: dict[int, int] = {}
    top = 0
    for r in buckets:
        w, g = r >> 6, r >> 12
        words[w] = words.get(w, 0) | 1 << (r & 63)
        groups[g] = groups.get(g, 0) | 1 << (w & 63)
        top |= 1 << g
    while top:
        g = (top & -top).bit_length() - 1
        group = groups[g]
        w = g << 6 | (group & -group).bit_length() - 1
        word = words[w]
        r = w << 6 | (word & -word).bit_length() - 1
        bucket = buckets.pop(r)
        words[w] = word & (word - 1)
        if not words[w]:
            groups[g] = group & (group - 1)
            if not groups[g]:
                top &= top - 1
        # no merge of rank r makes a pair of rank r, as that would be a longer token
        bucket.sort()
        for place, p in enumerate(bucket):
            if at[p] != r:
                continue  # stale
            q = after[p]
            end = after[q]
            at[q] = -1
            after[p] = end
            lowest = r
            if end < limit[p]:
                before[end] = p
                new = at[p] = get(data[p : after[end]], -1)
                if new >= 0:
                    lowest = new
                    if new in buckets:
                        buckets[new].append(p)
                    else:
                        buckets[new] = [p]
                        w, g = new >> 6, new >> 12
                        words[w] = words.get(w, 0) | 1 << (new & 63)
                        groups[g] = groups.get(g, 0) | 1 << (w & 63)
                        top |= 1 << g
            else:
                at[p] = -1
            o = before[p]
            if o >= 0:
                new = at[o] = get(data[o:end], -1)
                if new >= 0:
                    lowest = min(lowest, new)
                    if new in buckets:
                        buckets[new].append(o)
                    else:
                        buckets[new] = [o]
                        w, g = new >> 6, new >> 12
                        words[w] = words.get(w, 0) | 1 << (new & 63)
                        groups[g] = groups.get(g, 0) | 1 << (w & 63)
                        top |= 1 << g
            if lowest < r and place + 1 < len(bucket):
                # a lower rank goes first; the rest of this one waits
                buckets[r] = bucket[place + 1 :]
                w, g = r >> 6, r >> 12
                words[w] = words.get(w, 0) | 1 << (r & 63)
                groups[g] = groups.get(g, 0) | 1 << (w & 63)
                top |= 1 << g
                break
    for i, size, end in zip(todo, sizes.tolist(), ends.tolist()):
        ids, p = [], end - size
        while p < end:
            q = after[p]
            ids.append(ranks[data[p:q]])
            p = q
        out[i] = ids
    return [ids or [] for ids in out]


class Codec:
    """Ids of known pre-tokens as decimal text, and the bytes that these ids stand for."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pairs = byte_pairs(self.ranks)
        self.words = regex.compile(pattern)
        self.bytes = {r: t for t, r in self.ranks.items()}
        self.memo: dict[str, tuple[str, bytes]] = {}

    def learn(self, words: list[str]) -> None:
        for word, ids in zip(words, merge_all([w.encode() for w in words], self.ranks, self.pairs)):
            self.memo[word] = " ".join(map(str, ids)), self.decode(ids)

    def encode_all(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """For each text the decimal ids joined by one space, and the ids decoded."""
        words = [self.words.findall(t) for t in texts]
        if len(self.memo) > MEMO:
            self.memo = {}
        new = set().union(*words).difference(self.memo)
        if new:
            self.learn(list(new))
        memo = self.memo
        for found in words:
            known = [memo[w] for w in found]
            yield " ".join([k[0] for k in known]), b"".join([k[1] for k in known])

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process."""
    return Codec(path, pattern)


def ids_of(joined: str) -> list[int]:
    return np.fromstring(joined, dtype=np.int64, sep=" ").tolist() if joined else []


def text_groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Texts in order, in groups of about ``GROUP_CHARS``."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(text or "")
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    yield group


def encode_documents(docs: DataFrame, path: str, pattern: str, keep: bool = True) -> DataFrame:
    """Encode each text and decode its ids again.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and with ``keep`` also
    ``ids array<int>`` and ``decoded binary``. A null text counts as empty: no ids, and
    the checksums of nothing. Rows are mapped one by one, so repeated and null ids and
    extra columns do not matter; only ``doc_id`` and ``text`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            out = []
            for group in text_groups(batch.column(1).to_pylist()):
                for joined, decoded in own.encode_all(group):
                    n = joined.count(" ") + 1 if joined else 0
                    row = (n, hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    out.append(row + ((ids_of(joined), decoded) if keep else ()))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.binary()]
            names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: 5 if keep else 3]
            columns = [pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return arrow_map(rows, run, schema + (", ids array<int>, decoded binary" if keep else ""))

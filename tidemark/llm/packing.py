"""Packing token sequences by best-fit decreasing.

Best-fit decreasing looks at lengths only. So the counts of each length (at most as many
as a window has tokens) are enough to plan where every piece goes; pieces of one length
are interchangeable. The plan is a list of runs "the next n pieces of this length go,
so many to a window, into these windows from this place on", its size does not grow
with the documents, and each piece finds its run by its number among its length.
"""

from __future__ import annotations

import math
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import re
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import text_groups
from tidemark.llm.common import arrow_map
from tidemark.plans.scratch import materialise

WINDOW = 2048
#: The id put after each document.
END_ID = 1
#: Pre-tokens whose ids a worker remembers before it starts anew.
MEMO = 600_000
#: New words that the library is given in one line.
LINE_WORDS = 200
#: Pieces of one length that one task numbers.
GROUP_ROWS = 50_000

#: Texts of these characters only are cut into words here, as the tokenizer does. They keep
#: their kind (letter, digit, other) in lower case; all other texts go to the tokenizer whole.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-žΑ-Ρα-ρ"
                   r"τ-ωА-я‐-‧‰-⁄€]*")  # fmt: skip
WORDS = re.compile(
    r"'[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD]|[^\W\d_]+|\d|(?:[^\w\s]|_)+"
)


class Encoder:
    """Ids by the tokenizers library, with the ids of known words remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [t for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.ends[[self.tokenizer.token_to_id(t) for t in ends]] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        lines = [" ".join(words[i : i + LINE_WORDS]) for i in range(0, len(words), LINE_WORDS)]
        # without offsets where the library can leave them out
        batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in batch(lines, add_special_tokens=False)])
        cuts = np.flatnonzero(self.ends[ids]) + 1  # a word's last token is marked as such
        if len(cuts) == len(words):
            octets, places = ids.tobytes(), (4 * cuts).tolist()
            self.memo.update(zip(words, [octets[a:b] for a, b in zip([0, *places], places)]))
        else:
            self.memo.update((w, self.whole(w)) for w in words)

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, four bytes each. The new words of all texts are learnt together."""
        words = [
            WORDS.findall(t.lower())  # as the tokenizer does, so that fewer words are new
            if PLAIN.fullmatch(t) and not any(s in t for s in self.special) and unicodedata.is_normalized("NFC", t)
            else None
            for t in texts
        ]
        if len(self.memo) > MEMO:
            self.memo = {}
        if new := list(set().union(*(w for w in words if w is not None)).difference(self.memo)):
            self.learn(new)
        known = self.memo.__getitem__
        for text, found in zip(texts, words):
            yield self.whole(text) if found is None else b"".join(map(known, found))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(next(self.encode_all([text])), dtype="<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_documents(docs: DataFrame, path: str, window: int = WINDOW, keep: bool = False) -> DataFrame:
    """Pieces of each document's ids: full windows, then the rest.

    ``doc_id, start, length, ids_crc32, doc_tokens`` and with ``keep`` ``ids array<int>``.
    """

    end, step = np.array([END_ID], dtype="<u4").tobytes(), 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            sizes, sums, kept = [], [], []
            for group in text_groups(batch.column(1).to_pylist()):
                for ids in own.encode_all(group):
                    ids += end
                    sizes.append(len(ids) // 4)
                    for at in range(0, len(ids), step):
                        sums.append(zlib.crc32(ids[at : at + step]))
                        if keep:
                            kept.append(np.frombuffer(ids[at : at + step], dtype="<i4"))
            # a row per piece: all are full windows but a document's last
            tokens = np.array(sizes, dtype=np.int64)
            pieces = -(-tokens // window)
            row = np.repeat(np.arange(len(tokens)), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            columns = [batch.column(0).take(pa.array(row)), start, np.minimum(window, tokens[row] - start),
                       np.array(sums, dtype=np.int64), tokens[row]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    rows = docs.selectExpr("cast(doc_id as long) as doc_id", "text")
    return arrow_map(rows, run, schema + (", ids array<int>" if keep else ""))


class Open:
    """Open windows by remaining capacity: a segment tree over the capacities, with ranges of ids."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.held = [False] * (2 * self.size)
        self.ranges: dict[int, list[tuple[int, int]]] = {}

    def put(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.ranges.setdefault(capacity, []).append((first, count))
            self._mark(capacity, True)

    def take(self, capacity: int) -> tuple[int, int]:
        ranges = self.ranges[capacity]
        out = ranges.pop()
        if not ranges:
            self._mark(capacity, False)
        return out

    def _mark(self, capacity: int, held: bool) -> None:
        i = capacity + self.size
        self.held[i] = held
        while i > 1:
            i >>= 1
            self.held[i] = self.held[2 * i] or self.held[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """Smallest capacity of at least ``least`` that an open window has."""
        i = least + self.size
        while not self.held[i]:
            while i & 1:  # go up past right children, then to the right neighbour
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.size:
            i = 2 * i if self.held[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first piece, pieces, first sequence, offset, pieces in a sequence)."""
    open_, runs, sequences = Open(window), [], 0
    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            capacity = open_.tightest(length)
            each = (capacity or window) // length
            if capacity is None:
                capacity, first, count = window, sequences, -(-left // each)
                sequences += count
            else:
                first, count = open_.take(capacity)
            full = min(count, left // each)
            for n, windows in ((full * each, full), (left % each if full < count and left < each * (full + 1) else 0, 1)):
                if n:
                    per = n // windows
                    runs.append((length, done, n, first, window - capacity, per))
                    open_.put(capacity - per * length, first, windows)
                    first, count, done, left = first + windows, count - windows, done + n, left - n
            open_.put(capacity, first, count)
    return runs


def pack(docs: DataFrame, path: str, window: int = WINDOW, keep: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most ``window`` tokens.

    Returns per piece ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` (and ``ids`` with ``keep``). A null text is an empty one and gives one piece
    with the end id. Each row is a document of its own, so repeated rows are packed as
    often as they occur; null ids stay null. Only ``doc_id`` and ``text`` are read.
    A sequence is padded to the window unless its length is a power of two. Empty input,
    empty result.
    """
    spark = docs.sparkSession
    cut = cut_documents(docs, path, window, keep)
    # the salt is fixed once written; it splits a length held by most pieces, and equal rows
    pieces = materialise(cut.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    runs = spark.createDataFrame(
        plan(counts, window), "length long, run_first long, run_pieces long, sequence long, place long, per long"
    )
    groups = max(1, math.ceil(sum(counts.values()) / GROUP_ROWS))
    dealt = pieces.withColumn("part", F.pmod("salt", F.lit(groups)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "part")
        .count()
        .select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "part").orderBy("salt", "doc_id", "start")
    numbered = dealt.withColumn("number", F.row_number().over(inside)).join(starts, ["length", "part"])
    number = F.col("base") + F.col("number") - 1 - F.col("run_first")
    # at most a few thousand runs for a window of 2048, whatever the number of documents
    placed = numbered.join(F.broadcast(runs), "length").filter((number >= 0) & (number < F.col("run_pieces")))
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("sequence") + F.floor(number / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + number % F.col("per") * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if keep else []),
    )

"""Exact substring dedup: a suffix sort by hash comparison, spread over Spark tasks.

Two suffixes are compared through prefix polynomial hashes: a binary search over hashes of
growing length finds their common extension in a logarithmic number of steps, and
the byte after it decides. A merge sort with this comparison puts suffixes with a common
prefix of ``length`` bytes side by side; adjacent ones are then verified byte by byte,
and in each run of equal ones all but the earliest are repeats.

Sorting all suffixes of a corpus against each other would move every byte many times. So the
windows (strings of ``length`` bytes) are first dealt out by what they contain: the gram
with the smallest hash in a window is its anchor. Equal windows have equal anchors at
equal offsets. Consecutive windows with one anchor form a segment, about one for every
``(length - gram) / 2`` bytes, and only segments are shuffled:

1. A segment whose anchor occurs once is done. Equal segments are counted, all but
   the first are repeats. Hot passages are cut down to one row per batch before the shuffle.
2. What is left are distinct segments with a common anchor: where repeated passages begin,
   end or differ. Their bytes are fetched and their suffixes sorted, by anchor and offset.
3. An anchor with more than ``GROUP`` distinct segments is sorted in parts, and
   the earliest windows of the parts meet in one more aggregation by window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, stored, text_bytes
from tidemark.llm.hashing import BASES, Hashes, batches_of, mixed
from tidemark.plans.order import number_rows

LENGTH = 100
#: Bytes of an anchor gram; smaller ones are frequent phrases, larger ones give more anchors.
GRAM = 24
#: Distinct segments of one anchor that one task sorts.
GROUP = 20_000
#: Segments sorted at once.
SORT = 6_000


def segments(text: np.ndarray, lengths: np.ndarray, length: int, gram: int):
    """Segments of concatenated texts: anchor hash, text number, first and last window, anchor's place in it."""
    n = len(text)
    if n < length:
        return [np.zeros(0, dtype=np.uint64)] + [np.zeros(0, dtype=np.int64)] * 4
    hashes = mixed(Hashes(text, BASES[0]).every(gram))
    shift = np.uint64(int(len(hashes)).bit_length())
    place = np.arange(len(hashes), dtype=np.uint64)
    low = (hashes >> shift << shift) | place  # of equal hashes the leftmost
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if width > size:
        low = np.minimum(low[: -(width - size)], low[width - size :])
    anchor = (low & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    whole = owner[: n - length + 1] == owner[length - 1 :]
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~whole[:-1] | (owner[1 : len(anchor)] != owner[: len(anchor) - 1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    keep = whole[first]
    first, last = first[keep], last[keep]
    # a run may end in windows that cross into the next text
    broken = ~whole[last]
    if broken.any():
        ends = np.cumsum(lengths)
        last[broken] = ends[owner[first[broken]]] - length
    return hashes[anchor[first]], owner[first].astype(np.int64), first, last, anchor[first] - first


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Touching intervals of each document joined."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # running maximum of the ends, made to fall behind at each new document
    far = int(end.max()) + 1
    rank = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    reach = np.maximum.accumulate(end + rank * far) - rank * far
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


def _anchored(length: int, gram: int):
    """Map to ``a, c, d, s, n, o``: a batch's distinct segments; for its repeats a and c are null and n counts bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts = text_bytes(batch.column(1))
            ids = batch.column(0).to_numpy()
            found = []
            for lo, hi in batches_of(texts):
                joined = b"".join(texts[lo:hi])
                sizes = np.array([len(t) for t in texts[lo:hi]])
                a, owner, first, last, o = segments(np.frombuffer(joined, np.uint8), sizes, length, gram)
                whole = memoryview(joined)
                spans = zip(first.tolist(), (last + length).tolist())
                c = np.array([digest(whole[s:e]) for s, e in spans], dtype=np.uint64)
                begin = np.cumsum(sizes) - sizes
                found.append((a, c, ids[lo + owner], first - begin[owner], last - first + 1, o))
            if not found:
                continue
            a, c, d, s, n, o = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((s, d, c, a))
            a, c, d, s, n, o = (x[order] for x in (a, c, d, s, n, o))
            again = np.zeros(len(a), dtype=bool)
            again[1:] = (a[1:] == a[:-1]) & (c[1:] == c[:-1])
            doc, start, end = merged(d[again], s[again], s[again] + n[again] + length - 1)
            once, none = ~again, len(doc)
            columns = [
                pa.concat_arrays([pa.array(x[once].view(np.int64)), pa.nulls(none, pa.int64())]) for x in (a, c)
            ]
            columns += [pa.array(np.concatenate(x)) for x in ((d[once], doc), (s[once], start), (n[once], end - start), (o[once], doc * 0))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "c", "d", "s", "n", "o"])

    return run


class Suffixes:
    """Suffixes of a text, compared on their first ``length`` bytes."""

    def __init__(self, text: bytes, length: int, base: int):
        padded = np.frombuffer(text + bytes(8), np.uint8)
        self.length, self.text = length, padded
        self.hashes = Hashes(padded[:-8], base)
        self.words = np.zeros(len(text) + 1, dtype=np.uint64)
        for i in range(8):
            self.words |= padded[i : i + len(text) + 1].astype(np.uint64) << np.uint64(56 - 8 * i)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common extension, by binary search over hashes of prefixes."""
        least, most = np.zeros(len(x), dtype=np.int64), np.full(len(x), self.length, dtype=np.int64)
        for _ in range(self.length.bit_length()):
            middle = (least + most + 1) >> 1
            same = self.hashes.of(x, middle) == self.hashes.of(y, middle)
            least = np.where(same, middle, least)
            most = np.where(same, most, np.maximum(middle - 1, least))
        return least

    def below(self, x: np.ndarray, y: np.ndarray, equal: bool) -> np.ndarray:
        """Whether suffix x sorts before y; equal ones give ``equal``."""
        a, b = self.words[x], self.words[y]
        out = a < b
        tie = np.flatnonzero(a == b)
        if len(tie):
            x, y = x[tie], y[tie]
            shared = self.common(x, y)
            full = shared >= self.length
            at = np.minimum(shared, self.length - 1)
            out[tie] = np.where(full, equal, self.text[x + at] < self.text[y + at])
        return out

    def same(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Byte by byte, eight at a time."""
        out = np.ones(len(x), dtype=bool)
        for at in [*range(0, self.length - 8, 8), max(0, self.length - 8)]:
            out &= self.words[x + at] == self.words[y + at]
        return out


def merge_sort(suffixes: Suffixes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Stable order of suffixes ``at`` within each group; groups are contiguous and stay in place.

    Bottom-up: all runs of a level are merged at once. An element's place after the
    merge is its place in its own run plus the elements of the other run before it,
    which a binary search with suffix comparisons counts.
    """
    n = len(at)
    order = np.arange(n)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(cuts, n))
    base, total = np.repeat(cuts, sizes), np.repeat(sizes, sizes)
    run = 1
    while n and run < sizes.max():
        live = np.flatnonzero(total > run)
        inside = live - base[live]
        number = inside // run
        odd = (number & 1).astype(bool)
        other = base[live] + np.where(odd, number - 1, number + 1) * run
        least = np.minimum(other, base[live] + total[live])
        most = np.minimum(other + run, base[live] + total[live])
        start, mine = least.copy(), order[live]
        open_ = np.flatnonzero(least < most)
        while len(open_):
            middle = (least[open_] + most[open_]) >> 1
            theirs, own = at[order[middle]], at[mine[open_]]
            ahead = np.empty(len(open_), dtype=bool)
            # an earlier run's equal elements stay ahead of a later run's
            for flag in (True, False):
                part = odd[open_] == flag
                ahead[part] = suffixes.below(theirs[part], own[part], equal=flag)
            least[open_] = np.where(ahead, middle + 1, least[open_])
            most[open_] = np.where(ahead, most[open_], middle)
            open_ = open_[least[open_] < most[open_]]
        pair = base[live] + (number - odd) * run
        moved = order.copy()
        moved[pair + inside - number * run + (least - start)] = mine
        order = moved
        run *= 2
    return order


def repeats(texts: list[bytes], group: np.ndarray, offset: np.ndarray, length: int):
    """Windows of segments and which repeat an earlier one of their group.

    Segments are in the order of precedence; ``offset`` is where the anchor stands in each.
    Returns (segment, window in it, repeated) for all windows, in their order.
    """
    count = np.array([len(t) - length + 1 for t in texts])
    segment = np.repeat(np.arange(len(texts)), count)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    begin = np.cumsum([0] + [len(t) for t in texts])[:-1]
    at = begin[segment] + window
    # equal windows have their anchor at one offset
    by = np.lexsort((segment, offset[segment] - window, group[segment]))
    key_group, key_offset = group[segment][by], (offset[segment] - window)[by]
    both = np.cumsum(np.concatenate(([0], (key_group[1:] != key_group[:-1]) | (key_offset[1:] != key_offset[:-1]))))
    joined = b"".join(texts)
    for base in BASES:  # another one if a collision shows
        suffixes = Suffixes(joined, length, base)
        order = by[merge_sort(suffixes, at[by], both)]
        x, y = at[order[:-1]], at[order[1:]]
        equal = (both[:-1] == both[1:]) & (suffixes.hashes.of(x, length) == suffixes.hashes.of(y, length))
        if suffixes.same(x[equal], y[equal]).all():
            break
    else:
        raise RuntimeError("every base of the polynomial hash met a collision")
    out = np.zeros(len(at), dtype=bool)
    out[order[1:][equal]] = True
    return segment, window, out


def _sorted_groups(length: int):
    """Map rows ``a, part, parts, d, s, o, bytes`` sorted by (a, part, d, s) to repeats, and
    for anchors in several parts to their first windows (w1, w2)."""

    def sort(rows: list) -> Iterator[pa.RecordBatch]:
        a, part, parts, d, s, o, texts = (
            [x for r in rows for x in r[i]] if i == 6 else np.concatenate([r[i] for r in rows]) for i in range(7)
        )
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (part[1:] != part[:-1])))
        group = np.cumsum(new)
        cuts = np.append(np.flatnonzero(new), len(a))
        lo = 0
        while lo < len(cuts) - 1:
            hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + SORT, "right")) - 1)
            span = slice(cuts[lo], cuts[hi])
            own = texts[span]
            segment, window, again = repeats(own, group[span], o[span], length)
            doc, place = d[span][segment], s[span][segment] + window
            x, y, z = merged(doc[again], place[again], place[again] + length)
            first = np.flatnonzero(~again & (parts[span][segment] > 1))
            whole = [own[i][w : w + length] for i, w in zip(segment[first].tolist(), window[first].tolist())]
            w1, w2 = ([xxhash.xxh3_64_intdigest(t, seed) for t in whole] for seed in (0, 1))
            k = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((x, doc[first]))),
                    pa.array(np.concatenate((y, place[first]))),
                    pa.array(np.concatenate((z - y, np.full(len(first), length)))),
                    *[pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(np.array(w, dtype=np.uint64).view(np.int64))])
                      for w in (w1, w2)],
                ],
                names=["d", "s", "n", "w1", "w2"],
            )
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            row = [batch.column(i).to_numpy() for i in range(6)] + [batch.column(6).to_pylist()]
            waiting.append(row)
            a, part = row[0], row[1]
            new = np.flatnonzero((a != a[-1]) | (part != part[-1]))
            if len(new):
                end = new[-1] + 1
            elif len(waiting) > 1 and (waiting[-2][0][-1] != a[0] or waiting[-2][1][-1] != part[0]):
                end = 0
            else:
                continue  # still inside one group
            waiting[-1] = [x[:end] for x in row]
            yield from sort(waiting) if end or len(waiting) > 1 else ()
            waiting = [[x[end:] for x in row]]
        if waiting:
            yield from sort(waiting)

    return run


def _contents(length: int):
    """Map documents with their wanted segments to the bytes of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, text, wanted in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                rows += [(w["a"], w["part"], w["parts"], d, w["s"], w["o"], text[w["s"] : w["s"] + w["n"] + length - 1]) for w in wanted]
            for lo in range(0, len(rows), 20_000):
                some = rows[lo : lo + 20_000]
                columns = [pa.array([r[i] for r in some], pa.int64()) for i in range(6)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([r[6] for r in some], pa.binary())],
                    names=["a", "part", "parts", "d", "s", "o", "bytes"],
                )

    return run


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """Repeated stretches ``d, s, n`` of documents (``d`` unique, ``text``); they may overlap."""
    seg = stored(arrow_map(docs.select("d", "text"), _anchored(length, gram), "a long, c long, d long, s long, n long, o long"), "segments")
    local = seg.filter("a is null").select("d", "s", "n")
    seg = seg.filter("a is not null")
    shared = stored(
        seg.groupBy("a")
        .agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("d").alias("d0"), F.max("d").alias("d1"))
        .filter("c0 <> c1 or d0 <> d1")
        .select("a", (F.col("c0") != F.col("c1")).alias("unlike"), "d0"),
        "shared-anchors",
    )
    met = stored(seg.join(shared, "a").filter("unlike or d > d0").drop("d0"), "shared-segments")
    alike = met.filter("not unlike").select("d", "s", (F.col("n") + (length - 1)).alias("n"))
    unlike = met.filter("unlike").drop("unlike")
    firsts = stored(unlike.groupBy("a", "c").agg(F.min("d").alias("d1")), "first-segments")
    held = firsts.groupBy("a").agg(F.count(F.lit(1)).alias("held"))
    judged = stored(unlike.join(firsts, ["a", "c"]).join(held, "a"), "unlike-segments")
    copies = judged.filter("d > d1").select("d", "s", (F.col("n") + (length - 1)).alias("n"))
    parts = F.ceil(F.col("held") / group).cast("long")
    wanted = judged.filter("d = d1").select(
        "d", F.struct("a", F.pmod("c", parts).alias("part"), parts.alias("parts"), "s", "n", "o").alias("w")
    )
    # a document's list is bounded by its own length
    asked = docs.select("d", "text").join(wanted.groupBy("d").agg(F.collect_list("w").alias("wanted")), "d")
    rows = arrow_map(asked, _contents(length), "a long, part long, parts long, d long, s long, o long, bytes binary")
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", "d", "s")
    sorted_ = stored(arrow_map(dealt, _sorted_groups(length), "d long, s long, n long, w1 long, w2 long"), "sorted-suffixes")
    found = sorted_.filter("w1 is null").select("d", "s", "n")
    split = sorted_.filter("w1 is not null")
    earliest = split.groupBy("w1", "w2").agg(F.min(F.struct("d", "s")).alias("first"))
    late = split.join(earliest, ["w1", "w2"]).filter(F.struct("d", "s") > F.col("first")).select("d", "s", "n")
    return local.unionByName(alike).unionByName(copies).unionByName(found).unionByName(late)


def ordered(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique ``d`` that states precedence: the id, or if ids are null or
    repeated the place by id (nulls first) and text."""
    twice = docs.groupBy("doc_id").count().filter("doc_id is null or count > 1").limit(1).count()
    if not twice:
        return docs.withColumn("d", F.col("doc_id").cast("long"))
    return number_rows(stored(docs, "to-number"), [F.col("doc_id").asc_nulls_first(), "text"], "d")


def _cut(keep: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                kept, removed, runs, at = [], 0, 0, 0
                edge = -1
                for span in sorted((f["s"], f["s"] + f["n"]) for f in found or ()):
                    start, end = span
                    if start > edge:
                        runs += 1
                        kept.append(text[at:start])
                    start = max(start, edge)
                    removed += max(0, end - start)
                    edge = at = max(edge, end)
                kept.append(text[at:])
                left = b"".join(kept)
                rows.append((len(text), removed, runs, hashlib.sha256(left).hexdigest()) + ((left, left.decode("utf-8", "ignore")) if keep else ()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
            out = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text"][: 6 if keep else 4]
            columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(out))]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *columns], names=[*names, *out])

    return run


def dedup(docs: DataFrame, length: int = LENGTH, keep: bool = True, columns: list[str] = ["doc_id"], **sizes) -> DataFrame:
    """Remove each byte covered by a string of ``length`` bytes that also starts earlier.

    Earlier is a smaller ``doc_id``, or the same document at an earlier start. Returns
    ``columns``, ``n_bytes, n_removed, n_spans, kept_sha256`` and with ``keep`` the
    remaining bytes as ``kept`` and, without characters cut in two, as ``kept_text``. A null text is empty. If ids are null or repeated, rows
    count in the order of id (nulls first) and text, each as a document of its own, so
    the later of two equal rows is removed. Texts shorter than ``length`` stay whole.
    Only ``text``, ``doc_id`` and ``columns`` are read. Empty input, empty result.
    """
    base = ordered(docs.select("text", *dict.fromkeys(["doc_id", *columns])))
    found = spans(base, length, **sizes)
    held = found.groupBy("d").agg(F.collect_list(F.struct("s", "n")).alias("found"))
    joined = base.join(held, "d", "left").select("text", "found", *columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[2:])
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary, kept_text string" if keep else "")
    return arrow_map(joined, _cut(keep, columns), schema)

"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on each text. Expectation-maximisation
estimates how often each of them is right, without any true label, from the counts of vote
patterns over all documents. The posterior of a pattern is a soft label, and a linear
scorer on hashed character-class grams is trained on a bounded sample of so labelled
texts. The scorer then judges every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, text_bytes
from tidemark.llm.hashing import Hashes, batches_of

#: Labelled texts that the scorer is trained on, at most.
SAMPLE = 6_000
#: Buckets of the hashed features.
BUCKETS = 4_096
#: A text is kept if its score (probability of good quality) is at least this. Below one
#: half, as short texts give the scorer little to go by and clean ones shall stay.
KEEP = 0.3

SPACE, LINE, LOWER, UPPER, DIGIT, HIGH, STOP, COMMA, SHOUT, ASK, COLON, QUOTE, DASH, PIPE, SYMBOL, OTHER = range(16)


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, dtype=np.uint8)
    for chars, kind in (
        (b" \t\r\x0b\x0c", SPACE), (b"\n", LINE), (b".", STOP), (b",", COMMA), (b"!", SHOUT), (b"?", ASK),
        (b";:", COLON), (b"'\"()", QUOTE), (b"-/", DASH), (b"|", PIPE), (b"#$%&*^~<>{}[]\\=+@_`", SYMBOL),
    ):
        table[np.frombuffer(chars, np.uint8)] = kind
    table[97:123], table[65:91], table[48:58], table[128:] = LOWER, UPPER, DIGIT, HIGH
    return table


CLASSES = _classes()
#: What is measured in a text, all as shares of its words.
MEASURES = ["odd", "shouted", "repeated", "wordless", "ordinary", "cut", "symbols"]
#: Labellers: name, measure, bad from, good up to (a text in between: no vote). If bad is
#: below good, low values are bad.
LABELLERS = [
    ("odd words", "odd", 0.25, 0.08),
    ("capitals", "shouted", 0.25, 0.10),
    ("repeats", "repeated", 0.25, 0.10),
    ("no letters", "wordless", 0.15, 0.05),
    ("ordinary words", "ordinary", 0.70, 0.88),
    ("symbol count", "symbols", 0.20, 0.08),
    ("plain and varied", "cut", 0.35, 0.16),
]


def measures(texts: list[bytes]) -> np.ndarray:
    """One row of ``MEASURES`` for each text and, last, its number of words."""
    out = np.zeros((len(texts), len(MEASURES) + 1))
    for lo, hi in batches_of(texts):
        joined = np.frombuffer(b"\n".join(texts[lo:hi]) + b"\n", np.uint8)
        kind = CLASSES[joined]
        blank = kind <= LINE
        edge = np.diff(blank.astype(np.int8), prepend=1)
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts[lo:hi]]), begin, "right")

        def count(*kinds: int) -> np.ndarray:
            hits = np.zeros(len(kind) + 1, dtype=np.int64)
            np.cumsum(np.isin(kind, kinds), out=hits[1:])
            return hits[end] - hits[begin]

        letters, capitals, size = count(LOWER, UPPER, HIGH), count(UPPER), end - begin
        marks, odd = count(SHOUT, PIPE, SYMBOL), count(PIPE, SYMBOL)
        word = Hashes(joined).of(begin, size)
        again = np.zeros(len(word), dtype=bool)
        again[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
        shouted = (capitals >= 2) & (capitals > (letters - capitals) * 0.5)
        plain = (letters > 0) & (odd == 0) & (marks <= 1) & (letters >= size - 2) & ~shouted
        flags = [odd > 0, shouted, again, letters == 0, plain, ~plain | again, marks >= 2]
        n = np.bincount(owner, minlength=hi - lo)
        for i, flag in enumerate(flags):
            out[lo:hi, i] = np.bincount(owner, flag, minlength=hi - lo) / np.maximum(n, 1)
        out[lo:hi, -1] = n
    return out


def votes(found: np.ndarray) -> np.ndarray:
    """1 good, 0 bad, -1 no vote, for each text and labeller; a text without words gets no votes."""
    out = np.full((len(found), len(LABELLERS)), -1, dtype=np.int8)
    for j, (_, name, bad, good) in enumerate(LABELLERS):
        x = found[:, MEASURES.index(name)]
        low = bad < good
        out[(x <= bad) if low else (x >= bad), j] = 0
        out[(x >= good) if low else (x <= good), j] = 1
    out[found[:, -1] == 0] = -1
    return out


def pattern_of(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) + 1) @ (3 ** np.arange(v.shape[1]))


@dataclass
class Labels:
    """Accuracies: probability of a good vote, by labeller, for good and for bad texts."""

    prior: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """Probability of good quality given votes."""

        def log(p: np.ndarray) -> np.ndarray:
            return np.where(v == 1, np.log(p), np.where(v == 0, np.log(1 - p), 0)).sum(axis=1)

        odds = np.log(self.prior / (1 - self.prior)) + log(self.good) - log(self.bad)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def estimate(v: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Labels:
    """Expectation-maximisation over vote patterns and how many texts have each."""
    # the start says what is known of such heuristics: they seldom fire on good texts, and on
    # a bad text most of them see nothing
    labels = Labels(0.85, np.full(v.shape[1], 0.99), np.full(v.shape[1], 0.60))
    for _ in range(rounds):
        p = labels.posterior(v)
        for weight, rate in ((p * counts, labels.good), (((1 - p) * counts), labels.bad)):
            yes, no = weight @ (v == 1), weight @ (v == 0)
            rate[:] = np.clip((yes + 1) / (yes + no + 2), 1e-3, 1 - 1e-3)
        labels.prior = float(np.clip(p @ counts / max(1, counts.sum()), 0.02, 0.98))
    return labels


def features(texts: list[bytes], found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and values of each text: shares of its character-class grams, and its repeats."""
    for text, row in zip(texts, found):
        kind = CLASSES[np.frombuffer(b" " + text + b" ", np.uint8)].astype(np.uint32)
        kind = kind[np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] > HIGH)))]  # runs of letters count once
        code = kind[:-2] << 8 | kind[1:-1] << 4 | kind[2:] if len(kind) > 2 else kind[:0]
        bucket, count = np.unique(hashed(code), return_counts=True)
        share = count / max(1, len(code))
        extra = hashed(np.array([1 << 16], dtype=np.uint32))
        yield np.append(bucket, extra), np.append(share, row[MEASURES.index("repeated")])


def hashed(code: np.ndarray) -> np.ndarray:
    return ((code.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights and, last, bias of a logistic scorer, by full-batch gradient steps with momentum."""
    x = np.zeros((len(rows), BUCKETS + 1), dtype=np.float32)
    x[:, -1] = 1
    for i, (bucket, value) in enumerate(rows):
        np.add.at(x[i], bucket, value.astype(np.float32))
    used = np.flatnonzero(x.any(axis=0))
    x = x[:, used]
    w, first, second = (np.zeros(len(used)) for _ in range(3))
    # both kinds weigh the same, whatever their shares
    weight = np.where(target >= 0.5, 0.5 / max(1, (target >= 0.5).sum()), 0.5 / max(1, (target < 0.5).sum()))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ ((p - target) * weight) + 1e-5 * w
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        w -= 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(BUCKETS + 1)
    out[used] = w
    return out


@dataclass
class Model:
    labels: Labels
    weights: np.ndarray


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Estimate the labellers on all of ``docs`` and train the scorer on at most ``sample`` texts."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            codes, counts = np.unique(pattern_of(votes(measures(text_bytes(batch.column(0))))), return_counts=True)
            for c, n in zip(codes.tolist(), counts.tolist()):
                total[c] = total.get(c, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pattern", "n"])

    # at most 3 to the number of labellers patterns
    found = (
        arrow_map(docs.select("text"), patterns, "pattern long, n long")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"))
        .orderBy("pattern")
        .collect()
    )
    codes = np.array([r[0] for r in found], dtype=np.int64)
    v = (codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)
    counts = np.array([r[1] for r in found], dtype=float)
    labels = estimate(v, counts)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            seen = measures(texts)
            rows = list(features(texts, seen))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(labels.posterior(votes(seen))),
                    pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                ],
                names=["p", "bucket", "share"],
            )

    share = min(1.0, sample / max(1.0, counts.sum()))
    order = F.xxhash64("text", F.lit("sample"))
    # chosen by a hash of the text, so equal texts are in or out together; at most ``sample`` are drawn
    picked = docs.select("text").filter(F.length("text") > 0).withColumn("o", order)
    picked = picked.filter(F.pmod("o", F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).dropDuplicates(["o"])
    picked = picked.orderBy("o").limit(sample).select("text")
    rows = arrow_map(picked, sampled, "p double, bucket array<long>, share array<double>").collect()
    rows = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    if not rows:
        return Model(labels, np.zeros(BUCKETS + 1))
    pairs = [(np.array(r[1]), np.array(r[2])) for r in rows]
    return Model(labels, train(pairs, np.array([r[0] for r in rows])))


#: names that the operator gives its results
RESULTS = ("quality_score", "quality_posterior", "kept")


def score(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """``columns``, ``quality_score``, ``quality_posterior`` for every row of ``docs``.

    A column named like one of ``RESULTS`` comes back as ``input_<name>``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(0))
            seen = measures(texts)
            odds = np.array([model.weights[b] @ s for b, s in features(texts, seen)]) + model.weights[-1]
            p = np.where(seen[:, -1] > 0, 1 / (1 + np.exp(-np.clip(odds, -30, 30))), 0.0)
            posterior = np.where(seen[:, -1] > 0, model.labels.posterior(votes(seen)), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(np.round(p, 6)), pa.array(np.round(posterior, 6))],
                names=[*names, "quality_score", "quality_posterior"],
            )

    names = [f"input_{c}" if c in RESULTS else c for c in columns]
    rows = docs.select(F.col("text").alias("_judged"), *[F.col(c).alias(n) for c, n in zip(columns, names)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return arrow_map(rows, run, f"{schema}, quality_score double, quality_posterior double")


def classify(docs: DataFrame, columns: list[str] = ["doc_id"], keep: float = KEEP, sample: int = SAMPLE) -> DataFrame:
    """Judge every text: ``columns``, ``quality_score``, ``quality_posterior``, ``kept``.

    The score is the trained scorer's probability of good quality, the posterior is that
    of the votes alone. A null text or one without words has score 0 and is not kept.
    Rows are judged one by one, equal texts alike; ids may be null or repeat. Columns
    other than ``text`` and ``columns`` are not read; one of ``columns`` that is named like a
    result comes back as ``input_<name>``. Empty input, empty result.
    """
    model = fit(docs, sample)
    return score(docs, model, columns).withColumn("kept", F.col("quality_score") >= keep)

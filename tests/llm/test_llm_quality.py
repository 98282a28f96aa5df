import random

import numpy as np
from conftest import SMALL
from llm_cases import documents, empty, texts, words
from pyspark.sql import functions as F

from tidemark.llm import quality


def test_held_out_accuracy_without_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.classify(docs).join(labels, "doc_id").select("kept", "quality").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) / len(good) >= 0.98 and sum(bad) / len(bad) <= 0.05


def test_estimation_finds_accuracies():
    rng = np.random.default_rng(1)
    n = 40_000
    truth = rng.random(n) < 0.8
    good, bad = np.array([0.97, 0.9, 0.95, 0.99]), np.array([0.3, 0.4, 0.2, 0.6])
    v = np.where(rng.random((n, 4)) < np.where(truth[:, None], good, bad), 1, 0).astype(np.int8)
    v[rng.random((n, 4)) < 0.1] = -1
    labels = quality.estimate(v, np.ones(n))
    assert abs(labels.prior - 0.8) < 0.03
    assert np.abs(labels.good - good).max() < 0.03 and np.abs(labels.bad - bad).max() < 0.06


def test_measures_equal_plain_counts():
    rng = random.Random(3)
    rows = [t.encode() for t in texts() if t] + [b"THE CAT!! SAT", b"a a a b", b"x | y | z", b"we### are$$$ odd"]
    got = quality.measures(rows)
    for row, text in zip(got, rows):
        ws = text.split()
        assert row[-1] == len(ws)
        if ws:
            again = sum(a == b for a, b in zip(ws, ws[1:])) / len(ws)
            assert abs(row[quality.MEASURES.index("repeated")] - again) < 1e-12
    assert quality.measures([]).shape == (0, len(quality.MEASURES) + 1)
    assert rng


def test_awkward_rows(spark):
    rng = random.Random(5)
    rows = texts() + [words(rng, 60).title() + "." for _ in range(40)]
    df = documents(spark, rows, [i // 2 if i % 9 else None for i in range(len(rows))])
    clashing = df.withColumns({"quality_score": F.lit("own"), "quality_posterior": F.lit(7)})
    got = quality.classify(clashing, ["doc_id", "text", "kept", "quality_score", "quality_posterior"]).collect()
    assert {(r.input_kept, r.input_quality_score, r.input_quality_posterior) for r in got} == {("other", "own", 7)}
    assert len(got) == len(rows)
    blank = [r for r in got if not (r.text or "").strip()]
    assert blank and all(r.quality_score == 0 and not r.kept for r in blank)
    by_text = {}
    for r in got:
        by_text.setdefault(r.text, set()).add((r.quality_score, r.kept))
    assert all(len(s) == 1 for s in by_text.values())
    assert quality.classify(empty(spark)).count() == 0
    assert SMALL

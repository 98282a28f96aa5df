import random
import re

import corpus_pipeline
from conftest import SMALL
from llm_cases import documents, empty, texts, words
from test_llm_dedup import plain_dedup, reference_components, reference_fingerprint
from test_llm_tokens import WORDS, check_packing
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tidemark.llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered(spark):
    names = [n.split("_")[0] for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in entry.queries() and len(corpus_pipeline.STAGES) == 4


def plain_stages(rows, kept):
    """What the stages must leave of (id, text) rows, one after the other."""
    rows = [r for r in rows if r[1] in kept]
    fps = [reference_fingerprint(t) for _, t in rows]
    roots = reference_components(fps)
    first = {}
    for root, row in zip(roots, rows):
        first[root] = min(first.get(root, row), row)
    rows = sorted(first.values())
    cut = plain_dedup([t for _, t in rows])
    return rows, cut


def test_stages_equal_brute_force(spark):
    rng = random.Random(8)
    rows = texts(5) + ["### $$$ " + words(rng, 5).upper() + "!! |" for _ in range(5)]
    data = list(enumerate(rows))
    docs = documents(spark, rows, clash=True)
    kept = {r.text for r in quality.classify(docs, columns=["doc_id", "text"]).filter("kept").collect()}
    judged = corpus_pipeline.keep_quality(spark, docs, "")
    assert judged.columns == docs.columns
    assert {r.doc_id for r in judged.collect()} == {i for i, t in data if t in kept}
    want, cut = plain_stages(data, kept)
    near = corpus_pipeline.drop_near_duplicates(spark, judged, "")
    assert near.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in near.collect()) == want
    less = corpus_pipeline.drop_repeated_passages(spark, near, "")
    assert less.columns == docs.columns
    got = {r.doc_id: r for r in less.collect()}
    assert set(got) == {i for i, _ in want}
    for (i, _), (n, gone, _, _) in zip(want, cut):
        assert len(got[i].text.encode()) == n - gone and got[i].n_chars == len(got[i].text)
        assert got[i].source == "src0" and got[i].shard == "other"
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for i, r in got.items()}
    packed = corpus_pipeline.pack_sequences(spark, less, "").collect()
    check_packing(packed, ids, 2048)
    assert {r.doc_id for r in packed} == set(ids)


def test_near_duplicate_stage_with_equal_rows_and_null_ids(spark):
    text = words(random.Random(1), 40)
    rows, ids = [text, text, text + " ", "other words that are not alike"] * 2, [None, 3, 3, None] * 2
    docs = documents(spark, rows, ids)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or -1, r.text.strip()) for r in out) == [(-1, rows[3]), (3, text)]


def test_empty_table_passes_all_stages(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == COLUMNS and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.count() > 100

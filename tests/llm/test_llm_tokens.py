import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import documents, empty, texts
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "don'T It'S ſ ²x Ⅷ\x1c a b <|endoftext|> é '’s __a_b 12a\u200bx ΣΑΣ İstanbul", "\n\n  \t a  b", "x" * 3000,
    "日本語テキスト 123 %%%***", "e\u0301 combining", "ab" * 3000, "A'll 'LL'd  we'Ve",
]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, library):
    rows = texts() + ODD
    got = {r.doc_id: r for r in bpe.encode_documents(documents(spark, rows), RANKS, public_tokenizers.PATTERN).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        ids = library.encode_ordinary(text or "")
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert bytes(got[i].decoded) == (text or "").encode()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_long_pretokens(library):
    rng = random.Random(3)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for alphabet in ("a", "ab", "etaoin"):
        word = "".join(rng.choice(alphabet) for _ in range(20_000))
        assert bpe.merge(word.encode(), codec.ranks) == library.encode_ordinary(word)


def test_bpe_of_many_pretokens_at_once(library, monkeypatch):
    rng = random.Random(5)
    codec = bpe.Codec(RANKS, public_tokenizers.PATTERN)
    words = ["".join(rng.choice("aeinorst hélß日") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    got = bpe.merge_all([w.encode() for w in words], codec.ranks, codec.pairs)
    assert got == [library._encode_single_piece(w.encode()) if w else [] for w in words]
    assert bpe.merge_all([], codec.ranks, codec.pairs) == [] and bpe.merge_all([b"", b"a"], codec.ranks, codec.pairs)[0] == []
    # a merge may make a pair of lower rank, which then goes first
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 500, b"abc": 300, b"bcd": 600, b"abcd": 310}
    assert bpe.merge_all([b"abcd", b"xbcbcabc"], ranks, bpe.byte_pairs(ranks)) == [[310], [120, 500, 500, 300]]
    monkeypatch.setattr(bpe, "GROUP_CHARS", 10)
    assert [g for g in bpe.text_groups(["a" * 9, None, "b", "c" * 30, "d"])] == [["a" * 9, "", "b"], ["c" * 30], ["d"]]


def test_bpe_repeated_null_ids_and_nothing(spark):
    got = bpe.encode_documents(documents(spark, ["a", "a", None], [None, 3, 3]), RANKS, public_tokenizers.PATTERN)
    assert sorted(r.n_tokens for r in got.collect()) == [0, 1, 1]
    assert bpe.encode_documents(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def check_packing(got, ids_of, window):
    """Every id lies in one piece; sequences are gapless and within the window."""
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    for doc, rows in pieces.items():
        ids, at = np.array(ids_of[doc], dtype="<u4"), 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences)


def test_packing(spark):
    rows = texts() + ODD
    tokenizer = Tokenizer.from_file(WORDS)
    want = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(rows)}
    got = packing.pack(documents(spark, rows), WORDS).collect()
    n = check_packing(got, want, 2048)
    assert {r.doc_id for r in got} == set(want)
    assert n <= sum(map(len, want.values())) / 2048 * 1.05 + 1
    small = packing.pack(documents(spark, rows), WORDS, window=100, keep=True).collect()
    check_packing(small, want, 100)
    assert all(list(r.ids) == want[r.doc_id][r.start : r.start + r.length] for r in small)


def test_packing_counts_repeated_rows_and_takes_nothing(spark):
    got = packing.pack(documents(spark, ["a b"] * 5 + [None], [1, 1, 1, None, None, 2]), WORDS).collect()
    assert len(got) == 6 and sorted(r.offset for r in got) == [0, 3, 6, 9, 12, 15]
    assert packing.pack(empty(spark), WORDS).count() == 0


def best_fit(lengths, window):
    """Plain best-fit decreasing, one piece after the other."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [c for c in left if c >= n]
        if fits:
            left.remove(min(fits))
            left.append(min(fits) - n)
        else:
            left.append(window - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 50, 64])
    counts = {rng.randint(1, window): rng.randint(1, 30) for _ in range(12)}
    used, seen = {}, {}
    for length, first, pieces, sequence, place, per in packing.plan(counts, window):
        for j in range(pieces):
            s = sequence + j // per
            assert used.get(s, 0) == place + j % per * length
            used[s] = used.get(s, 0) + length
            seen.setdefault(length, []).append(first + j)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert sorted(window - u for u in used.values()) == best_fit([k for k, n in counts.items() for _ in range(n)], window)


def test_encoder_equals_tokenizers():
    own, library = packing.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for text in [t for t in texts(7) + ODD if t]:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids

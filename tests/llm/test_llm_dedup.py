import hashlib
import random

import numpy as np
import pytest
import xxhash
from llm_cases import documents, empty, texts, words

from tidemark.llm import simhash, suffix_dedup
from tidemark.llm.common import components


def plain_dedup(rows, length=100):
    seen, out = set(), []
    for text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            else:
                seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def collected(df):
    return {r[0]: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


@pytest.mark.parametrize("group", [20_000, 4])
def test_suffix_dedup_equals_brute_force(spark, group):
    rng = random.Random(2)
    rows = texts()
    line = words(rng, 30, "xyz")[:130]
    rows += [words(rng, 15, "uvw")[: rng.randint(0, 60)] + line + words(rng, 15, "uvw") for _ in range(25)]
    rows += ["é" * 120, "xé" * 60 + "é" * 60, rows[2][:150] * 3]
    got = collected(suffix_dedup.dedup(documents(spark, rows), keep=False, group=group))
    assert got == dict(enumerate(plain_dedup(rows)))


def test_suffix_dedup_keeps_bytes_and_whole_characters(spark):
    rows = ["é" * 90, "b" + "é" * 90]
    got = {r.doc_id: r for r in suffix_dedup.dedup(documents(spark, rows)).collect()}
    assert bytes(got[0].kept) == ("é" * 51 + "é" * 0).encode()[: len(got[0].kept)]
    assert hashlib.sha256(bytes(got[1].kept)).hexdigest() == got[1].kept_sha256
    assert "\ufffd" not in got[1].kept_text


def test_suffix_dedup_orders_repeated_and_null_ids_by_text(spark):
    base = words(random.Random(5), 60)
    rows, ids = [base + " z", base, base, base], [7, 7, None, 9]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in suffix_dedup.dedup(documents(spark, rows, ids)).collect())
    whole = len(base)
    # the null id comes first and stays whole
    assert got[0] == (False, 0, 0)
    assert [g[2] for g in got[1:]] == [whole, whole, whole]


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.dedup(empty(spark)).count() == 0


def test_merge_sort_orders_suffixes():
    rng = random.Random(9)
    text = "".join(rng.choice("ab") for _ in range(900)).encode()
    s = suffix_dedup.Suffixes(text, 100, suffix_dedup.BASES[0])
    at = np.array(rng.sample(range(800), 300))
    order = suffix_dedup.merge_sort(s, at, np.zeros(len(at), dtype=int))
    assert [text[i : i + 100] for i in at[order]] == sorted(text[i : i + 100] for i in at)


def reference_fingerprint(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    ws = [w for w in raw.replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").split(b" ") if w]
    if not ws:
        return 0
    shingles = [b" ".join(ws[i : i + 4]) for i in range(len(ws) - 3)] or [b" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reference_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_equals_brute_force(spark):
    rng = random.Random(4)
    rows = texts(3)
    for _ in range(20):  # groups of texts that differ in one word
        base = words(rng, 200).split()
        for _ in range(4):
            base[rng.randrange(200)] = "zz"
            rows.append(" ".join(base))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents(spark, rows)).collect()}
    fps = [reference_fingerprint(t) for t in rows]
    roots = reference_components(fps)
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in range(len(rows))}


def test_simhash_null_and_repeated_ids(spark):
    got = simhash.near_duplicates(documents(spark, ["a b c d e", "a b c d e", "q"], [None, 4, None])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in got if r.component_id is not None) == [(False, 4), (True, 4)]
    assert [r.component_id for r in got if r.component_id is None] == [None]
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    for v in rng.integers(0, 1 << 63, 60, dtype=np.uint64):
        keys = set(simhash.golay_keys(np.array([v]))[1].tolist())
        for n in (1, 2, 3, 4):
            w = v
            for b in rng.choice(64, n, replace=False):
                w ^= np.uint64(1) << np.uint64(b)
            assert keys & set(simhash.golay_keys(np.array([w]))[1].tolist())


def test_forest_joins_all_linked():
    rng = np.random.default_rng(2)
    centre = np.uint64(rng.integers(0, 1 << 63))
    fps = {int(centre)}
    for _ in range(300):
        w = centre
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            w ^= np.uint64(1) << np.uint64(b)
        fps.add(int(w))
    fps = np.array(sorted(fps), dtype=np.uint64)
    a, b = simhash.forest(fps)
    assert len(a) < len(fps) and (np.bitwise_count(a ^ b) <= 4).all()
    want = reference_components([int(x) for x in fps])
    place = {int(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a, b):
        p, q = find(place[int(x)]), find(place[int(y)])
        root[max(p, q)] = min(p, q)
    assert [find(i) for i in range(len(fps))] == want


def test_crowded_keys_join_all_linked(spark, monkeypatch):
    """Close and chained fingerprints whose keys are all over the bound, and with no key over it."""
    rng = random.Random(6)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for base in list(fps)[:6]:
        at = base
        for _ in range(25):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps |= {at, base ^ (1 << rng.randrange(64))}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    want = reference_components([f % (1 << 64) for f in fps])
    marked = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long").repartition(3)
    order = {f: i for i, f in enumerate(fps)}
    for hot in (simhash.HOT, 3, 0):
        monkeypatch.setattr(simhash, "HOT", hot)
        got = {order[r.fp]: r.component_id for r in simhash.classes(marked).collect()}
        assert [got[i] for i in range(len(fps))] == want


def test_ball_links_are_within_four_bits_and_bounded(spark):
    rng = random.Random(9)
    base = rng.getrandbits(63)
    fps = list({base ^ sum(1 << b for b in rng.sample(range(63), rng.randint(0, 2))) for _ in range(60)})
    links = simhash.ball_links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    assert all((r.a ^ r.b).bit_count() <= 4 for r in links)
    assert {r.b for r in links} | {min(fps)} == set(fps)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(links.limit(0)).count() == 0

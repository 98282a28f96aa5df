import math
import struct
import zlib
from collections import Counter

import xxhash
from llm_cases import documents, empty, texts

from tidemark.llm import licenses, sharding, url_filter

WEIGHTS = [(s, 1.0) for s in range(16)]


def test_sharding_law(spark):
    rows = texts() * 6
    ids = [i % (len(rows) - 20) for i in range(len(rows))]
    ids[:4] = [None] * 4
    df = documents(spark, rows, ids)
    got = sharding.shard_documents(df, WEIGHTS, added=(16, 1.0)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, rows)
    )
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len(set(ids))
    # the shard depends on nothing but the key and the shards
    part = sharding.shard_documents(df.filter("doc_id % 3 = 0"), WEIGHTS, added=(16, 1.0)).collect()
    whole = {r.doc_id: (r.shard, r.grown_shard) for r in got}
    assert all(whole[r.doc_id] == (r.shard, r.grown_shard) for r in part)


def plain_shard(key, weights):
    """The shard of the highest ``-weight / ln(u)``, one key and shard at a time."""
    scores = []
    for shard, weight in weights:
        seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        digest = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed)
        u = (digest % (1 << 52) + 0.5) / (1 << 52)
        scores.append((-weight / math.log(u), shard))
    return max(scores)[1]


def test_sharding_equals_a_plain_weighted_score(spark):
    ids = [None, 0, -1, 7, (1 << 62) + 5, -(1 << 63)] + list(range(100, 700, 3))
    for weights, added in ((WEIGHTS, (16, 1.0)), ([(3, 0.5), (9, 2.0), (4, 1.0)], (1, 3.5))):
        got = sharding.shard_documents(documents(spark, ["t"] * len(ids), ids), weights, added=added).collect()
        want = {(i, plain_shard(i, weights), plain_shard(i, [*weights, added])) for i in ids}
        assert {(r.doc_id, r.shard, r.grown_shard) for r in got} == want


def test_sharding_balance_weights_and_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 7)
    monkeypatch.setattr(sharding, "GROUP_ROWS", 50)
    rows = spark.range(4000).selectExpr("id as doc_id", "'t' as text").unionByName(
        spark.range(1500).selectExpr("cast(5 as long) as doc_id", "'hot' as text")
    )
    got = sharding.shard_documents(rows, [(0, 1.0), (1, 3.0)], added=(2, 4.0)).collect()
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 5500 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    once = {r.doc_id: r for r in got}
    n = Counter(r.shard for r in once.values())
    assert 0.22 < n[0] / 4000 < 0.28
    assert 0.46 < sum(r.grown_shard == 2 for r in once.values()) / 4000 < 0.54
    assert sharding.shard_documents(empty(spark), WEIGHTS).count() == 0


URLS = [
    "http://example.com/en/1", "https://www.Example.com/en/a?b#c", "http://m.example.com/en/", "http://example.com/enx",
    "http://a.example.net/es/1", "http://net/fr/", "http://notnet/fr/", "ftp://x.net/de/", "http://example.org/en/1",
    "http://example.com", "http://example.com?x=/en/", "http://example.com#/en/", "no scheme", "", None, "://", "http:///en/",
    "a://b://c/en/", "http://user@EXAMPLE.com:80/en/", "http://com./x", "http://é.com/ü/x y",
]


def plain_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_filter_equals_brute_force(spark):
    rules = url_filter.RULES + [("example.com", "/e", "allow"), ("net", "", "block"), ("net", "", "allow")]
    pages = [(i % 19 if i % 7 else None, u, "x", "y") for i, u in enumerate(URLS * 2)]
    df = spark.createDataFrame(pages, "page_id long, url string, host string, rule string").repartition(3)
    for some in (rules, url_filter.RULES):
        got = url_filter.url_filter(df, url_filter.rule_table(spark, some)).collect()
        assert Counter(map(tuple, got)) == Counter((i, *plain_rule(u, some)) for i, u, *_ in pages)
    none = url_filter.url_filter(df, url_filter.rule_table(spark, url_filter.RULES).limit(0), default="block")
    assert {(r.rule, r.verdict) for r in none.collect()} == {(None, "block")} and none.count() == len(pages)
    assert url_filter.url_filter(df.limit(0), url_filter.rule_table(spark, rules)).count() == 0


def plain_shingles(text, k=5):
    ws = ["".join(c) for c in _words((text or "").lower())]
    return [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)]


def _words(text):
    word = []
    for c in text + " ":
        if c.isalpha() or c.isnumeric():
            word.append(c)
        elif word:
            yield word
            word = []


def test_licenses_equal_brute_force(spark):
    rows = texts()
    t = licenses.TEMPLATES
    rows += [words + " " + text + " tail" for text in t.values() for words in ("", "some words before it here")]
    rows += [t["MIT notice"].upper(), t["MIT notice"].replace("granted", "given"), t["GPL notice"][:90], "x " * 50 + t["BSD notice"]]
    rows += [t["CC-BY-NC-4.0 line"].replace("Licensed", "given"), " ".join(t.values()) * 2, "spdx license  identifier (mit)", "identifier: MIT"]
    assert any(len(list(_words(wanted.lower()))) < 5 for wanted in t.values())
    got = {(r.doc_id, r.template): (round(r.containment, 9), r.windows) for r in licenses.scan(documents(spark, rows), t).collect()}
    want = {}
    for i, text in enumerate(rows):
        for name, wanted in t.items():
            k = min(5, len(list(_words(wanted.lower()))))
            found, need = plain_shingles(text, k), set(plain_shingles(wanted, k))
            m = len(need)
            step, length = max(1, m // 8), m + (max(1, m // 8) if m >= 8 else 0)
            best = max((len(need & set(found[s : s + length])) / m for s in range(0, len(found), step)), default=0)
            if best >= 0.8:
                want[(i, name)] = round(best, 9)
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] >= 1 for v in got.values()) and len(want) > 20


def test_licenses_of_nothing(spark):
    assert licenses.scan(empty(spark), licenses.TEMPLATES).count() == 0
    assert licenses.scan(documents(spark, ["a b c d e"]), {}).count() == 0
    both = licenses.scan(documents(spark, [licenses.TEMPLATES["MIT line"]] * 2, [None, None]), licenses.TEMPLATES).collect()
    assert [(r.doc_id, r.template, r.containment) for r in both] == [(None, "MIT line", 1.0)]

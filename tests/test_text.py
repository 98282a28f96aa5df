"""Words, counts, edit distance and the keys by which similar words meet."""

import random
import re
import unicodedata
from collections import Counter
from itertools import combinations

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import text as X


def osa(a, b):
    """Restricted edit distance by its definition."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(
                d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1])
            )
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def mutate(rng, word, alphabet, edits):
    for _ in range(edits):
        i = rng.randrange(len(word) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            word = word[:i] + rng.choice(alphabet) + word[i:]
        elif kind == 1 and word:
            word = word[: i - 1] + word[i:] if i else word[1:]
        elif kind == 2 and i < len(word):
            word = word[:i] + rng.choice(alphabet) + word[i + 1 :]
        elif i + 1 < len(word):
            word = word[:i] + word[i + 1] + word[i] + word[i + 2 :]
    return word


def pairs(seed, lengths, alphabet, n):
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        a = "".join(rng.choice(alphabet) for _ in range(rng.choice(lengths)))
        out.add((a, mutate(rng, a, alphabet, rng.randrange(4))))
    return sorted(out)


def test_tokens(spark):
    cases = {
        "Hello, WORLD-2 é": ["hello", "world", "2", "é"],
        "": [],
        "中文搜索ab": ["中文", "文搜", "搜索", "ab"],
        "中": ["中"],
        "a_b": ["a", "b"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.w for r in df.select("t", X.tokens(F.col("t")).alias("w")).collect()}
    assert got == cases


def test_spans_and_term_places(spark):
    rng = random.Random(1)
    word = lambda: rng.choice(["ab", "Ä", "x9", "İz", "中文搜", "_", "中", "b"])
    texts = ["", " ", "a", "--a", "Hello,\n WORLD-2 é"] + [rng.choice(["", " ", ".,"]).join(word() for _ in range(n)) for n in (1, 2, 3, 16, 50, 400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = X.with_term_places(X.with_spans(df, "t", "s"), "s", "c").withColumn("w", X.tokens(F.col("t"))).collect()
    for r in got:
        assert [s.term for s in r.s] == r.w
        for s in r.s:
            assert texts[r.i][s.start - 1 :][: len(s.term)].replace("İ", "i").lower() == s.term
        want = sorted(Counter(r.w).items())
        assert [(c.term, c.tf) for c in r.c or []] == want
        for c in r.c or []:
            assert sorted(c.starts) == [s.start for s in r.s if s.term == c.term]
    assert spark.createDataFrame([(None,)], "t string").transform(lambda d: X.with_spans(d, "t", "s")).first().s is None


def test_words_of_any_script_are_runs_of_letters_and_digits(spark):
    plain = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"
    rng = random.Random(7)
    blocks = [(0, 0x180), (0x370, 0x400), (0x5D0, 0x5F0), (0x2E80, 0x3200), (0x4E00, 0x4E40), (0xAC00, 0xAC20), (0x1F600, 0x1F610), (0x20000, 0x20010)]
    texts = ["".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(60)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.lower("t").alias("t"))
    want = F.regexp_extract_all("t", F.lit(plain), F.lit(0))
    pieces = F.regexp_extract_all("t", F.lit(f"{X.GAP}(?:{X.WORD})"), F.lit(0))
    bare = F.transform(pieces, lambda p: F.regexp_replace(p, r"^[^\p{L}\p{N}\p{IsHan}]+", ""))
    got = df.select(want.alias("a"), F.regexp_extract_all("t", F.lit(X.WORD), F.lit(0)).alias("b"), bare.alias("c")).collect()
    assert all(r.a == r.b == r.c for r in got) and sum(len(r.a) for r in got) > 2000


def test_running_totals(spark):
    cases = [[], [5], [1, 0, 2], list(range(100)), [1] * 1023]
    df = spark.createDataFrame([(c,) for c in cases], "v array<int>")
    for r in X.with_running_totals(df, "v", "t").collect():
        assert r.t == [sum(r.v[: i + 1]) for i in range(len(r.v))]


def test_numbers_have_one_text_form(spark):
    cases = {"12": "12", "12.50": "12.5", "100": "100", "0.000": "0", "-3.0000001": "-3", "1e3": "1000", "x": None, "": None, "9" * 40: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.n for r in df.select("t", X.number_text(F.col("t")).alias("n")).collect()} == cases
    floats = spark.createDataFrame([(112946.26,), (1e7,), (0.1,)], "x double").select(X.number_text(F.col("x"))).collect()
    assert [r[0] for r in floats] == ["112946.26", "10000000", "0.1"]
    typed = spark.createDataFrame([(" a 12.50 -7 1e3 12.5 2024-01-02 3. .5 x1",)], "k string")
    assert typed.select(X.typed_numbers(F.col("k"))).first()[0] == ["12.5", "-7"]


def test_edit_distance(spark):
    cases = pairs(2, [1, 2, 3, 4, 5, 6, 8], "abc", 3000) + [("ca", "abc"), ("abcd", "badc"), ("", "a")]
    df = spark.createDataFrame(cases, "a string, b string")
    got = df.select("a", "b", X.edit_distance(F.col("a"), F.col("b")).alias("d")).collect()
    wrong = [(r.a, r.b, r.d, osa(r.a, r.b)) for r in got
             if (r.d if r.d is not None else 9) != (osa(r.a, r.b) if osa(r.a, r.b) <= 2 else 9)]
    assert not wrong


def test_similar_words_share_a_key(spark):
    """Short and long words, and those on both sides of the border between the two."""
    cases = [
        (a, b)
        for a, b in pairs(3, [3, 4, 5, 6, 7, 8, 9, 10, 30, 60], "abcdefgh", 4000)
        if osa(a, b) <= (0 if len(a) <= 2 else 1 if len(a) <= 5 else 2)
    ]
    assert len(cases) > 1800
    from tidemark.operators.search_index import near_keys

    df = spark.createDataFrame(cases, "word string, term string")
    near = near_keys(df.select("term").distinct()).groupBy("term").agg(F.collect_set("key").alias("k"))
    probes = X.deletion_keys(F.col("word"), X.max_edits(F.col("word")))
    lost = df.join(near, "term").filter(~F.arrays_overlap(probes, "k"))
    assert rows(lost.select("word", "term")) == []
    assert near.agg(F.max(F.size("k"))).first()[0] <= 22


def test_split_words_are_those_that_extraction_finds(spark):
    """Texts without Han characters are split; every kind of character stands beside a letter, at both ends and alone."""
    kinds = [chr(c) for c in range(1, 0x3000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    texts = [f"{c}a{c}B7{c}{c} {c}" for c in kinds] + kinds + ["", " ", "a", "İİ ıI", "  two  words  ", "𝒳y 😀z\n\tq", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").filter(~F.coalesce(F.col("t"), F.lit("")).rlike(X.HAN_CHAR))
    plain = F.regexp_extract_all(F.lower(F.translate("t", "İ", "i")), F.lit(X.WORD), F.lit(0))
    bad = df.select("t", X.tokens(F.col("t")).alias("got"), plain.alias("want")).filter("NOT got <=> want")
    assert bad.collect() == []


def test_deletion_keys_are_all_ways_to_leave_letters_out(spark):
    words = ["a", "ab", "aab", "abc", "aaaaaa", "abcdef", "abcabcabc", "éèêëö", "𝒳yz𝒳yz𝒳", "machinery", ""]
    df = spark.createDataFrame([(w, e) for w in words for e in (0, 1, 2)], "w string, e int")
    want = [
        (w, e, "".join(k))
        for w in words for e in (0, 1, 2) for n in range(e + 1)
        for k in {tuple(w[i] if i < len(w) else "" for i in range(6) if i not in left) for left in combinations(range(6), n)}
    ]
    wanted = spark.createDataFrame(want, "w string, e int, k string").select("w", "e", F.hash("k").alias("k")).distinct()
    got = df.select("w", "e", F.explode(X.deletion_keys(F.col("w"), F.col("e"))).alias("k"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_keys_of_words_are_no_method_too_long_to_compile(spark):
    """The JVM interprets methods of over 8,000 bytes, however often they run."""
    df = spark.createDataFrame([("machinery",)], "w string").select("w", F.explode(X.deletion_keys(F.col("w"), X.max_edits(F.col("w")))))
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert all(int(n) <= 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", plan))

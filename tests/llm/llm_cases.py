"""Small tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ["shard", "size", "fp", "d", "found", "length", "salt", "hashes", "w", "row", "key", "kept", "rank", "vector"]


def words(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 7))) for _ in range(n))


def texts(seed=1):
    rng = random.Random(seed)
    passage = words(rng, 60)
    out = [words(rng, rng.randint(5, 120)) for _ in range(40)]
    out += [out[3]] * 12  # copies
    out += [out[5].replace("a", "b", 2) for _ in range(3)]  # near copies
    out += [words(rng, 8) + " " + passage + " " + words(rng, 9) for _ in range(15)]
    out += [None, "", " \n\t ", "x", "Ä é 漢字 😀 \u00a0 z", "a" * 700, "ab " * 400, words(rng, 6000)]
    return out


def documents(spark, rows=None, ids=None, clash=True):
    rows = texts() if rows is None else rows
    ids = list(range(len(rows))) if ids is None else ids
    data = [(i, t, "en", "src0", len(t or "")) for i, t in zip(ids, rows)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    if clash:
        for name in CLASHING:
            df = df.selectExpr("*", f"'other' as `{name}`")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

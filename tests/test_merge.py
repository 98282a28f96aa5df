"""Applying changes, against a row-by-row replay, with hot keys and three kinds of absence."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions.values import UNAVAILABLE
from tidemark.operators import merge as M
from tidemark.operators import sinks as S

SCHEMA = "seq long, key int, op string, a string, b int, big string, _unchanged array<string>"
COLUMNS = ["a", "b", "big"]


def random_changes(seed, n, start=0):
    rng, out = random.Random(seed), []
    for seq in range(start, start + n):
        # one key holds half of all changes
        key = 0 if rng.random() < 0.5 else rng.randrange(1, 12)
        op = rng.choice("cuuuud")
        marked = op != "d" and rng.random() < 0.5
        big = None if marked or op == "d" or rng.random() < 0.2 else f"big{seq}"
        a = None if rng.random() < 0.2 or op == "d" else f"a{seq}"
        out.append((seq, key, op, a, None if op == "d" else seq, big, ["big"] if marked else []))
    return out


def replay(changes, state=None):
    state = dict(state or {})
    for _, key, op, a, b, big, unchanged in sorted(changes):
        if op == "t":
            state.clear()
        elif op == "d":
            state.pop(key, None)
        else:
            old = None if op in "cr" else state.get(key)
            if unchanged:
                big = old[2] if old else UNAVAILABLE
            state[key] = (a, b, big)
    return state


def table(state):
    return sorted((k, *v) for k, v in state.items())


def got(df):
    return sorted(tuple(r) for r in df.select("key", *COLUMNS).collect())


def frame(spark, changes):
    return spark.createDataFrame(changes, SCHEMA)


def target(spark, state):
    return spark.createDataFrame(table(state), "key int, a string, b int, big string")


def test_apply_equals_replay(spark):
    for seed in range(3):
        changes = random_changes(seed, 150)
        out = M.apply_changes(None, frame(spark, changes), ["key"], COLUMNS, "seq", ["big"])
        assert got(out) == table(replay(changes))


def test_apply_to_target_and_batches(spark):
    first, second = random_changes(5, 60), random_changes(6, 60, 60)
    state = replay(first)
    want = table(replay(second, state))
    out = M.apply_changes(target(spark, state), frame(spark, second), ["key"], COLUMNS, "seq", ["big"])
    assert got(out) == want
    # folding folds of any batches is folding all at once
    folds = [M.fold_changes(frame(spark, c), ["key"], COLUMNS, "seq", ["big"]) for c in (first, second)]
    again = M.fold_changes(folds[0].unionByName(folds[1]), ["key"], COLUMNS, "seq", ["big"])
    assert got(M.from_folded(again, ["key"], COLUMNS)) == table(replay(first + second))


def test_null_is_not_unchanged(spark):
    changes = [(1, 1, "c", "x", 1, "old", []), (2, 1, "u", None, 2, None, []),
               (3, 1, "u", "y", 3, None, ["big"])]
    out = M.apply_changes(None, frame(spark, changes), ["key"], COLUMNS, "seq", ["big"])
    assert got(out) == [(1, "y", 3, None)]


def test_fill_does_not_cross_a_delete(spark):
    changes = [(1, 1, "u", "x", 1, "old", []), (2, 1, "d", None, None, None, []),
               (3, 1, "c", "y", 3, None, ["big"])]
    out = M.apply_changes(None, frame(spark, changes), ["key"], COLUMNS, "seq", ["big"])
    assert got(out) == [(1, "y", 3, UNAVAILABLE)]


def test_truncate(spark):
    state = {7: ("keep?", 7, "t")}
    changes = random_changes(8, 40) + [(40, None, "t", None, None, None, [])] + random_changes(9, 30, 41)
    df = frame(spark, changes)
    out = M.apply_changes(target(spark, state), df, ["key"], COLUMNS, "seq", ["big"], truncates=True)
    assert got(out) == table(replay(changes, state))
    skipped = M.apply_changes(target(spark, state), df, ["key"], COLUMNS, "seq", ["big"])
    assert got(skipped) == table(replay([c for c in changes if c[2] != "t"], state))


def test_small_batch_is_broadcast_and_hot_keys_are_cut_before_the_shuffle(spark, tmp_path):
    frame(spark, random_changes(1, 50)).write.parquet(str(tmp_path / "c"))
    changes = spark.read.schema(SCHEMA).parquet(str(tmp_path / "c"))
    folded = M.fold_changes(changes, ["key"], COLUMNS, "seq", ["big"])
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1 and plan.count("partial_max") > 0
    assert "Window" not in plan and "Join" not in plan and "BatchEvalPython" not in plan


def test_last_change(spark):
    changes = random_changes(4, 80)
    out = rows(M.last_change(frame(spark, changes).select("key", "seq", "op"), ["key"], "seq"))
    assert out == sorted((k, *max((c[0], c[2]) for c in changes if c[1] == k)) for k in {c[1] for c in changes})


def test_hand_over(spark):
    changes = random_changes(11, 100)
    snapshot = replay([c for c in changes if c[0] <= 40])
    out = M.hand_over(target(spark, snapshot), 40, frame(spark, changes), ["key"], COLUMNS, "seq", ["big"])
    assert got(out) == table(replay(changes))


def test_fill_rules(spark):
    df = spark.createDataFrame([("n", "o", True), ("n", None, True), ("n", "o", False)], "n string, o string, u boolean")
    out = df.select(M.fill_unchanged(F.col("n"), F.col("o"), F.col("u")).alias("v"))
    assert [r.v for r in out.collect()] == ["o", UNAVAILABLE, "n"]
    filled = M.fill_undelivered({"a": F.lit("x")}, ["a", "b", "c"], {"b": F.lit("old")})
    r = spark.range(1).select(*[v.alias(k) for k, v in filled.items()]).first()
    assert tuple(r) == ("x", "old", UNAVAILABLE)


def test_schema_drift(spark):
    shape = "table string, column string, type long, length int, scale int, nullable boolean"
    known = spark.createDataFrame(
        [("t", "same", 1, 5, 0, True, False), ("t", "gone", 1, 5, 0, True, False),
         ("t", "gone_big", 1, 5, 0, True, True), ("t", "longer", 1, 5, None, True, False),
         ("t", "domain", 1, 5, 0, True, False), ("t", "typed", 1, 5, 0, False, False)],
        shape + ", large boolean")
    seen = spark.createDataFrame(
        [("t", "same", 1, 5, 0, True, None), ("t", "new", 1, 5, 0, True, None),
         ("t", "longer", 1, 9, 0, True, None), ("t", "domain", 77, 5, 0, True, 1),
         ("t", "typed", 2, 5, 3, True, None)], shape + ", root_type long")
    found = {(r.column, r.difference) for r in M.schema_drift(known, seen, True).collect()}
    assert found == {("gone", "missing"), ("new", "added"), ("longer", "length"), ("typed", "type"),
                     ("typed", "scale"), ("typed", "nullable")}
    strict = {(r.column, r.difference) for r in M.schema_drift(known, seen, metadata=False).collect()}
    assert strict == {("gone", "missing"), ("gone_big", "missing"), ("new", "added"), ("typed", "type")}


# ---- bulk operations ----------------------------------------------------------------

OPS = "seq long, _index string, _id string, op string, x int, y string, _fields array<string>"


def bulk(seed, n):
    rng, out = random.Random(seed), []
    for seq in range(n):
        key = "hot" if rng.random() < 0.4 else str(rng.randrange(8))
        op = rng.choice(["INDEX", "UPDATE", "UPDATE", "UPDATE", "DELETE"])
        x = rng.choice([None, seq])
        y = rng.choice([None, f"y{seq}"])
        fields = [f for f in ("x", "y") if rng.random() < 0.5] if op == "UPDATE" else []
        out.append((seq, "i", key, op, x, y, fields))
    return out


def bulk_replay(ops, state):
    state = dict(state)
    for _, index, key, op, x, y, fields in ops:
        k = (index, key)
        if op == "DELETE":
            state.pop(k, None)
        elif op == "INDEX":
            state[k] = (x, y, None)
        else:
            old = state.get(k, (None, None, None))
            state[k] = (x if "x" in fields else old[0], y if "y" in fields else old[1], old[2])
    return state


@pytest.mark.parametrize("seed", range(3))
def test_bulk(spark, seed):
    start = {("i", str(i)): (i, f"s{i}", "kept") for i in range(0, 8, 2)}
    ops = bulk(seed, 120)
    before = spark.createDataFrame([(*k, *v) for k, v in start.items()], "_index string, _id string, x int, y string, z string")
    out = S.apply_ops(before, spark.createDataFrame(ops, OPS), ["x", "y"], "seq")
    want = sorted((*k, *v) for k, v in bulk_replay(ops, start).items())
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_writes(spark):
    before = spark.createDataFrame([("i", "1", 1, "a"), ("i", "2", 2, "b")], "_index string, _id string, x int, y string")
    patch = spark.createDataFrame([("i", "1", None, ["x"]), ("i", "9", 9, ["x"])], "_index string, _id string, x int, _fields array<string>")
    assert rows(S.merge_fields(before, patch)) == [("i", "1", None, "a"), ("i", "2", 2, "b"), ("i", "9", 9, None)]
    docs = spark.createDataFrame([("i", "1", "new")], "_index string, _id string, w string")
    assert rows(S.upsert(before, docs)) == [("i", "1", None, None, "new"), ("i", "2", 2, "b", None)]
    assert rows(S.delete(before, docs)) == [("i", "2", 2, "b")]
    good, bad = S.split_rejects(before, {"x too large": F.col("x") < 2, "no y": F.col("y") != "b"})
    assert rows(good) == [("i", "1", 1, "a")] and rows(bad) == [("i", "2", "x too large; no y")]

"""Order-dependent operators against plain Python, with one group holding most rows."""

import re

from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.transactions import backlog_runs, commit_sequence, tx_order
from tidemark.plans.order import last_before, number_rows, rank_in_groups, sorted_slices


def log(spark, n=2000):
    # half of all rows share one transaction
    return spark.range(n).select(
        ((F.col("id") * 7919) % n * 3 + 1).alias("seq"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50).cast("long").alias("txid"),
        # null is a table like any other
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("table"),
        (F.col("id") % 11 == 0).alias("hit"),
    )


def test_slices_have_like_sizes_under_skew(spark):
    sizes = [r["count"] for r in sorted_slices(log(spark), [F.col("txid"), F.col("seq")], 8)
             .groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 2000 / 8


def test_number_rows(spark):
    got = number_rows(log(spark), [F.col("seq")], "n", 7).select("seq", "n")
    assert rows(got) == sorted((s * 3 + 1, s) for s in range(2000))


def test_number_rows_by_text_key(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a10", "a9", "é", "Z"]], "k string")
    got = dict(rows(number_rows(df, [F.col("k")], "n", 3)))
    assert got == {"Z": 0, "a10": 1, "a9": 2, "b": 3, "é": 4}


def test_last_before(spark):
    got = dict(
        last_before(log(spark), [F.col("seq")], "seq", F.col("hit"), "p", 9)
        .select("seq", "p")
        .collect()
    )
    last, want = None, {}
    for r in log(spark).orderBy("seq").collect():
        want[r.seq] = last
        if r.hit:
            last = r.seq
    assert got == want


def test_rank_in_groups(spark):
    got = rank_in_groups(log(spark), [F.col("seq")], {"a": ["txid"], "b": ["txid", "table"]}, 6)
    seen, want = {}, []
    for r in log(spark).orderBy("seq").collect():
        for g in ((r.txid,), (r.txid, r.table)):
            seen[g] = seen.get(g, 0) + 1
        want.append((r.seq, seen[(r.txid,)], seen[(r.txid, r.table)]))
    assert rows(got.select("seq", "a", "b")) == sorted(want)
    assert tx_order(log(spark), slices=4).columns == ["seq", "txid", "table", "total_order", "table_order"]


def test_backlog_runs(spark):
    flags = [True] * 2 + [False] * 5 + [True] + [False] * 25 + [True] * 3 + [False]
    df = spark.createDataFrame(list(enumerate(flags)), "seq long, e boolean")
    got = rows(backlog_runs(df, F.col("e"), limit=9, slices=5))
    assert got == [(2, 6, 5, 0), (8, 32, 25, 2), (36, 36, 1, 0)]
    assert {r[3] for r in rows(backlog_runs(df, F.col("e"), heartbeats=True, limit=9, slices=5))} == {0}


def test_commit_sequence(spark):
    data = [(0, 10, 1, "begin"), (1, 10, 1, "c"), (2, 20, 1, "commit"), (3, 30, 2, "begin"),
            (4, 30, 2, "u"), (5, 40, 2, "u"), (6, 50, 2, "commit"), (7, 60, 3, "c")]
    df = spark.createDataFrame(data, "seq long, lsn long, txid long, op string")
    got = rows(commit_sequence(df, slices=3).select("seq", "last_commit_lsn"))
    assert got == [(1, None), (4, 20), (5, 20), (7, 50)]


def test_single_partition_only_above_a_summary(spark):
    """What is gathered in one partition has been aggregated to a row per slice."""
    df = number_rows(log(spark), [F.col("seq")], "n", 4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    below = plan[plan.index("SinglePartition") :]
    assert re.search(r"HashAggregate\(keys=\[_slice", below)
    assert "BatchEvalPython" not in plan


def test_one_key_in_half_of_all_rows_is_cut_into_like_slices(spark):
    df = spark.range(8000).selectExpr("id", "case when id % 2 = 0 then 7 else id end as k")
    sliced = sorted_slices(df, [F.col("k")], 8)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 8000 and len(sizes) == 8 and max(sizes) < 2 * 1000

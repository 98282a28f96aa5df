"""Streams into a keyed table: restart, replay, stopping, snapshots, markers."""

import os

import pytest
from conftest import rows
from test_merge import SCHEMA as CHANGES
from test_merge import random_changes, replay, table
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.keyed_table import KeyedTable, stream_name, wider_type
from tidemark.plans.snapshot_modes import Plan
from tidemark.streaming import apply as A

LOG = CHANGES + ", lsn long, txid long"


class Log:
    """A log kept as one file per batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.rows = spark, str(root / "log"), []
        os.makedirs(self.root)

    def append(self, changes, markers=()):
        extended = [(*c, 100 + c[0] * 10, c[0] // 7) for c in changes] + list(markers)
        self.rows += changes
        df = self.spark.createDataFrame(extended, LOG)
        df.coalesce(1).write.mode("append").parquet(self.root)

    def stream(self):
        reader = self.spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.root)


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, tmp_path)


@pytest.fixture
def target(tmp_path):
    return KeyedTable(str(tmp_path / "table"), "key int, a string, b int, big string", ("key",), ("big",))


def run(log, target, tmp_path, **options):
    A.apply_stream(log.stream(), target, str(tmp_path / "checkpoint"), **options).awaitTermination()


def content(spark, target):
    return sorted(tuple(r) for r in target.read(spark).select("key", "a", "b", "big").collect())


def test_restart_gives_the_same_table(spark, log, target, tmp_path):
    for part in range(2):
        log.append(random_changes(part, 40, part * 40))
    run(log, target, tmp_path)
    log.append(random_changes(9, 40, 80))
    run(log, target, tmp_path)  # a new query on the old checkpoint
    assert content(spark, target) == table(replay(log.rows))
    progress = rows(A.progress(spark, target).select("batch", "rows_in", "max_lsn"))
    assert progress == [(0, 40, 490), (1, 40, 890), (2, 40, 1290)]


def test_replay_and_crash_change_nothing(spark, log, target, tmp_path):
    first, second = random_changes(1, 40), random_changes(2, 40, 40)
    df = lambda c: spark.createDataFrame(c, CHANGES)
    target.write_batch(df(first), 0)
    target.write_batch(df(second), 0)  # a batch number the table knows is not applied again
    assert content(spark, target) == table(replay(first))
    # a crash behind the data and before the manifest leaves a folder that does not count
    df(second).write.parquet(f"{target.path}/delta/{stream_name('')}-1")
    assert content(spark, target) == table(replay(first))
    target.write_batch(df(second), 1)
    assert content(spark, target) == table(replay(first + second))
    # a stream with a checkpoint of its own counts from 0 again, and its batch is another one
    third = random_changes(3, 40, 80)
    target.write_batch(df(third), 0, stream="other")
    target.write_batch(df(first), 0, stream="other")
    assert content(spark, target) == table(replay(first + second + third))
    target.compact(spark)
    assert content(spark, target) == table(replay(first + second + third))
    assert target.last_batch(spark) == 1 and target.last_batch(spark, "other") == 0


def test_truncates_empty_the_table_if_asked(spark, log, target, tmp_path):
    log.append(random_changes(1, 20))
    run(log, target, tmp_path, truncates="include")
    later = random_changes(2, 10, 22)
    log.append([(21, None, "t", None, None, None, [])] + later)
    run(log, target, tmp_path, truncates="include")
    assert content(spark, target) == table(replay(later))
    target.compact(spark)
    assert content(spark, target) == table(replay(later))


def test_compaction(spark, log, target, tmp_path):
    for part in range(4):
        log.append(random_changes(part, 25, part * 25))
        run(log, target, tmp_path)
        if part in (1, 2):
            target.compact(spark)
            target.compact(spark)
        assert content(spark, target) == table(replay(log.rows))


def test_stop_at_position(spark, log, target, tmp_path):
    for part in range(3):
        log.append(random_changes(part, 20, part * 20))
    run(log, target, tmp_path, stop_lsn=100 + 305)  # reached by change 31
    assert content(spark, target) == table(replay([c for c in log.rows if c[0] <= 31]))
    assert A.reached(spark, target, 405) and not A.reached(spark, target, 10**6)


def test_catch_up_then_snapshot(spark, log, target, tmp_path):
    log.append(random_changes(1, 30))
    fresh = {5: ("s", 5, "x"), 6: ("t", 6, None)}
    snapshot = lambda: spark.createDataFrame(table(fresh), "key int, a string, b int, big string")
    A.catch_up_then_snapshot(log.stream(), target, str(tmp_path / "checkpoint"), snapshot, 100 + 290)
    assert content(spark, target) == table(fresh)
    later = random_changes(2, 30, 30)
    log.append(later)
    run(log, target, tmp_path)
    assert content(spark, target) == table(replay(later, fresh))


def test_transaction_events(spark, log, target, tmp_path):
    changes = [(i, 1, "u", "a", i, None, []) for i in range(1, 4)]
    marks = [(0, None, "begin", None, None, None, [], 100, 0), (9, None, "commit", None, None, None, [], 140, 0)]
    log.append(changes, marks)
    run(log, target, tmp_path, tx_path=str(tmp_path / "tx"))
    events = spark.read.parquet(str(tmp_path / "tx")).select("id", "status", "event_count")
    assert rows(events) == [("0", "BEGIN", None), ("0", "END", 3)]
    assert content(spark, target) == [(1, "a", 3, None)]
    # markers move the position even if nothing changes
    log.append([], [(20, None, "begin", None, None, None, [], 300, 1)])
    run(log, target, tmp_path)
    last = A.progress(spark, target).orderBy(F.desc("batch")).first()
    assert (last.rows_in, last.rows_out, last.max_lsn) == (1, 0, 300)


def test_transactions_over_batches(spark, log, target, tmp_path):
    where = str(tmp_path / "tx")
    log.append([(1, 1, "u", "a", 1, None, [])], [(0, None, "begin", None, None, None, [], 100, 0)])
    run(log, target, tmp_path, tx_path=where)
    log.append([(2, 1, "u", "a", 2, None, [])])
    run(log, target, tmp_path, tx_path=where)
    log.append([(3, 2, "u", "a", 3, None, [])], [(9, None, "commit", None, None, None, [], 140, 0)])
    run(log, target, tmp_path, tx_path=where)
    events = spark.read.parquet(where).select("id", "status", "event_count")
    assert rows(events) == [("0", "BEGIN", None), ("0", "END", 3)]


def test_small_change_set_leaves_the_target_unshuffled(spark, target):
    spark.range(2000).select(F.col("id").cast("int").alias("key"), F.lit("a").alias("a"),
                             F.lit(1).alias("b"), F.lit("x").alias("big")).createOrReplaceTempView("big_target")
    target.replace(spark.table("big_target"))
    target.write_batch(spark.createDataFrame(random_changes(1, 30), CHANGES), 0)
    df = target.read(spark)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "BatchEvalPython" not in plan


def test_capture_modes(spark, log, target, tmp_path):
    log.append(random_changes(1, 30))
    state = replay([c for c in log.rows if c[0] <= 10])
    shape = "key int, a string, b int, big string"
    taken = []

    def snapshot(query, position):
        taken.append((query, position))
        return spark.createDataFrame(table(state), shape)

    def start(mode, **options):
        query = A.capture(spark, mode, target, snapshot, 200, log.stream, str(tmp_path / "c"), **options)
        if query is not None:
            query.awaitTermination()
        return query

    assert target.snapshot_state(spark) == "none"
    target.begin_snapshot(spark)
    assert target.snapshot_state(spark) == "unfinished"
    with pytest.raises(ValueError):
        start("never")
    assert start("initial_only") is None and content(spark, target) == table(state)
    assert target.snapshot_state(spark) == "finished" and len(taken) == 1
    start("initial")
    assert len(taken) == 1 and content(spark, target) == table(replay(log.rows))
    log.append(random_changes(2, 10, 30))
    start("never")
    assert content(spark, target) == table(replay(log.rows))
    start("always")
    assert taken == [(None, 200)] * 2


def test_a_snapshot_obeys_its_plan(spark, log, target, tmp_path):
    log.append(random_changes(1, 30))
    taken = []

    def snapshot(query, position):
        taken.append((query, position))
        state = replay([c for c in log.rows if 100 + c[0] * 10 <= position])
        rows = spark.createDataFrame(table(state), "key int, a string, b int, big string")
        return rows if query is None else rows.filter(query)

    def start(mode, checkpoint="c", **options):
        query = A.capture(spark, mode, target, snapshot, 300, log.stream, str(tmp_path / checkpoint), **options)
        query.awaitTermination()

    with pytest.raises(ValueError):
        start("exported")  # nobody says where the log starts
    start("exported", log_start=200)
    assert taken == [(None, 200)] and content(spark, target) == table(replay(log.rows))
    # the position stays with the table, also when it is compacted and another run names another one
    target.compact(spark)
    assert target.snapshot_lsn(spark) == 200
    start("initial", "d")
    assert len(taken) == 1 and content(spark, target) == table(replay(log.rows))
    rule = lambda saved: Plan(True, True, False, lambda name: f"key = {name}")
    start("custom", "e", custom=rule, name="3")
    assert taken[1:] == [("key = 3", 300)]
    later = [c for c in log.rows if 100 + c[0] * 10 > 300 or c[1] == 3]
    assert content(spark, target) == table(replay(later))
    # a rule without a query for the table takes no snapshot of it
    start("custom", "f", custom=lambda saved: Plan(True, True, False, lambda name: None))
    assert len(taken) == 2


def test_a_table_takes_on_columns_and_wider_types(spark, tmp_path):
    target = KeyedTable(str(tmp_path / "table"), "key int, a int", ("key",), ("big",), evolves=True)
    none = "_unchanged array<string>"
    target.write_batch(spark.createDataFrame([(1, "c", 1, 7, []), (2, "c", 2, 8, [])], f"seq long, op string, key int, a int, {none}"), 0)
    assert target.read(spark).dtypes == [("key", "int"), ("a", "int")]
    wide = f"seq long, op string, key bigint, a double, big string, {none}"
    target.write_batch(spark.createDataFrame([(3, "u", 2, 0.5, "x", []), (4, "c", 3, 9.0, "y", [])], wide), 1)
    assert target.read(spark).dtypes == [("key", "bigint"), ("a", "double"), ("big", "string")]
    assert rows(target.read(spark)) == [(1, 7.0, None), (2, 0.5, "x"), (3, 9.0, "y")]
    # a change of the old shape and one that leaves the new column as it was
    target.write_batch(spark.createDataFrame([(5, "u", 1, 6, [])], f"seq long, op string, key int, a int, {none}"), 2)
    target.compact(spark)
    target.write_batch(spark.createDataFrame([(6, "u", 3, 1.5, None, ["big"])], wide), 3)
    assert rows(target.read(spark)) == [(1, 6.0, None), (2, 0.5, "x"), (3, 1.5, "y")]
    with pytest.raises(ValueError, match="no type holds"):
        target.write_batch(spark.createDataFrame([(7, "u", 3, "no", [])], f"seq long, op string, key int, a string, {none}"), 4)
    assert target.last_batch(spark) == 3


def test_wider_types():
    decimal = T.DecimalType
    for a, b, want in [
        (T.ByteType(), T.LongType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.FloatType(), T.ShortType(), T.FloatType()), (decimal(10, 2), decimal(9, 4), decimal(12, 4)),
        (T.LongType(), decimal(10, 2), decimal(22, 2)), (T.DateType(), T.TimestampType(), T.TimestampType()),
        (T.LongType(), T.DoubleType(), None), (T.StringType(), T.IntegerType(), None), (decimal(38, 0), decimal(38, 2), None),
    ]:
        for x, y in ((a, b), (b, a)):
            if want is None:
                with pytest.raises(ValueError):
                    wider_type(x, y)
            else:
                assert wider_type(x, y) == want

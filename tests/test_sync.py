"""Statements, saved cursors and runs with restart."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import documents as D
from tidemark.plans import state, sync
from tidemark.plans.snapshot_modes import FINISHED, NONE, UNFINISHED, Plan, plan
from tidemark.sources import statements as st
from tidemark.sources.snapshot import clean_columns, row_counts, snapshot_scan
from tidemark.sources.statements import Statement


@pytest.fixture
def people(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in (9, 10, 11, 12, 2)], "ID long, name string")
    df.createOrReplaceTempView("people")
    return df


def test_chunks_partition_the_input(spark, people):
    chunks = rows(st.assign_chunks(people.select("ID"), "ID", 2, 3))
    assert chunks == [(2, 0), (9, 0), (10, 1), (11, 1), (12, 2)]
    cursor, seen = 0, []
    while part := rows(st.next_chunk(people.select("ID"), "ID", cursor, 2)):
        seen.append([r[0] for r in part])
        cursor = part[-1][0]
    assert seen == [[2, 9], [10, 11], [12]]


def test_scan_filter_is_pushed_down(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "p"))
    df = st.incremental_scan(spark.read.parquet(str(tmp_path / "p")), "ID", 5).select("ID")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ID,5)" in text and "ReadSchema: struct<ID:bigint>" in text


def test_run_statement(spark, people):
    sql = "SELECT * FROM people WHERE id > ? ORDER BY id LIMIT :chunkSize"
    ids = lambda s, c, **k: [r[0] for r in st.run_statement(spark, s, c, **k).collect()]
    keyed = Statement("p", sql, chunk_size=2)
    assert sorted(ids(keyed, "9")) == [10, 11, 12]
    plan = st.run_statement(spark, keyed, "9")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan
    # an order inside parentheses belongs to the statement
    inner = Statement("p", "SELECT id, row_number() OVER (ORDER BY id) AS n FROM people WHERE id > ? LIMIT :chunkSize")
    assert [r.n for r in st.run_statement(spark, inner, "9").orderBy("id").collect()] == [1, 2, 3]
    assert ids(keyed, "9", one_chunk=True) == [10, 11]
    assert sorted(ids(keyed, "")) == [2, 9, 10, 11, 12]
    plain = Statement("p", "SELECT * FROM people", chunk_size=2)
    assert sorted(ids(plain, "10")) == [11, 12]
    assert ids(plain, "9", one_chunk=True) == [10, 11]
    once = Statement("p", "SELECT * FROM people ORDER BY id LIMIT :chunkSize", incremental=False, chunk_size=3)
    assert ids(once, "100") == [2, 9, 10]
    text = Statement("t", "SELECT name FROM people WHERE name > ?", id_column="NAME", id_type="string")
    assert sorted(ids(text, "n12")) == ["n2", "n9"] and len(ids(text, None)) == 5


def test_next_cursor_compares_by_type(spark, people):
    assert tuple(st.next_cursor(people, "ID").first()) == (12, 5, True)
    assert tuple(st.next_cursor(people, "name", False).first()) == ("n9", 5, True)
    none = spark.createDataFrame([(None,), ("x",)], "k string")
    assert tuple(st.next_cursor(none, "k").first()) == (None, 2, False)


def test_state(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.cursor_of(spark, path, "a") == "0" and state.cursor_of(spark, path, "b", False) == ""
    assert state.clear(spark, path) == 0
    state.save(spark, path, {"a": "7", "b": "k-1"})
    state.save(spark, path, {"a": "10"})
    assert state.cursor_of(spark, path, "a") == "10" and state.cursor_of(spark, path, "b") == "k-1"
    ids = {r.statement_name: r.last_id for r in state.current(state.read(spark, path)).collect()}
    assert ids == {"a": 10, "b": 0}
    assert state.clear(spark, path) == 2 and state.cursor_of(spark, path, "a") == "0"
    state.save(spark, path, {"a": "3"})
    assert state.cursor_of(spark, path, "a") == "3" and state.clear(spark, path) == 1


def test_state_saved_as_number_only(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.sql("SELECT 'a' statement_name, 42L last_id, CAST(NULL AS STRING) cursor_value, "
              "TIMESTAMP '2020-01-01' updated_at, 1L version").write.parquet(path)  # fmt: skip
    assert state.cursor_of(spark, path, "a") == "42"


def test_sync_once(spark, tmp_path, people):
    target = str(tmp_path / "out")
    specs = [
        Statement("people", "SELECT * FROM people WHERE id > ?", "People!"),
        Statement("names", "SELECT name AS k FROM people", id_column="k", id_type="string"),
        Statement("broken", "SELECT * FROM no_such_table"),
        Statement("off", "SELECT 1 AS id", enabled=False),
    ]
    report = {r.statement: r for r in sync.sync_once(spark, specs, target, "t1").collect()}
    assert report["people"].rows == 5 and report["people"].next_cursor == "12"
    assert report["names"].next_cursor == "n9" and "no_such_table" in report["broken"].error
    assert "off" not in report
    spark.createDataFrame([(12, "again"), (40, "n40")], "ID long, name string").createOrReplaceTempView("people")
    report = {r.statement: r for r in sync.sync_once(spark, specs, target, "t2").collect()}
    assert report["people"].rows == 1 and report["people"].next_cursor == "40"
    # the same run again finds nothing new and changes nothing
    before = rows(sync.read_index(spark, target, "people_").select("_id", "ID", "name"))
    sync.sync_once(spark, specs, target, "t3")
    assert rows(sync.read_index(spark, target, "people_").select("_id", "ID", "name")) == before
    assert len(before) == 6 and before[0] == ("people_10", 10, "n10")
    docs = sync.read_documents(spark, target)
    assert {r[0] for r in D.list_indices(docs).collect()} == {"people_", "names"}
    assert sync.distinct_statements(specs + specs) == ["people", "names", "broken", "off"]


def test_failed_statement_keeps_its_cursor(spark, tmp_path, people):
    target = str(tmp_path / "out")
    good = Statement("p", "SELECT * FROM people WHERE id > ?")
    bad = Statement("p", "SELECT raise_error('no') AS id FROM people WHERE id > ?")
    sync.sync_once(spark, [good], target, "t1")
    spark.range(50, 60).withColumnRenamed("id", "ID").createOrReplaceTempView("people")
    failed = sync.sync_once(spark, [bad], target, "t2").first()
    assert failed.error and state.cursor_of(spark, f"{target}/state", "p") == "12"


def test_repeats_and_alike_names_lose_nothing(spark, tmp_path, people):
    target = str(tmp_path / "out")
    specs = [Statement(n, f"SELECT ID, '{n}' AS n FROM people WHERE id > ?", "all") for n in ("a b", "a_b", "é", "ü")]
    for _ in range(2):
        sync.sync_once(spark, specs, target, "t1")
    found = rows(sync.read_index(spark, target, "all").groupBy("n").count())
    assert found == [("a b", 5), ("a_b", 5), ("é", 5), ("ü", 5)]


def test_first_run_takes_all_keys_and_bad_keys_are_reported(spark, tmp_path):
    target = str(tmp_path / "out")
    spark.createDataFrame([("-5",), ("0",), ("7",)], "id string").createOrReplaceTempView("keys")
    specs = [Statement("k", "SELECT id FROM keys"), Statement("b", "SELECT CAST(id AS BIGINT) AS id FROM keys WHERE id > ?")]
    assert [r.rows for r in sync.sync_once(spark, specs, target, "t1").collect()] == [3, 3]
    spark.createDataFrame([("9",), ("x9",)], "id string").createOrReplaceTempView("keys")
    failed = sync.sync_once(spark, specs[:1], target, "t2").first()
    assert "not a whole number" in failed.error and state.saved_cursor(spark, f"{target}/state", "k") == "7"


def test_time_keys_compare_as_times(spark, tmp_path):
    target = str(tmp_path / "out")
    spec = Statement("t", "SELECT at FROM times WHERE at > ?", id_column="at")
    unbound = Statement("u", "SELECT at FROM times", id_column="at", id_type="text")
    for texts, n in ((["2024-01-01 08:00:00"], 1), (["2024-01-01 08:00:00", "2024-01-01 23:00:00.000001"], 1)):
        spark.createDataFrame([(t,) for t in texts], "s string").selectExpr("cast(s as timestamp) at").createOrReplaceTempView("times")
        assert [r.rows for r in sync.sync_once(spark, [spec, unbound], target, f"t{texts}").collect()] == [n, n]
    assert state.saved_cursor(spark, f"{target}/state", "t") == "2024-01-01T23:00:00.000001Z"


def test_literal_limit_of_a_chunk_does_not_end_the_read(spark, people):
    read = lambda sql, n: st.run_statement(spark, Statement("p", sql, chunk_size=n)).count()
    assert read("SELECT * FROM people WHERE id > ? ORDER BY id LIMIT 2", 2) == 5
    assert read("SELECT * FROM people WHERE id > ? ORDER BY id LIMIT 3", 2) == 3


def test_group(spark, tmp_path, people):
    target = str(tmp_path / "out")
    spec = Statement("p", "SELECT * FROM people WHERE id > ?")
    sync.sync_group(spark, "night jobs", [spec], target, "t1")
    assert state.cursor_of(spark, f"{target}/state", "night_jobs__p") == "12"
    docs = sync.read_documents(spark, target)
    ids = docs.select(D.strip_prefix(F.col("_id"), ["p", "night_jobs__p"]).alias("i"))
    assert sorted(r.i for r in ids.collect()) == ["10", "11", "12", "2", "9"]


def test_documents(spark):
    df = spark.sql("SELECT 1 AS Id, TIMESTAMP '2020-01-01 00:00:00.5' AS at, DATE '2020-02-03' AS day, 'x' AS s"
                   " UNION ALL SELECT NULL, NULL, NULL, 'y'")  # fmt: skip
    got = {r.s: r for r in D.documents(df, "Q", "now", "ID", "_My Index", "sch", "tab").collect()}
    one = got["x"]
    assert (one._index, one._id, one.at, one.day) == ("idx_my_index", "Q_1", "2020-01-01T00:00:00.500Z", "2020-02-03")
    assert (one._query, one._sync_timestamp, one._schema, one._table) == ("Q", "now", "sch", "tab")
    # without an id the content decides, whatever the column order
    ids = [D.documents(df.select(*c), "Q", "now", None).filter("s = 'y'").first()._id
           for c in (["s", "day"], ["day", "s"])]
    assert ids[0] == ids[1] and len(ids[0]) == 66
    assert D.text_fields(df.withColumn("k", F.lit("t")), "K") == ["s"]
    assert D.map_identifiers(df, "users", {"USERS": "ACCOUNTS"})[0] == '"PUBLIC"."ACCOUNTS"'
    assert D.map_identifiers(df, "app.logs")[0] == '"APP"."LOGS"'


def test_snapshots_and_counts(spark, people):
    events = snapshot_scan({"people": people}, 5)["people"]
    assert events.filter("op = 'r' AND before IS NULL AND after.ID = 9").count() == 1
    counts = row_counts({"a": people, "b": spark.range(9).toDF("x"), "c": people})
    assert [tuple(r) for r in counts.collect()] == [("public", "b", 9), ("public", "a", 5), ("public", "c", 5)]
    text = spark.createDataFrame([("1", "$2.50", "7")], "i string, m string, z string")
    clean = clean_columns(text, {"i": "int4", "m": "money"}, converters={"z": lambda c: c.cast("int") + 1})
    assert [str(v) for v in clean.first()] == ["1", "2.50", "8"]
    with pytest.raises(Exception, match="cannot read i"):
        clean_columns(text.withColumn("i", F.lit("x")), {"i": "int4"}, strict=True).collect()


def test_snapshot_modes():
    flags = lambda m, s: (plan(m, s).snapshot, plan(m, s).stream)
    assert [flags("initial", s) for s in (NONE, UNFINISHED, FINISHED)] == [(True, True), (True, True), (False, True)]
    assert [flags("always", s) for s in (NONE, UNFINISHED, FINISHED)] == [(True, True)] * 3
    assert [flags("initial_only", s) for s in (NONE, FINISHED)] == [(True, False), (False, False)]
    assert [flags("never", s) for s in (NONE, FINISHED)] == [(False, True)] * 2
    assert plan("exported").at_log_start and not plan("exported", FINISHED).snapshot
    with pytest.raises(ValueError):
        plan("never", UNFINISHED)
    with pytest.raises(ValueError):
        plan("sometimes")
    assert plan("custom", NONE, lambda saved: Plan(False, False)).snapshot is False

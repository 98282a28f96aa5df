"""Decoding, filters, event shapes, positions, transactions."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import lsn as L
from tidemark.operators import changes as C
from tidemark.operators import positions as P
from tidemark.operators import transactions as T
from tidemark.sources.changes import LOG_SCHEMA, decode_changes, read_changes, supported, table_changes


def datum(name, **tags):
    return {"column_name": name, "column_type": 1, **tags}


def raw(spark, *messages):
    names = LOG_SCHEMA.names
    defaults = {"lsn": 1, "transaction_id": -1, "commit_time": 1000000, "table": "t"}
    full = [{**dict.fromkeys(names), **defaults, "seq": i, **m} for i, m in enumerate(messages)]
    return spark.createDataFrame(full, LOG_SCHEMA)


COLUMNS = {"id": "int8", "b": "bool", "amount": "money", "doc": "text", "at": "timestamptz", "tags": "int4[]"}


def test_decode(spark):
    new = [datum('"id"', datum_int64=5), datum("b", datum_string="T"), datum("amount", datum_int64=250),
           datum("doc", datum_missing=True), datum("at", datum_int64=9223371331200000000),
           datum("tags", datum_bytes=b"{1,NULL,3}"), datum("extra", datum_string="not in the table")]
    log = raw(
        spark,
        {"op": 0, "new_tuple": new, "table": '"App"."T"'},
        {"op": 1, "new_tuple": new, "old_tuple": [datum("id", datum_int64=4), datum("doc", datum_string="old")]},
        {"op": 2, "old_tuple": [datum("id", datum_int64=5)]},
        {"op": 1, "new_tuple": []},
        {"op": -1},
        {"op": 3},
    )
    out = decode_changes(supported(log), COLUMNS).orderBy("seq").collect()
    assert [r.op for r in out] == ["c", "u", "d", "begin"]
    one = out[0]
    assert (one.schema, one.table, one.txid, str(one.commit_ts)) == ("App", "T", 4294967295, "1970-01-01 00:00:01")
    assert (one.after.id, one.after.b, str(one.after.amount), one.after.at) == (5, True, "2.50", "infinity")
    assert one.after.tags == [1, None, 3] and one.after.doc is None and one._unchanged == ["doc"]
    assert out[1].after.doc == "old" and out[1]._unchanged == [] and out[1].before.id == 4
    assert out[2].after is None and out[2].before.id == 5
    keyed = table_changes(decode_changes(supported(log), COLUMNS), ["id"]).orderBy("seq").collect()
    # the update gives row 4 the key 5: row 4 goes, row 5 is whole
    assert sorted((r.seq, r.op, r.id) for r in keyed[:4]) == [
        (keyed[0].seq, "c", 5), (keyed[1].seq, "c", 5), (keyed[1].seq, "d", 4), (keyed[3].seq, "d", 5)
    ]
    assert keyed[3]._unchanged == []


def test_decode_undelivered_and_strict(spark):
    log = raw(spark, {"op": 0, "new_tuple": [datum("id", datum_int64=5)]})
    r = decode_changes(log, {"id": "int8", "doc": "text"}, undelivered=("doc",)).first()
    assert r._unchanged == ["doc"]
    bad = raw(spark, {"op": 0, "new_tuple": [datum("id", datum_string="five")]})
    with pytest.raises(Exception, match="cannot read id: five"):
        decode_changes(bad, {"id": "int8"}).collect()
    assert decode_changes(bad, {"id": "int8"}, strict=False).first().after.id is None
    unknown = raw(spark, {"op": 0, "new_tuple": [datum("x", datum_bytes=b"ab")]})
    assert decode_changes(unknown, {"x": "unknown"}).first().after.x is None
    kept = decode_changes(unknown, {"x": "unknown"}, {"include_unknown": True}).first()
    assert bytes(kept.after.x) == b"ab"


def test_decode_needs_no_shuffle(spark):
    plan = decode_changes(raw(spark, {"op": 3}), COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_read_changes(spark, tmp_path):
    raw(spark, {"op": 0, "new_tuple": [datum("id", datum_int64=1)]}).write.json(str(tmp_path / "log"))
    df = read_changes(spark, str(tmp_path / "log"), fmt="json")
    assert df.schema == LOG_SCHEMA and df.first().new_tuple[0].datum_int64 == 1
    assert read_changes(spark, str(tmp_path / "log"), streaming=True, fmt="json").isStreaming


def test_capture_filter(spark):
    names = [("public", "users"), ("public", "logs"), ("app", "users"), ("pg_catalog", "x"),
             ("SYS_CATALOG", "x"), ("information_schema", "x"), ("s", "pg_temp_1")]
    df = spark.createDataFrame(names, "schema string, table string")

    def kept(**lists):
        return {tuple(r) for r in C.captured_tables(df, **lists).collect()}

    assert kept() == {("public", "users"), ("public", "logs"), ("app", "users")}
    assert kept(include_tables=r"public\.users, app\..*") == {("public", "users"), ("app", "users")}
    assert kept(exclude_tables=r".*\.LOGS") == {("public", "users"), ("app", "users")}
    assert kept(include_schemas="app") == {("app", "users")}
    assert kept(exclude_schemas="app") == {("public", "users"), ("public", "logs")}
    # an expression must match in full, and an include list decides alone
    assert kept(include_tables=r"public\.user") == set()
    assert kept(include_tables=r"public\..*", exclude_tables=".*") == {("public", "users"), ("public", "logs")}


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a-b` int, `1x` int, ok int")
    assert C.sanitise_names(df).columns == ["a_b", "_1x", "ok"]
    assert C.select_columns(df, "s.t", include=r"s\.t\.(ok|1x)").columns == ["1x", "ok"]
    assert C.select_columns(df, "s.t", exclude=r".*\.ok").columns == ["a-b", "1x"]
    assert C.message_key(df, ["ok"]).select("_key.ok").first()[0] == 3


def test_envelope_and_metadata(spark):
    df = spark.sql("SELECT explode(array('c','u','d','t','r')) AS op, 10L AS lsn, 7L AS txid, "
                   "TIMESTAMP '2020-01-01 00:00:00.001002' AS ts")  # fmt: skip
    src = C.source_info("srv", "db", F.lit("s"), F.lit("t"), F.col("txid"), F.col("lsn"), F.col("ts"))
    row = F.struct(F.lit(1).alias("x"))
    got = {r.e.op: r for r in df.select(C.envelope(F.col("op"), row, row, src).alias("e"), src.alias("s")).collect()}
    shown = {k: (r.e.before is not None, r.e.after is not None) for k, r in got.items()}
    assert shown == {"c": (False, True), "u": (True, True), "d": (True, False), "t": (False, False), "r": (False, True)}
    assert json.loads(got["c"].s.sequence) == [None, "10"] and got["c"].e.ts_ms == 1577836800001
    meta = df.limit(1).select(C.event_position(src).alias("p"), C.event_transaction(src).alias("t"),
                              F.unix_micros(C.event_time(src)).alias("at")).first()
    assert meta.p == {"lsn": "10"} and meta.t == "7" and meta.at == 1577836800001002


def test_truncate_mode(spark):
    df = spark.createDataFrame([("t",), ("c",)], "op string")
    assert rows(C.skip_truncates(df)) == [("c",)] and C.skip_truncates(df, "include").count() == 2
    with pytest.raises(ValueError):
        C.skip_truncates(df, "drop")


# ---- positions ----------------------------------------------------------------------


def locate(log, commit, event):
    """Row by row: where reading starts again."""
    first = begin = None
    seen = False
    for lsn, op in log:
        first = lsn if first is None else first
        if seen:
            if lsn == event:
                continue
            return lsn
        seen = seen or lsn == event
        if commit is None:
            return first
        if op == "begin":
            begin = lsn
        if op == "commit" and lsn % 2**64 > commit % 2**64:
            return first if begin is None else begin
    return None


def random_log(rng):
    out, lsn = [], rng.choice([100, 2**63 - 40])
    for _ in range(6):
        body = [(lsn, "begin"), (lsn, "c")]
        for _ in range(rng.randrange(3)):
            lsn += 8
            body.append((lsn, "u"))
        body.append((lsn + 4, "commit"))
        lsn += 16
        out += body if rng.random() < 0.9 else body[1:]
    signed = [((n + 2**63) % 2**64 - 2**63, op) for n, op in out]
    return signed[rng.randrange(3) :]


def test_resume_point(spark):
    rng = random.Random(4)
    for _ in range(12):
        log = random_log(rng)
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(log)], "seq long, lsn long, op string")
        commit = rng.choice([None, log[3][0], log[len(log) // 2][0]])
        event = rng.choice([None, 7, log[rng.randrange(len(log))][0]])
        got = P.resume_point(df, commit, event).first()[0]
        assert got == locate(log, commit, event), (log, commit, event)


def test_resume_and_stop(spark):
    df = spark.createDataFrame([(0, 10), (1, 10), (2, 20), (3, 30), (4, 30), (5, -5)], "seq long, lsn long")
    seqs = lambda d: [r[0] for r in rows(d)]
    assert seqs(P.resume_from(df, None)) == [0, 1, 2, 3, 4, 5]
    assert seqs(P.resume_from(df, 20)) == [2, 3, 4, 5]
    assert seqs(P.resume_from(df, 15)) == []
    assert seqs(P.stop_at(df, 30)) == [0, 1, 2, 3]
    assert seqs(P.stop_at(df, 31)) == [0, 1, 2, 3, 4, 5]
    assert seqs(P.stop_at(df, -2)) == seqs(P.stop_at(df, None)) == [0, 1, 2, 3, 4, 5]
    assert seqs(P.keep_after(df, 20)) == [3, 4, 5]
    order = [r.lsn for r in df.orderBy(L.rank(F.col("lsn"))).collect()]
    assert order[-1] == -5


def test_transactions(spark):
    df = spark.createDataFrame(
        [(1, 10, 1, "a", "c"), (2, 20, 1, "b", "u"), (3, 30, 1, "a", "d"), (4, 40, 2, "a", "c")],
        "seq long, lsn long, txid long, table string, op string",
    )
    assert rows(T.tx_summary(df)) == [(1, 10, 30, 3), (2, 40, 40, 1)]
    assert rows(T.tx_table_summary(df)) == [(1, "a", 2), (1, "b", 1), (2, "a", 1)]
    order = rows(T.tx_order(df, slices=2).select("seq", "total_order", "table_order"))
    assert order == [(1, 1, 1), (2, 2, 1), (3, 3, 2), (4, 1, 1)]
    marks = rows(T.mark_last_snapshot_row(df.select("seq"), "seq"))
    assert marks == [(1, "true"), (2, "true"), (3, "true"), (4, "last")]

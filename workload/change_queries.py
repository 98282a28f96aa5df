"""Change capture on a log made of the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import lsn as L
from tidemark.functions import values as V
from tidemark.operators import changes as C
from tidemark.operators import merge as M
from tidemark.operators import positions as P
from tidemark.operators import sinks as S
from tidemark.operators import transactions as T
from tidemark.plans.keyed_table import KeyedTable
from tidemark.plans.snapshot_modes import Plan
from tidemark.session import shared_dir
from tidemark.sources.changes import decode_changes, supported, table_changes
from tidemark.sources.log_source import stream_log
from tidemark.streaming import apply as stream
from workload.fixtures import CHANGES, LOG, changes, load, log, raw_log
from workload.sync_queries import ISO

QUERIES = {}
SQL = {}
VALUES = ["event_type", "value", "lsn", "props"]


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


CHG = f"WITH chg AS ({CHANGES})"
APPLY = CHG + """,
s AS (
  SELECT *, sum(CASE WHEN op = 'c' THEN 1 ELSE 0 END) OVER
              (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          + coalesce(sum(CASE WHEN op = 'd' THEN 1 ELSE 0 END) OVER
              (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS span
  FROM chg),
l AS (SELECT *, max(span) OVER (PARTITION BY key) AS last_span FROM s),
g AS (
  SELECT key, max_by(op, seq) AS op, max_by(event_type, seq) AS event_type,
         max_by(value, seq) AS value, max(lsn) AS lsn,
         coalesce(max_by(CASE WHEN props_unchanged THEN NULL ELSE props END,
                         CASE WHEN props_unchanged THEN NULL ELSE seq END), '__unavailable_value') AS props
  FROM l WHERE span = last_span GROUP BY key)
SELECT key, event_type, value, lsn, props FROM g WHERE op <> 'd'
"""


@query(APPLY)
def apply_changes(spark, sf):
    return M.apply_changes(None, changes(spark, sf), ["key"], VALUES, "seq", ["props"])


@query(APPLY)
def snapshot_handover(spark, sf):
    """The table as of the middle of the log, then the changes behind that position."""
    chg = changes(spark, sf)
    middle = chg.agg(F.expr("min(lsn) + (max(lsn) - min(lsn)) div 2")).first()[0]
    head = chg.filter(F.col("lsn") <= middle)
    snapshot = M.apply_changes(None, head, ["key"], VALUES, "seq", ["props"])
    ranked = chg.withColumn("place", L.rank(F.col("lsn")))
    start = spark.range(1).select(L.rank(F.lit(middle))).first()[0]
    return M.hand_over(snapshot, start, ranked, ["key"], VALUES, "place", ["props"])


@query(CHG + """, t AS (SELECT max(seq) AS s FROM chg WHERE op = 'c')
SELECT key, max_by(event_type, seq) AS event_type, max_by(value, seq) AS value
FROM chg, t WHERE seq > t.s GROUP BY key""")
def apply_truncate(spark, sf):
    """The last create stands for a truncate of the table: only later rows remain."""
    chg = changes(spark, sf)
    last = chg.filter("op = 'c'").agg(F.max("seq")).scalar()
    op = F.when(F.col("seq") == last, "t").otherwise("u")
    target = M.apply_changes(
        None, chg.withColumn("op", F.lit("u")), ["key"], ["event_type", "value"], "seq", []
    )
    return M.apply_changes(
        target, chg.withColumn("op", op), ["key"], ["event_type", "value"], "seq", [],
        truncates=True,
    )


@query(CHG + """
SELECT key, seq, op, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM chg) WHERE rn = 1""")
def last_change(spark, sf):
    rows = changes(spark, sf).select("key", "seq", "op", "event_type", "value")
    return M.last_change(rows, ["key"], "seq")


@query(CHG + """
SELECT txid, min(lsn) AS first_lsn, max(lsn) AS last_lsn, count(*) AS event_count FROM chg GROUP BY txid""")
def tx_summary(spark, sf):
    return T.tx_summary(changes(spark, sf))


@query(CHG + """SELECT txid, "table", count(*) AS event_count FROM chg GROUP BY ALL""")
def tx_tables(spark, sf):
    return T.tx_table_summary(changes(spark, sf))


@query(CHG + """
SELECT seq, txid, "table", row_number() OVER (PARTITION BY txid ORDER BY seq) AS total_order,
       row_number() OVER (PARTITION BY txid, "table" ORDER BY seq) AS table_order FROM chg""")
def tx_order(spark, sf):
    return T.tx_order(changes(spark, sf))


@query(f"""WITH log AS ({LOG})
SELECT seq, lsn, CAST(txid AS VARCHAR) AS id, CASE op WHEN 'begin' THEN 'BEGIN' ELSE 'END' END AS status
FROM log WHERE op IN ('begin', 'commit')""")
def tx_markers(spark, sf):
    return T.tx_markers(log(spark, sf)).select("seq", "lsn", "id", "status")


SEQUENCE = f"""WITH log AS ({LOG}),
m AS (SELECT *, max(CASE WHEN op = 'commit' THEN lsn END) OVER
        (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_commit_lsn FROM log)
"""


@query(SEQUENCE + """
SELECT seq, lsn, txid, op, last_commit_lsn FROM m WHERE op NOT IN ('begin', 'commit')""")
def commit_sequence(spark, sf):
    return T.commit_sequence(log(spark, sf))


@query(SEQUENCE + """
SELECT seq, '[' || coalesce('"' || last_commit_lsn || '"', 'null') || ',"' || lsn || '"]' AS sequence,
       upper(printf('%x/%x', lsn // 4294967296, lsn % 4294967296)) AS position
FROM m WHERE op NOT IN ('begin', 'commit')""")
def source_sequence(spark, sf):
    seq = T.commit_sequence(log(spark, sf))
    return seq.select(
        "seq",
        C.sequence_text(F.col("last_commit_lsn"), F.col("lsn")).alias("sequence"),
        L.text(F.col("lsn")).alias("position"),
    )


@query(CHG + """
SELECT seq, op, CASE WHEN op IN ('c', 'u') THEN event_type END AS after_type,
  CASE WHEN op IN ('u', 'd') THEN event_type END AS before_type,
  'public' AS "schema", "table", lsn, CAST(txid AS VARCHAR) AS tx, CAST(lsn AS VARCHAR) AS position,
  CAST(epoch_us(commit_ts) // 1000 AS BIGINT) AS ts_ms, """ + ISO.format(c="commit_ts") + """ AS at
FROM chg""")
def envelopes(spark, sf):
    chg = changes(spark, sf)
    source = C.source_info(
        "srv", "db", F.col("schema"), F.col("table"), F.col("txid"), F.col("lsn"), F.col("commit_ts")
    )
    row = F.struct("event_type", "value")
    events = chg.select("seq", C.envelope(F.col("op"), row, row, source).alias("e"))
    src = F.col("e.source")
    return events.select(
        "seq",
        "e.op",
        F.col("e.after.event_type").alias("after_type"),
        F.col("e.before.event_type").alias("before_type"),
        src["schema"].alias("schema"),
        src["table"].alias("table"),
        src["lsn"].alias("lsn"),
        C.event_transaction(src).alias("tx"),
        C.event_position(src)["lsn"].alias("position"),
        F.col("e.ts_ms"),
        V.iso_instant(C.event_time(src)).alias("at"),
    )


@query(CHG + """
SELECT "table", op, count(*) AS n FROM chg WHERE "table" = 'visits' GROUP BY ALL""")
def captured_changes(spark, sf):
    keep = C.captured(F.col("schema"), F.col("table"), include_tables="public\\.vis.*,other\\..*")
    return changes(spark, sf).filter(keep).groupBy("table", "op").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT DISTINCT 'public' AS "schema", event_type AS "table" FROM events WHERE event_type NOT IN ('error', 'click')""")
def captured_tables(spark, sf):
    """Events name tables here; some lie in a system schema, some are on the exclude list."""
    kind = F.col("event_type")
    tables = load(spark, sf, "events").select(
        F.when(kind == "click", "PG_CATALOG").otherwise("public").alias("schema"),
        kind.alias("table"),
    )
    return C.captured_tables(tables, exclude_tables="public\\.ERR.*")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus,
       l_orderkey || '-' || l_linenumber AS "key" FROM lineitem""")
def selected_columns(spark, sf):
    lines = C.select_columns(
        load(spark, sf, "lineitem"), "public.lineitem",
        exclude="public\\.lineitem\\.l_(tax|discount|extendedprice),.*shipdate",
    )
    keyed = C.message_key(lines, ["l_orderkey", "l_linenumber"])
    named = C.sanitise_names(keyed.withColumnRenamed("l_quantity", "l-quantity"))
    text = F.concat_ws("-", F.col("_key.l_orderkey"), F.col("_key.l_linenumber"))
    return named.withColumn("key", text).drop("_key")


@query(CHG + """
SELECT 'srv.public.' || "table" AS topic, count(*) AS n FROM chg GROUP BY ALL""")
def topics(spark, sf):
    name = S.topic("srv", F.col("schema"), F.col("table"))
    return changes(spark, sf).groupBy(name.alias("topic")).agg(F.count(F.lit(1)).alias("n"))


# ---- positions ----------------------------------------------------------------------


@query(f"""WITH log AS ({LOG}), n AS (SELECT max(event_id) // 3 AS k FROM events)
SELECT min_by(lsn, seq) AS resume_lsn FROM log, n
WHERE seq > (SELECT min(seq) FROM log, n WHERE lsn = 16777216 + k * 64) AND lsn <> 16777216 + k * 64""")
def resume_after_event(spark, sf):
    """The saved event is in the log: go on with the row behind it."""
    third = load(spark, sf, "events").agg(F.expr("max(event_id) div 3")).first()[0]
    event = 16777216 + third * 64
    # a saved commit that no COMMIT row passes, so that the event decides
    return P.resume_point(log(spark, sf), 2**62, event)


@query(f"""WITH log AS ({LOG}), n AS (SELECT 16777216 + (max(event_id) // 2) * 64 AS k FROM events),
c AS (SELECT min(seq) AS s FROM log, n WHERE op = 'commit' AND lsn > k)
SELECT max_by(lsn, seq) AS resume_lsn FROM log, c WHERE op = 'begin' AND seq <= s""")
def resume_after_commit(spark, sf):
    """The saved event is gone: go back to the start of the first unfinished transaction."""
    half = load(spark, sf, "events").agg(F.expr("max(event_id) div 2")).first()[0]
    return P.resume_point(log(spark, sf), 16777216 + half * 64, 7)


@query(f"""WITH log AS ({LOG}), n AS (SELECT 16777216 + (max(event_id) // 2) * 64 AS k FROM events)
SELECT log.* FROM log WHERE seq >= (SELECT min(seq) FROM log, n WHERE lsn = k)
  AND seq <= (SELECT min(seq) FROM log, n WHERE lsn >= k + 8192)""")
def resumed_window(spark, sf):
    """From the first row at a position to the first that reaches another."""
    half = load(spark, sf, "events").agg(F.expr("max(event_id) div 2")).first()[0]
    start = 16777216 + half * 64
    rows = log(spark, sf)
    return P.stop_at(P.resume_from(rows, start), start + 8192)


@query(f"""WITH log AS ({LOG}),
f AS (SELECT seq, op = 'd' AS e FROM log),
g AS (SELECT *, max(CASE WHEN e THEN seq END) OVER
        (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a FROM f)
SELECT min(seq) AS run_start, max(seq) AS run_end, count(*) AS run_length,
       CAST(count(*) // 21 AS BIGINT) AS warnings FROM g WHERE NOT e GROUP BY a""")
def backlog_runs(spark, sf):
    """COMMIT and BEGIN rows count as filtered, as do all changes but deletes."""
    return T.backlog_runs(log(spark, sf), F.col("op") == "d", limit=20)


@query("""
SELECT c_custkey, CASE WHEN c_custkey = (SELECT max(c_custkey) FROM customer) THEN 'last' ELSE 'true' END AS snapshot
FROM customer""")
def last_snapshot_row(spark, sf):
    return T.mark_last_snapshot_row(load(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query("""
SELECT o_orderkey, printf('%X/%X', v >> 32, v & 4294967295) AS text, v AS parsed, true AS valid FROM (
  SELECT o_orderkey, (CAST(o_custkey AS BIGINT) << 32) + o_orderkey * 977 + 1 AS v FROM orders)""")
def lsn_text(spark, sf):
    value = F.shiftleft(F.col("o_custkey"), 32) + F.col("o_orderkey") * 977 + 1
    rows = load(spark, sf, "orders").select("o_orderkey", L.text(value).alias("text"))
    parsed = L.parse(F.col("text"))
    return rows.withColumns({"parsed": parsed, "valid": L.is_valid(parsed)})


# ---- decoding -----------------------------------------------------------------------

COLUMNS = {
    "user_id": "bigint", "event_type": "character varying", "value": "double precision",
    "seen_at": "timestamp without time zone", "props": "jsonb",
}


@query(f"""
SELECT event_id AS seq, 500 + CAST(floor(event_id / 5.0) AS BIGINT) AS txid,
  CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  'public' AS "schema", 'events' AS "table",
  CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN value END AS value,
  CASE WHEN event_type <> 'error' THEN {ISO.format(c='ts')} END AS seen_at,
  CASE WHEN event_type = 'error' OR (event_type = 'click' AND user_id % 3 <> 0) THEN NULL ELSE props END AS props,
  CASE WHEN event_type <> 'signup' THEN user_id END AS old_user,
  CASE WHEN event_type = 'click' AND user_id % 3 <> 0 THEN 'props' WHEN event_type <> 'error' THEN '' END AS unchanged
FROM events""")
def decode_changes_typed(spark, sf):
    rows = decode_changes(supported(raw_log(spark, sf)), COLUMNS)
    after = F.col("after")
    return rows.select(
        "seq", "txid", "op", "schema", "table",
        *[after[c].alias(c) for c in ("user_id", "event_type", "value", "props")],
        V.iso_instant(after["seen_at"]).alias("seen_at"),
        F.col("before.user_id").alias("old_user"),
        F.array_join("_unchanged", ",").alias("unchanged"),
    )


@query(APPLY.replace(
    "WHEN event_type = 'click' THEN NULL ELSE props END AS props",
    "WHEN event_type = 'click' AND user_id % 3 <> 0 THEN NULL ELSE props END AS props",
).replace(
    "(event_type = 'click') AS props_unchanged",
    "(event_type = 'click' AND user_id % 3 <> 0) AS props_unchanged",
).replace("SELECT key, event_type, value, lsn, props FROM g", "SELECT key, event_type, value, props FROM g"))
def decode_and_apply(spark, sf):
    decoded = decode_changes(supported(raw_log(spark, sf)), COLUMNS)
    rows = table_changes(decoded, ["user_id"]).withColumnRenamed("user_id", "key")
    return M.apply_changes(None, rows, ["key"], ["event_type", "value", "props"], "seq", ["props"])


#: what the definition says, and the columns that new rows carry: their types are those of the table
DRIFT = """
WITH known("column", type, large) AS (VALUES ('user_id', 20, false), ('event_type', 1043, false), ('value', 700, false),
  ('props', 3802, true), ('note', 25, false), ('extra', 25, true)),
named AS (SELECT CASE column_name WHEN 'ts' THEN 'seen_at' ELSE column_name END AS "column",
    CASE WHEN column_name = 'props' THEN 3802 ELSE CASE column_type WHEN 'BIGINT' THEN 20 WHEN 'VARCHAR' THEN 1043 WHEN 'DOUBLE' THEN 701
      ELSE 1114 END END AS type
  FROM (DESCRIBE events) WHERE column_name <> 'event_id'),
seen AS (SELECT * FROM named WHERE EXISTS (SELECT 1 FROM events WHERE event_type <> 'error'))
SELECT '"public"."events"' AS "table", coalesce(k."column", s."column") AS "column",
       CASE WHEN k.type IS NULL THEN 'added' WHEN s.type IS NULL THEN 'missing' ELSE 'type' END AS difference
FROM known k FULL JOIN seen s ON k."column" = s."column"
WHERE k.type IS DISTINCT FROM s.type AND NOT (s.type IS NULL AND k.large)"""


@query(DRIFT)
def schema_drift(spark, sf):
    """Columns seen in the log against a table definition that is out of date."""
    seen = M.observed_columns(raw_log(spark, sf)).select(
        "table", V.identifier(F.col("column")).alias("column"), "type",
        F.lit(None).cast("long").alias("root_type"), F.lit(0).alias("length"),
        F.lit(0).alias("scale"), "nullable",
    )
    known = spark.createDataFrame(
        [("user_id", 20, False), ("event_type", 1043, False), ("value", 700, False),
         ("props", 3802, True), ("note", 25, False), ("extra", 25, True)],
        "column string, type long, large boolean",
    ).select(
        F.lit('"public"."events"').alias("table"), "column", "type", F.lit(0).alias("length"),
        F.lit(0).alias("scale"), F.lit(True).alias("nullable"), "large",
    )
    return M.schema_drift(known, seen, ignore_missing_large=True)


# ---- streaming ----------------------------------------------------------------------


def _stream(spark, sf):
    schema = load(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _event_changes(rows):
    kind = F.col("event_type")
    return rows.select(
        F.col("event_id").alias("seq"),
        (F.lit(16777216) + F.col("event_id") * 64).alias("lsn"),
        (F.lit(500) + F.floor(F.col("event_id") / 5.0)).cast("long").alias("txid"),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        F.col("user_id").alias("key"),
        kind,
        "value",
        F.when(kind != "click", F.col("props")).alias("props"),
        F.when(kind == "click", F.array(F.lit("props")))
        .otherwise(F.array().cast("array<string>"))
        .alias("_unchanged"),
    )


def _streamed_table(spark, sf):
    root = f"{shared_dir(spark)}/tidemark/stream-{uuid.uuid4().hex}"
    table = KeyedTable(
        f"{root}/table", "key long, event_type string, value double, lsn long, props string",
        ("key",), ("props",),
    )
    stream.apply_stream(
        _event_changes(_stream(spark, sf)), table, f"{root}/checkpoint"
    ).awaitTermination()
    return table


@query(APPLY)
def stream_apply(spark, sf):
    """The change log as a stream, applied to a keyed table; the table is read back."""
    return _streamed_table(spark, sf).read(spark)


@query(CHG + """
SELECT CAST(0 AS BIGINT) AS batch, count(*) AS rows_in, count(DISTINCT key) AS rows_out, max(lsn) AS max_lsn
FROM chg""")
def stream_progress(spark, sf):
    return stream.progress(spark, _streamed_table(spark, sf))


class _Capture:
    """A table that is captured from the events: by snapshots as of a position, and by the stream."""

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf
        self.root = f"{shared_dir(spark)}/tidemark/capture-{uuid.uuid4().hex}"
        self.table = KeyedTable(
            f"{self.root}/table", "key long, event_type string, value double, lsn long, props string", ("key",), ("props",)
        )
        self.changes = changes(spark, sf)
        low, high = self.changes.agg(F.min("lsn"), F.max("lsn")).first()
        self.quarter, self.middle, self.end = low + (high - low) // 4, low + (high - low) // 2, high
        self.taken = []

    def snapshot(self, query, position):
        """The table as of a position, or what a query on it gives."""
        self.taken.append((query, position))
        rows = M.apply_changes(None, self.changes.filter(F.col("lsn") <= position), ["key"], VALUES, "seq", ["props"])
        if query is None:
            return rows
        rows.createOrReplaceTempView("captured")
        return self.spark.sql(query)

    def run(self, mode, at, checkpoint="checkpoint", **options):
        query = stream.capture(
            self.spark, mode, self.table, self.snapshot, at, lambda: _event_changes(_stream(self.spark, self.sf)),
            f"{self.root}/{checkpoint}", **options,
        )
        if query is not None:
            query.awaitTermination()
        return self.table.read(self.spark)


@query(APPLY)
def capture_initial(spark, sf):
    """Mode initial: a snapshot as of the middle of the log, then the stream behind it; a second run only streams."""
    job = _Capture(spark, sf)
    job.run("initial", job.middle)
    # a new checkpoint reads the log from its start: what the snapshot holds is left out all the same
    return job.run("initial", job.quarter, "second")


@query(APPLY)
def capture_always(spark, sf):
    """Mode always: a snapshot in each run, the second as of the end."""
    job = _Capture(spark, sf)
    job.run("always", job.quarter)
    return job.run("always", job.end, "second")


@query(APPLY.replace("FROM chg),\nl AS", "FROM chg WHERE lsn <= (SELECT min(lsn) + (max(lsn) - min(lsn)) // 2 FROM chg)),\nl AS"))
def capture_initial_only(spark, sf):
    """Mode initial_only: the snapshot and no stream, however often it runs."""
    job = _Capture(spark, sf)
    job.run("initial_only", job.middle)
    return job.run("initial_only", job.end)


@query(APPLY)
def capture_never(spark, sf):
    """Mode never: the whole log and no snapshot."""
    job = _Capture(spark, sf)
    rows = job.run("never", job.middle)
    if job.taken:
        raise AssertionError("mode never took a snapshot")
    return rows


@query(APPLY + """UNION ALL SELECT -1, 'taken at', 1, min(lsn) + (max(lsn) - min(lsn)) // 4, 'whole' FROM chg""")
def capture_exported(spark, sf):
    """Mode exported: the snapshot as of the position at which the log was opened, then all that follows.

    The last row tells where the snapshot was taken.
    """
    job = _Capture(spark, sf)
    rows = job.run("exported", job.end, log_start=job.quarter)
    told = [(-1, "taken at", float(len(job.taken)), at, query or "whole") for query, at in job.taken]
    return rows.unionByName(spark.createDataFrame(told, rows.schema).select(*rows.columns))


@query(APPLY.replace("FROM chg),\nl AS",
       "FROM chg WHERE key % 2 = 0 OR lsn > (SELECT min(lsn) + (max(lsn) - min(lsn)) // 4 FROM chg)),\nl AS"))
def capture_custom(spark, sf):
    """Mode custom: the user's rule takes the even keys only, at the log's start, and the stream behind it."""
    job = _Capture(spark, sf)
    rule = lambda saved: Plan(True, True, True, lambda name: f"SELECT * FROM captured WHERE key % 2 = 0 /* {name}, {saved} */")
    return job.run("custom", job.end, custom=rule, log_start=job.quarter, name="events")


@query(CHG + """, h AS (SELECT max(seq) // 2 AS h FROM chg),
l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS n FROM chg)
SELECT key, event_type, CASE WHEN seq <= h THEN CAST(CAST(floor(value) AS INTEGER) AS DOUBLE) ELSE value END AS value,
       CASE WHEN seq > h THEN txid END AS txid
FROM l, h WHERE n = 1 AND op <> 'd'""")
def evolved_table(spark, sf):
    """Half-way through the log a column is widened and another one added; a base of the old shape is in between."""
    root = f"{shared_dir(spark)}/tidemark/evolved-{uuid.uuid4().hex}"
    table = KeyedTable(f"{root}/table", "key long, event_type string, value int", ("key",), (), evolves=True)
    rows = changes(spark, sf).select("seq", "op", "key", "event_type", "value", "txid", F.array().cast("array<string>").alias("_unchanged"))
    half = rows.agg(F.expr("max(seq) div 2")).first()[0]
    old = rows.filter(F.col("seq") <= half).drop("txid").withColumn("value", F.floor("value").cast("int"))
    quarter = F.col("seq") <= half // 2
    table.write_batch(old.filter(quarter), 0)
    table.compact(spark)
    table.write_batch(old.filter(~quarter), 1)
    table.write_batch(rows.filter(F.col("seq") > half), 2)
    return table.read(spark)


@query(APPLY)
def stream_from_source(spark, sf):
    """The log as a source of its own: a stream of bounded batches that is started four times."""
    root = f"{shared_dir(spark)}/tidemark/log-{uuid.uuid4().hex}"
    table = KeyedTable(
        f"{root}/table", "key long, event_type string, value double, lsn long, props string", ("key",), ("props",)
    )
    rows = changes(spark, sf).select("seq", "lsn", "op", "key", "event_type", "value", "props", "_unchanged")
    rows.repartitionByRange(12, "lsn").sortWithinPartitions("lsn").write.parquet(f"{root}/log")
    third = -(-rows.count() // 3)
    for _ in range(4):
        part = stream_log(spark, f"{root}/log", rows.schema, f"{root}/checkpoint", third)
        stream.apply_stream(part, table, f"{root}/checkpoint").awaitTermination()
    return table.read(spark)


def _parts(spark, rows, order, n, root):
    """Write ``rows`` as ``n`` folders, in their order, for a stream to read one after the other."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    step = (high - low) // n + 1
    paths = [f"{root}/part{i}" for i in range(n)]
    for i, path in enumerate(paths):
        part = rows.filter(F.col(order).between(low + i * step, low + (i + 1) * step - 1))
        part.write.parquet(path)
    return paths


@query(APPLY)
def stream_restart(spark, sf):
    """Two parts of the events as two streams, each with a checkpoint of its own."""
    root = f"{shared_dir(spark)}/tidemark/restart-{uuid.uuid4().hex}"
    table = KeyedTable(
        f"{root}/table", "key long, event_type string, value double, lsn long, props string",
        ("key",), ("props",),
    )
    events = load(spark, sf, "events")
    for path in _parts(spark, events, "event_id", 2, root):
        part = spark.readStream.schema(events.schema).parquet(path)
        stream.apply_stream(_event_changes(part), table, f"{path}-checkpoint").awaitTermination()
    return table.read(spark)


@query(CHG + """
SELECT CAST(txid AS VARCHAR) AS id, 'BEGIN' AS status, CAST(NULL AS BIGINT) AS event_count FROM chg GROUP BY txid
UNION ALL SELECT CAST(txid AS VARCHAR), 'END', count(*) FROM chg GROUP BY txid""")
def stream_transactions(spark, sf):
    """BEGIN and END events of a log whose batches cut transactions."""
    root = f"{shared_dir(spark)}/tidemark/transactions-{uuid.uuid4().hex}"
    rows = log(spark, sf)
    for number, path in enumerate(_parts(spark, rows, "seq", 4, root)):
        stream.write_transactions(spark.read.parquet(path), f"{root}/tx", number)
    return spark.read.parquet(f"{root}/tx").select("id", "status", "event_count")


@query(CHG + """,
r AS (
  SELECT seq * 2 AS seq, op, key, event_type, value FROM chg WHERE NOT (op = 'u' AND seq % 50 = 7)
  UNION ALL SELECT seq * 2, 'd', key, NULL, NULL FROM chg WHERE op = 'u' AND seq % 50 = 7
  UNION ALL SELECT seq * 2 + 1, 'c', key + 1000000, event_type, value FROM chg WHERE op = 'u' AND seq % 50 = 7),
l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS n FROM r)
SELECT key, event_type, value FROM l WHERE n = 1 AND op <> 'd'""")
def rekeyed_changes(spark, sf):
    """Some updates give a row another key: the old row goes, the new one is whole."""
    moves = (F.col("op") == 1) & (F.col("seq") % 50 == 7)
    user = lambda d: d.withField("datum_int64", d["datum_int64"] + 1000000)
    new = F.transform("new_tuple", lambda d: F.when(d["column_name"] == "user_id", user(d)).otherwise(d))
    log_rows = raw_log(spark, sf)
    log_rows = log_rows.withColumn("new_tuple", F.when(moves, new).otherwise(F.col("new_tuple")))
    rows = table_changes(decode_changes(supported(log_rows), COLUMNS), ["user_id"])
    rows = rows.withColumnRenamed("user_id", "key")
    table = M.apply_changes(None, rows, ["key"], ["event_type", "value", "props"], "seq", ["props"])
    return table.select("key", "event_type", "value")

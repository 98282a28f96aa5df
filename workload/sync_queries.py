"""Statements, documents, index writes and reports, on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.operators import documents as D
from tidemark.operators import sinks as S
from tidemark.plans import state, sync
from tidemark.sources import snapshot, statements
from tidemark.sources.statements import Statement
from workload.fixtures import OPS, STAMP, TABLES, load, ops, views

ORDERS = Statement(
    "orders_sync",
    "SELECT * FROM orders WHERE o_orderkey > ? ORDER BY o_orderkey LIMIT :chunkSize",
    "orders",
    "O_ORDERKEY",
    chunk_size=500,
)
CUSTOMERS = Statement(
    "customer sync", "SELECT * FROM customer", "Customer Index", "c_custkey", schema="crm"
)
DOCS = Statement(
    "docs",
    "SELECT lpad(CAST(doc_id AS STRING), 20, '0') AS id, lang, source FROM documents",
    id_type="string",
)

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


ISO = """strftime({c}, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN date_part('microsecond', {c}) % 1000000 = 0 THEN ''
       WHEN date_part('microsecond', {c}) % 1000 = 0
         THEN '.' || lpad(CAST((date_part('microsecond', {c}) % 1000000) // 1000 AS VARCHAR), 3, '0')
       ELSE '.' || lpad(CAST(date_part('microsecond', {c}) % 1000000 AS VARCHAR), 6, '0') END || 'Z'"""


@query(f"""
SELECT 'orders' AS _index, 'orders_sync_' || o_orderkey AS _id, o_orderkey, o_custkey,
       o_orderstatus, o_totalprice, {ISO.format(c='o_orderdate')} AS o_orderdate,
       o_orderpriority, 'orders_sync' AS _query, '{STAMP}' AS _sync_timestamp
FROM (SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500)""")
def sync_orders_chunk(spark, sf):
    views(spark, sf, "orders")
    rows = statements.run_statement(spark, ORDERS, "1000", one_chunk=True)
    return D.documents(rows, ORDERS.name, STAMP, ORDERS.id_column, ORDERS.index)


@query(f"""
SELECT 'orders' AS _index, 'orders_sync_' || o_orderkey AS _id, o_orderkey, o_custkey,
       o_orderstatus, o_totalprice, {ISO.format(c='o_orderdate')} AS o_orderdate,
       o_orderpriority, 'orders_sync' AS _query, '{STAMP}' AS _sync_timestamp
FROM orders WHERE o_orderkey > 1000""")
def sync_orders_drain(spark, sf):
    views(spark, sf, "orders")
    rows = statements.run_statement(spark, ORDERS, "1000")
    return D.documents(rows, ORDERS.name, STAMP, ORDERS.id_column, ORDERS.index)


@query("""
SELECT max(o_orderkey) AS next_cursor, count(*) AS rows, true AS id_seen
FROM orders WHERE o_orderkey > 1000""")
def sync_next_cursor(spark, sf):
    rows = statements.incremental_scan(load(spark, sf, "orders"), "o_orderkey", 1000)
    return statements.next_cursor(rows, "o_orderkey")


@query("""
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS chunk_no
FROM orders""")
def orders_chunk_no(spark, sf):
    return statements.assign_chunks(
        load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 1000
    )


@query("""
SELECT id, CAST((row_number() OVER (ORDER BY id) - 1) // 64 AS BIGINT) AS chunk_no
FROM (SELECT lpad(CAST(doc_id AS VARCHAR), 20, '0') AS id FROM documents)""")
def documents_chunk_no(spark, sf):
    ids = load(spark, sf, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("id")
    )
    return statements.assign_chunks(ids, "id", 64)


@query("""
SELECT lpad(CAST(doc_id AS VARCHAR), 20, '0') AS id, lang, source, n_chars FROM documents
WHERE lpad(CAST(doc_id AS VARCHAR), 20, '0') > '00000000000000000005'
  AND CASE WHEN doc_id % 3 <> 0 THEN 'ACTIVE' ELSE 'OLD' END = 'ACTIVE'
ORDER BY id LIMIT 100""")
def next_chunk_text_key(spark, sf):
    keyed = load(spark, sf, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("id"), "lang", "source", "n_chars",
        F.when(F.col("doc_id") % 3 != 0, "ACTIVE").otherwise("OLD").alias("status"),
    )
    active = keyed.filter("status = 'ACTIVE'").drop("status")
    return statements.next_chunk(active, "id", "00000000000000000005", 100)


@query("""
SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS nation, CAST(count(o.o_orderkey) AS BIGINT) AS orders,
       round(coalesce(sum(o.o_totalprice), 0), 2) AS spent
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
WHERE c.c_custkey > 10 GROUP BY ALL""")
def run_user_sql(spark, sf):
    views(spark, sf, "customer", "nation", "orders")
    spec = Statement(
        "spend",
        """SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS nation,
                  count(o.o_orderkey) AS orders,
                  round(coalesce(sum(o.o_totalprice), 0), 2) AS spent
           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
           LEFT JOIN orders o ON o.o_custkey = c.c_custkey
           WHERE c.c_custkey > ? GROUP BY ALL""",
    )
    return statements.run_statement(spark, spec, "10")


@query("""
SELECT 'orders_sync' AS _query, count(*) AS rows, CAST(max(o_orderkey) AS VARCHAR) AS next_cursor,
       true AS id_seen FROM orders WHERE o_orderkey > 1000
UNION ALL SELECT 'customer sync', count(*), CAST(max(c_custkey) AS VARCHAR), true FROM customer
UNION ALL SELECT 'docs', count(*), max(lpad(CAST(doc_id AS VARCHAR), 20, '0')), true FROM documents""")
def statement_set_report(spark, sf):
    views(spark, sf, "orders", "customer", "documents")
    cursors = {ORDERS.name: "1000"}
    reports = [
        sync.sync_report(
            sync.statement_documents(spark, s, cursors.get(s.name), STAMP), s.numeric
        ).withColumn("next_cursor", F.col("next_cursor").cast("string"))
        for s in (ORDERS, CUSTOMERS, DOCS)
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query(f"""
SELECT 'orders' AS _index, 'orders_sync_' || o_orderkey AS _id, 'orders_sync' AS _query,
       CAST(o_orderkey AS VARCHAR) AS business_key FROM orders
UNION ALL SELECT 'customer_index', 'customer sync_' || c_custkey, 'customer sync',
       CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT 'docs', 'docs_' || lpad(CAST(doc_id AS VARCHAR), 20, '0'), 'docs',
       lpad(CAST(doc_id AS VARCHAR), 20, '0') FROM documents""")
def sync_run(spark, sf):
    """A full run: written documents, then a second run that finds nothing new."""
    import uuid

    from tidemark.session import shared_dir

    views(spark, sf, "orders", "customer", "documents")
    target = f"{shared_dir(spark)}/tidemark/sync-{uuid.uuid4().hex}"
    specs = [ORDERS, CUSTOMERS, DOCS]
    sync.sync_once(spark, specs, target, STAMP)
    sync.sync_once(spark, specs, target, "2024-01-02T00:00:00Z")
    docs = sync.read_documents(spark, target)
    own = F.coalesce(F.col("o_orderkey").cast("string"), F.col("c_custkey").cast("string"), "id")
    return docs.filter(F.col("_sync_timestamp") == STAMP).select(
        "_index", "_id", "_query", own.alias("business_key")
    )


EVENTS = Statement(
    "events by time", "SELECT event_id, ts, event_type FROM recent WHERE ts > ? ORDER BY ts LIMIT 700",
    "events", "ts", "timestamp", chunk_size=700,
)


def _target(spark, name: str) -> str:
    import uuid

    from tidemark.session import shared_dir

    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


@query("""
SELECT 'a b' AS _query, '_' || o_orderkey % 7 AS mark, o_orderkey AS business_key FROM orders
UNION ALL SELECT 'a_b', '_' || c_custkey % 7, c_custkey FROM customer""")
def sync_repeat(spark, sf):
    """One stamp used twice, and two names that look alike: nothing is lost."""
    views(spark, sf, "orders", "customer")
    target = _target(spark, "sync-repeat")
    specs = [
        Statement("a b", "SELECT o_orderkey AS id, '_' || o_orderkey % 7 AS mark FROM orders"),
        Statement("a_b", "SELECT c_custkey AS id, '_' || c_custkey % 7 AS mark FROM customer"),
    ]
    for _ in range(2):
        sync.sync_once(spark, specs, target, STAMP)
    return sync.read_documents(spark, target).select("_query", "mark", F.col("id").alias("business_key"))


@query(f"""
SELECT event_id, {ISO.format(c='ts')} AS ts, event_type,
       CASE WHEN event_id % 3 <> 0 OR event_id <= (SELECT max(event_id) / 2 FROM events) THEN 'first' ELSE 'second' END AS run
FROM events
WHERE event_id <= (SELECT max(event_id) / 2 FROM events)
   OR ts > (SELECT max(ts) FROM events WHERE event_id <= (SELECT max(event_id) / 2 FROM events))
""".replace("event_id % 3 <> 0 OR ", ""))
def sync_by_time(spark, sf):
    """Events by their time in two runs, the second above the first one's last time."""
    events = load(spark, sf, "events")
    half = events.agg((F.max("event_id") / 2).alias("half"))
    target = _target(spark, "sync-by-time")
    events.join(F.broadcast(half), F.col("event_id") <= F.col("half")).createOrReplaceTempView("recent")
    sync.sync_once(spark, [EVENTS], target, "2024-01-01T00:00:00Z")
    events.createOrReplaceTempView("recent")
    sync.sync_once(spark, [EVENTS], target, "2024-01-02T00:00:00Z")
    docs = sync.read_documents(spark, target)
    run = F.when(F.col("_sync_timestamp") < "2024-01-02", "first").otherwise("second")
    return docs.select("event_id", "ts", "event_type", run.alias("run"))


@query("""
SELECT 'cust_' || sha256('{' ||
  '"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment ||
  '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS _id, c_name
FROM customer""")
def content_hash_ids(spark, sf):
    rows = load(spark, sf, "customer").select("c_nationkey", "c_name", "c_mktsegment", "c_custkey")
    return D.documents(rows, "cust", STAMP, None).select("_id", "c_name")


@query(f"SELECT event_id, {ISO.format(c='ts')} AS ts, event_type FROM events")
def normalised_events(spark, sf):
    return D.normalise_values(load(spark, sf, "events").select("event_id", "ts", "event_type"))


@query("""
SELECT p_partkey,
  CASE WHEN starts_with(n, '_') THEN 'idx' || n ELSE n END AS by_name,
  CASE WHEN starts_with(t, '_') THEN 'idx' || t ELSE t END AS by_table
FROM (SELECT p_partkey, regexp_replace(lower('_' || p_name), '[^a-z0-9_-]', '_', 'g') AS n,
             regexp_replace(lower(p_brand || '_' || p_type), '[^a-z0-9_-]', '_', 'g') AS t FROM part)""")
def index_names(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey",
        D.index_name(F.concat(F.lit("_"), "p_name")).alias("by_name"),
        D.table_index_name(F.col("p_brand"), F.col("p_type")).alias("by_table"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR)
  WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS VARCHAR) ELSE 'other_' || o_orderkey END AS id
FROM orders""")
def stripped_ids(spark, sf):
    name = F.when(F.col("o_orderkey") % 3 == 0, "orders").when(
        F.col("o_orderkey") % 3 == 1, "orders_big"
    )
    ids = F.concat(name.otherwise("other"), F.lit("_"), "o_orderkey")
    return load(spark, sf, "orders").select(
        "o_orderkey", D.strip_prefix(ids, ["orders", "orders_big", ""]).alias("id")
    )


@query("""
SELECT '"CRM"."CLIENTS"' AS target, c_custkey AS "C_CUSTKEY", c_name AS "C_NAME",
       c_nationkey AS "C_NATIONKEY", c_acctbal AS "C_ACCTBAL", c_mktsegment AS "C_MKTSEGMENT"
FROM customer""")
def mapped_identifiers(spark, sf):
    target, df = D.map_identifiers(
        load(spark, sf, "customer"), "crm.Customer", {"CUSTOMER": "CLIENTS"}
    )
    return df.withColumn("target", F.lit(target))


@query("""
SELECT 'text' AS field, CAST(count(*) FILTER (text <> '') AS BIGINT) AS filled FROM documents
UNION ALL SELECT 'lang', CAST(count(*) FILTER (lang <> '') AS BIGINT) FROM documents
UNION ALL SELECT 'source', CAST(count(*) FILTER (source <> '') AS BIGINT) FROM documents""")
def text_field_fill(spark, sf):
    docs = load(spark, sf, "documents")
    fields = D.text_fields(docs, "doc_id")
    wide = docs.agg(*[F.count_if(F.col(f) != "").alias(f) for f in fields])
    return wide.unpivot([], fields, "field", "filled")


@query(
    "\nUNION ALL ".join(
        f"SELECT 'public' AS table_schema, '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in TABLES
    )
)
def row_counts(spark, sf):
    return snapshot.row_counts({t: load(spark, sf, t) for t in TABLES})


@query(
    "SELECT CAST(sum(n) AS BIGINT) AS total_rows FROM ("
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {t}" for t in TABLES)
    + ")"
)
def row_total(spark, sf):
    return snapshot.total_rows(row_counts(spark, sf))


@query(" UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS rows, 'r' AS op FROM {t}""" for t in TABLES))
def snapshot_events(spark, sf):
    scans = snapshot.snapshot_scan({t: load(spark, sf, t) for t in TABLES}, 7)
    counts = [
        df.filter("after IS NOT NULL AND before IS NULL AND lsn = 7")
        .groupBy("table", "op")
        .agg(F.count(F.lit(1)).alias("rows"))
        for df in scans.values()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("""
SELECT 'orders' AS "table", count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(o_custkey) AS BIGINT) AS refs,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, CAST(sum(length(o_orderstatus || o_orderpriority)) AS BIGINT) AS letters,
       max(strftime(o_orderdate, '%Y-%m-%d')) AS last FROM orders
UNION ALL
SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT), CAST(sum(c_nationkey) AS BIGINT),
       CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT), CAST(sum(length(c_name || c_mktsegment)) AS BIGINT), max(c_name) FROM customer
UNION ALL
SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT), CAST(sum(l_partkey + l_suppkey + l_linenumber) AS BIGINT),
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT), CAST(sum(length(l_returnflag || l_linestatus)) AS BIGINT),
       max(strftime(l_shipdate, '%Y-%m-%d')) FROM lineitem""")
def snapshot_values(spark, sf):
    """The values that snapshot events carry, summed by column."""
    scans = snapshot.snapshot_scan({t: load(spark, sf, t) for t in ("orders", "customer", "lineitem")}, 7)
    cents = lambda c: F.sum(F.round(F.col(f"after.{c}") * 100).cast("long")).alias("cents")
    letters = lambda *cs: F.sum(F.length(F.concat(*[F.col(f"after.{c}") for c in cs]))).cast("long").alias("letters")
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    day = lambda c: F.max(F.date_format(f"after.{c}", "yyyy-MM-dd")).alias("last")
    rows = F.count("after").alias("rows")
    sums = {
        "orders": [total("after.o_orderkey", "keys"), total("after.o_custkey", "refs"), cents("o_totalprice"),
                   letters("o_orderstatus", "o_orderpriority"), day("o_orderdate")],
        "customer": [total("after.c_custkey", "keys"), total("after.c_nationkey", "refs"), cents("c_acctbal"),
                     letters("c_name", "c_mktsegment"), F.max("after.c_name").alias("last")],
        "lineitem": [total("after.l_orderkey", "keys"), total(F.expr("after.l_partkey + after.l_suppkey + after.l_linenumber"), "refs"),
                     cents("l_extendedprice"), letters("l_returnflag", "l_linestatus"), day("l_shipdate")],
    }
    parts = [scans[t].filter("op = 'r' AND lsn = 7").groupBy("table").agg(rows, *columns) for t, columns in sums.items()]
    return reduce(DataFrame.unionByName, parts)


@query("""
SELECT doc_id, k FROM (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 10 = 1 THEN chr(9) || source || doc_id
  ELSE lang || doc_id END AS k FROM documents) WHERE k > ''""")
def sync_text_first(spark, sf):
    """A first run by a text key of which one in ten begins with a control letter and one in ten is empty.

    The empty key is not above anything, so the statement's own comparison leaves it out.
    """
    load(spark, sf, "documents").selectExpr(
        "doc_id", "CASE WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 10 = 1 THEN '\\t' || source || doc_id ELSE lang || doc_id END AS k"
    ).createOrReplaceTempView("keyed")
    spec = Statement("keyed", "SELECT k, doc_id FROM keyed WHERE k > ? ORDER BY k LIMIT :chunkSize", id_column="k", id_type="text", chunk_size=100)
    target = _target(spark, "sync-text-first")
    for _ in range(2):  # the second run finds nothing above the last key
        sync.sync_once(spark, [spec], target, STAMP)
    return sync.read_documents(spark, target).select("doc_id", "k")


@query("""
SELECT CAST(row_number() OVER (ORDER BY first) AS INTEGER) AS place, name FROM (
  SELECT 'region_' || n_regionkey AS name, min(n_nationkey) AS first FROM nation GROUP BY 1)""")
def statement_names(spark, sf):
    """A statement per nation, named by its region: each name once, in order of its first."""
    # as many statements as a configuration has
    rows = load(spark, sf, "nation").orderBy("n_nationkey").select("n_regionkey").collect()
    specs = [Statement(f"region_{r[0]}", "SELECT 1 AS id") for r in rows] + [Statement("", "SELECT 1 AS id")]
    names = sync.distinct_statements(specs)
    return spark.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "place int, name string")


# ---- index writes -------------------------------------------------------------------

FOLDED = f"""
WITH ops AS ({OPS}),
k AS (SELECT _index, _id, max(seq) AS last,
        max(CASE WHEN op = 'INDEX' THEN seq END) AS ri, max(CASE WHEN op = 'DELETE' THEN seq END) AS rd,
        max(CASE WHEN op = 'INDEX' OR (op = 'UPDATE' AND l_linenumber % 2 = 0) THEN seq END) AS pq,
        max(CASE WHEN op = 'INDEX' OR (op = 'UPDATE' AND l_linenumber % 2 = 1) THEN seq END) AS pt
      FROM ops GROUP BY ALL),
f AS (SELECT k.*, last = coalesce(rd, -1) AS gone, (ri IS NOT NULL OR rd IS NOT NULL) AS whole,
        coalesce(pq >= coalesce(ri, -1) AND pq > coalesce(rd, -1), false) AS hq,
        coalesce(pt >= coalesce(ri, -1) AND pt > coalesce(rd, -1), false) AS ht FROM k),
folded AS (SELECT f._index, f._id, CASE WHEN gone THEN 'DELETE' WHEN whole THEN 'INDEX' ELSE 'UPDATE' END AS op,
        CASE WHEN hq THEN q.l_quantity END AS l_quantity, CASE WHEN ht THEN t.l_tax END AS l_tax, hq, ht
      FROM f LEFT JOIN ops q ON q._id = f._id AND q.seq = f.pq
             LEFT JOIN ops t ON t._id = f._id AND t.seq = f.pt)
"""


@query(FOLDED + """
SELECT _index, _id, op, l_quantity, l_tax,
  concat_ws(',', CASE WHEN hq THEN 'l_quantity' END, CASE WHEN ht THEN 'l_tax' END) AS fields
FROM folded""")
def fold_ops(spark, sf):
    folded = S.fold_ops(ops(spark, sf), ["l_quantity", "l_tax"], "seq")
    return folded.drop("seq").withColumn("_fields", F.array_join("_fields", ",")).withColumnRenamed(
        "_fields", "fields"
    )


def _order_docs(spark, sf) -> DataFrame:
    """Orders as documents the line operations apply to."""
    return load(spark, sf, "orders").select(
        F.lit("items").alias("_index"),
        F.col("o_orderkey").cast("string").alias("_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("l_quantity"),
        F.lit(None).cast("double").alias("l_tax"),
    )


@query(FOLDED + """,
t AS (SELECT 'items' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status,
             o_totalprice AS l_quantity, CAST(NULL AS DOUBLE) AS l_tax FROM orders)
SELECT coalesce(t._index, f._index) AS _index, coalesce(t._id, f._id) AS _id,
  CASE WHEN f.op = 'INDEX' THEN NULL ELSE t.status END AS status,
  CASE WHEN f.op = 'INDEX' OR f.hq THEN f.l_quantity ELSE t.l_quantity END AS l_quantity,
  CASE WHEN f.op = 'INDEX' OR f.ht THEN f.l_tax ELSE t.l_tax END AS l_tax
FROM t FULL JOIN folded f ON t._id = f._id AND t._index = f._index
WHERE coalesce(f.op, '') <> 'DELETE'""")
def bulk_apply(spark, sf):
    return S.apply_ops(_order_docs(spark, sf), ops(spark, sf), ["l_quantity", "l_tax"], "seq")


@query("""
WITH p AS (SELECT CAST(l_orderkey AS VARCHAR) AS _id, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
t AS (SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, o_totalprice AS l_quantity FROM orders)
SELECT 'items' AS _index, coalesce(t._id, p._id) AS _id, t.status,
       CASE WHEN p._id IS NULL THEN t.l_quantity ELSE p.q END AS l_quantity, CAST(NULL AS DOUBLE) AS l_tax
FROM t FULL JOIN p ON t._id = p._id""")
def partial_update(spark, sf):
    patch = (
        load(spark, sf, "lineitem")
        .groupBy(F.lit("items").alias("_index"), F.col("l_orderkey").cast("string").alias("_id"))
        .agg(F.sum("l_quantity").alias("l_quantity"))
        .withColumn("_fields", F.array(F.lit("l_quantity")))
    )
    return S.merge_fields(_order_docs(spark, sf), patch)


@query("""
WITH d AS (SELECT 'items' AS _index, CAST(l_orderkey AS VARCHAR) AS _id, max(l_shipdate) AS s, count(*) AS n
           FROM lineitem GROUP BY ALL)
SELECT 'items' AS _index, _id, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS DOUBLE) AS l_quantity,
       CAST(NULL AS DOUBLE) AS l_tax, n AS lines FROM d
UNION ALL SELECT 'items', CAST(o_orderkey AS VARCHAR), o_orderstatus, o_totalprice, NULL, NULL FROM orders
WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT _id FROM d)""")
def index_upsert(spark, sf):
    docs = (
        load(spark, sf, "lineitem")
        .groupBy(F.lit("items").alias("_index"), F.col("l_orderkey").cast("string").alias("_id"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return S.upsert(_order_docs(spark, sf), docs)


@query("""
SELECT 'items' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def index_delete(spark, sf):
    gone = (
        load(spark, sf, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(F.lit("items").alias("_index"), F.col("l_orderkey").cast("string").alias("_id"))
    )
    return S.delete(_order_docs(spark, sf).select("_index", "_id", "status"), gone)


@query("SELECT 'items' AS _index, count(*) AS operations FROM lineitem")
def ops_per_index(spark, sf):
    return S.ops_per_index(ops(spark, sf))


REJECT_SQL = """
WITH d AS (SELECT 'docs' AS _index, 'docs_' || doc_id AS _id,
  concat_ws('; ', CASE WHEN n_chars >= 4000 THEN 'text too long' END,
                  CASE WHEN lang NOT IN ('en', 'fr') THEN 'language not wanted' END) AS error FROM documents)
"""


def _reject_split(spark, sf):
    rows = load(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    docs = D.documents(rows, "docs", STAMP)
    return S.split_rejects(
        docs,
        {"text too long": F.col("n_chars") < 4000, "language not wanted": F.col("lang").isin("en", "fr")},
    )


@query(REJECT_SQL + "SELECT * FROM d WHERE error <> ''")
def rejected_documents(spark, sf):
    return _reject_split(spark, sf)[1]


@query(REJECT_SQL + "SELECT _index, _id FROM d WHERE error = ''")
def accepted_documents(spark, sf):
    return _reject_split(spark, sf)[0].select("_index", "_id")


@query("""
WITH s AS (SELECT user_id, event_id, event_type FROM events),
c AS (SELECT max(event_id) AS v FROM s WHERE event_id = (SELECT max(event_id) // 2 FROM s))
SELECT 's' || user_id AS statement_name, max(event_id) AS last_id,
       CAST(max(event_id) AS VARCHAR) AS cursor_value
FROM s WHERE event_id > (SELECT v FROM c) GROUP BY user_id""")
def saved_cursors(spark, sf):
    """Cursors saved over time, all forgotten half-way: the last of each since then."""
    e = load(spark, sf, "events")
    half = F.expr("max(event_id) div 2")
    middle = e.agg(half.alias("m")).scalar()
    name = F.when(F.col("event_id") != middle, F.concat(F.lit("s"), "user_id"))
    saved = e.select(
        name.alias("statement_name"),
        F.col("event_id").alias("last_id"),
        F.col("event_id").cast("string").alias("cursor_value"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.col("event_id").alias("version"),
    )
    return state.current(saved).drop("updated_at")


# ---- text columns cleaned by type ---------------------------------------------------


@query("""
SELECT o_orderkey,
  round(CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END, 2) AS money,
  o_orderkey * 86400000000 + 3723000000 + 500000 AS pause,
  o_orderkey % 2 = 1 AS flag,
  upper(CASE WHEN o_orderkey = 0 THEN '' WHEN o_orderkey < 256 THEN printf('%02x', o_orderkey) ELSE
    printf('%02x', o_orderkey % 256) || CASE WHEN o_orderkey < 65536 THEN printf('%02x', o_orderkey // 256)
    ELSE printf('%02x', (o_orderkey // 256) % 256) || printf('%02x', o_orderkey // 65536) END END) AS bits,
  strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS zoned,
  CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS day,
  '22:30:00Z' AS clock,
  CAST(o_orderkey % 86400 * 1000000 AS BIGINT) AS tod,
  CAST(o_custkey AS DOUBLE) AS x,
  o_orderstatus AS label,
  '{"k":"' || o_custkey || '","none":null}' AS attrs,
  o_custkey + 1 AS second_item
FROM orders""")
def clean_text_columns(spark, sf):
    """A table delivered as text, read back by the value rules."""
    o = load(spark, sf, "orders")
    price = F.format_number("o_totalprice", 2)
    odd = F.col("o_orderkey") % 2 == 1
    text = o.select(
        "o_orderkey",
        F.when(odd, F.concat(F.lit("$"), price))
        .otherwise(F.concat(F.lit("-$"), price))
        .alias("money"),
        F.concat("o_orderkey", F.lit(" days 01:02:03.5")).alias("pause"),
        F.when(odd, "1").otherwise("0").alias("flag"),
        F.bin("o_orderkey").alias("bits"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+02")).alias("zoned"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.lit("00:30:00+02:00").alias("clock"),
        F.date_format(
            F.timestamp_seconds(F.col("o_orderkey") % 86400), "HH:mm:ss"
        ).alias("tod"),
        F.concat(F.lit("("), "o_custkey", F.lit(",1)")).alias("x"),
        F.col("o_orderstatus").alias("label"),
        F.concat(F.lit('"k"=>"'), "o_custkey", F.lit('", "none"=>NULL')).alias("attrs"),
        F.concat(F.lit("{7,"), F.col("o_custkey") + 1, F.lit(",NULL}")).alias("second_item"),
    )
    types = {
        "money": "money", "pause": "interval", "flag": "bit", "bits": "varbit",
        "zoned": "timestamptz", "day": "date", "clock": "timetz", "tod": "time", "x": "point",
        "attrs": "hstore", "second_item": "int8[]",
    }
    clean = snapshot.clean_columns(
        text, types, converters={"label": lambda c: V.enum(c, ["F", "O", "P"])}
    )
    return clean.select(
        "o_orderkey",
        F.col("money").cast("double").alias("money"),
        "pause",
        "flag",
        F.hex("bits").alias("bits"),
        "zoned",
        F.unix_date("day").cast("long").alias("day"),
        "clock",
        "tod",
        F.col("x.x").alias("x"),
        "label",
        "attrs",
        F.col("second_item")[1].alias("second_item"),
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def props_json(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k")
    )


@query("""
WITH t AS (
  SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
         CAST(o_orderkey AS VARCHAR) || repeat('7', 40) || '.25' AS wide FROM orders)
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 5 > 0 THEN price END AS DECIMAL(18,2)) AS exact,
       CASE WHEN o_orderkey % 5 = 0 THEN 'NaN' END AS special,
       wide AS text, o_orderkey % 5 > 0 AS held, false AS wide_held
FROM t""")
def decode_numerics(spark, sf):
    """Numerics of any size: exact or not at all, special values and text kept."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    wide = F.concat(F.col("o_orderkey").cast("string"), F.lit("7" * 40 + ".25"))
    given = F.when(F.col("o_orderkey") % 5 > 0, price).otherwise("NaN")
    small = V.numeric(given, 18, 2)
    return load(spark, sf, "orders").select(
        "o_orderkey",
        small["value"].alias("exact"),
        small["special"].alias("special"),
        V.numeric(wide, mode="string").alias("text"),
        small["value"].isNotNull().alias("held"),
        V.numeric(wide).isNotNull().alias("wide_held"),
    )

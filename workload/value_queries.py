"""Value rules and small operators on texts made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import values as V
from tidemark.operators import merge as M
from tidemark.operators import sinks as S
from tidemark.plans.keyed_table import KeyedTable
from tidemark.session import shared_dir
from tidemark.sources.changes import DATUM
from tidemark.streaming import apply as stream
from workload.change_queries import _event_changes, _stream
from workload.fixtures import CHANGES, changes, load

QUERIES = {}
SQL = {}


def query(sql: str):
    def add(fn):
        QUERIES[fn.__name__], SQL[fn.__name__] = fn, sql
        return fn

    return add


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 2 END AS scale,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey * 100 + 25 END AS unscaled,
       to_base64(encode(o_orderpriority)) AS as_base64, lower(hex(encode(o_orderpriority))) AS as_hex,
       lower(hex(encode(o_orderstatus))) AS from_hex, o_orderpriority AS as_citext
FROM orders""")
def scalar_rules(spark, sf):
    """Booleans, numerics without declared scale, bytes, text of types without a rule."""
    o, key = load(spark, sf, "orders"), F.col("o_orderkey")
    flag = F.element_at(F.array(*map(F.lit, ["T", "f", "yes", ""])), (key % 4 + 1).cast("int"))
    amount = F.when(key % 7 == 0, "n/a").otherwise(F.concat(key.cast("string"), F.lit(".2500")))
    number = V.numeric_any_scale(amount)
    octets = F.encode("o_orderpriority", "UTF-8")
    return o.select(
        "o_orderkey", V.boolean(flag).alias("flag"), number["scale"].alias("scale"),
        number["unscaled"].cast("long").alias("unscaled"),
        V.binary(octets, "base64").alias("as_base64"), V.binary(octets, "hex").alias("as_hex"),
        V.from_text("bytea", F.concat(F.lit("\\x"), F.hex("o_orderstatus")), {"binary_mode": "hex"}).alias("from_hex"),
        V.from_text("citext", F.col("o_orderpriority")).alias("as_citext"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE
  'P' || o_custkey || 'Y' || (o_orderkey % 12) || 'M-' || (o_orderkey % 30 + 1) || 'DT' || (o_orderkey % 24) || 'H5M' || (o_orderkey % 60)
  || '.5S' END AS pause
FROM orders""")
def interval_texts(spark, sf):
    """Intervals as text, one in nine unreadable."""
    key = F.col("o_orderkey")
    text = F.concat(
        "o_custkey", F.lit(" years "), key % 12, F.lit(" mons -"), key % 30 + 1, F.lit(" days "),
        F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":05:"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit(".5"),
    )
    text = F.when(key % 9 == 0, F.concat(text, F.lit(" or so"))).otherwise(text)
    return load(spark, sf, "orders").select("o_orderkey", V.interval_iso(text).alias("pause"))


@query("""
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 5415 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS shifted,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS of_our_era,
       ['' || strftime(o_orderdate + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%SZ'), NULL] AS moments,
       ['a.b' || o_custkey, 'c'] AS paths
FROM orders""")
def timestamp_texts(spark, sf):
    """Times with offsets in seconds and with an era, arrays of times and of paths."""
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    moments = F.concat(F.lit('{"'), at, F.lit('-03",NULL}'))
    return load(spark, sf, "orders").select(
        "o_orderkey",
        V.timestamptz_iso(F.concat(at, F.lit("+01:30:15"))).alias("shifted"),
        V.iso_instant(V.timestamp(F.concat(at, F.lit(" AD")))).alias("of_our_era"),
        V.from_text("timestamptz[]", moments).alias("moments"),
        V.from_text("ltree[]", F.concat(F.lit("{a.b"), "o_custkey", F.lit(",c}"))).alias("paths"),
    )


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey AS INTEGER) WHEN 1 THEN CAST(o_custkey AS INTEGER) END AS srid,
       CASE o_orderkey % 4 WHEN 0 THEN 25 WHEN 1 THEN 25 WHEN 2 THEN 21 END AS bytes
FROM orders""")
def geometry_rules(spark, sf):
    """Points in hex, of either byte order, with and without a reference system, and cut ones."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    big = F.lpad(F.hex(key), 8, "0")
    turned = lambda h: F.concat(*[F.substring(h, at, 2) for at in (7, 5, 3, 1)])
    rest = F.lit("0" * 32)
    text = (
        F.when(key % 4 == 0, F.concat(F.lit("0020000001"), big, rest))
        .when(key % 4 == 1, F.concat(F.lit("0101000020"), turned(F.lpad(F.hex(cust), 8, "0")), rest))
        .when(key % 4 == 2, F.concat(F.lit("0101000000"), rest))
        .otherwise("01010000")
    )
    found = V.geometry(text)
    return load(spark, sf, "orders").select(
        "o_orderkey", found["srid"].alias("srid"), F.length(found["wkb"]).alias("bytes")
    )


@query(f"""
WITH chg AS ({CHANGES})
SELECT 'server.public.' || "table" AS topic, count(*) AS rows, CAST(sum(seq) AS BIGINT) AS seqs FROM chg GROUP BY 1""")
def topics_written(spark, sf):
    """Changes written to a folder for each destination, and read back."""
    path = f"{shared_dir(spark)}/tidemark/topics-{uuid.uuid4().hex}"
    S.write_by_topic(changes(spark, sf), path, "server")
    return (
        spark.read.parquet(path)
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seqs"))
    )


@query("""
SELECT event_id, event_type,
       CASE WHEN user_id % 3 = 0 THEN props ELSE '__unavailable_value' END AS props
FROM events""")
def undelivered_columns(spark, sf):
    """Messages without their large column: the old row's value, or the stand-in."""
    old = {"props": F.when(F.col("user_id") % 3 == 0, F.col("props"))}
    filled = M.fill_undelivered({"event_type": F.col("event_type")}, ["event_type", "props"], old)
    return load(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in filled.items()])


@query("""
WITH half AS (SELECT max(event_id) // 2 AS h FROM events),
later AS (SELECT user_id AS key, event_type, value, event_id FROM events, half WHERE event_id <= h)
SELECT key, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM later GROUP BY key""")
def catch_up_snapshot(spark, sf):
    """A stream up to the middle of the log, then a snapshot of the events until there."""
    root = f"{shared_dir(spark)}/tidemark/catch-up-{uuid.uuid4().hex}"
    table = KeyedTable(
        f"{root}/table", "key long, event_type string, value double, lsn long, props string", ("key",), ("props",)
    )
    events = load(spark, sf, "events")
    half = events.agg(F.expr("max(event_id) div 2")).first()[0]
    top = (
        events.filter(F.col("event_id") <= half)
        .groupBy(F.col("user_id").alias("key"))
        .agg(F.max_by(F.struct("event_type", "value", F.lit(0).cast("long").alias("lsn"), "props"), "event_id").alias("r"))
    )
    stream.catch_up_then_snapshot(
        _event_changes(_stream(spark, sf)), table, f"{root}/checkpoint",
        lambda: top.select("key", "r.*"), 16777216 + half * 64,
    )
    return table.read(spark).select("key", "event_type", "value")


@query("""
SELECT o_orderkey, [[o_orderstatus, o_orderpriority], ['a,"b', NULL]] AS labels,
       [[o_orderkey, o_custkey], [o_orderkey + 1, NULL], [3, o_custkey]] AS numbers,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE [[[CAST(o_custkey AS DOUBLE)]]] END AS cube
FROM orders""")
def nested_arrays(spark, sf):
    """Arrays of two and three dimensions; one in three is no box and so null."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda *parts: F.concat(*[p if isinstance(p, F.Column) else F.lit(p) for p in parts])
    labels = text("{{", F.col("o_orderstatus"), ',"', F.col("o_orderpriority"), '"},{"a,\\"b",NULL}}')
    numbers = text("{{", key, ",", cust, "},{", key + 1, ",NULL},{3,", cust, "}}")
    cube = F.when(key % 3 == 0, text("{{{", cust, "},{}}}")).otherwise(text("{{{", cust, "}}}"))
    return load(spark, sf, "orders").select(
        "o_orderkey",
        V.from_text("text[][]", labels).alias("labels"),
        V.from_text("int8[][]", numbers).alias("numbers"),
        V.from_text("float8[][][]", cube).alias("cube"),
    )


NETWORK = """
SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS inet, regexp_extract(url, '://([^/?#]*)', 1) || '/24' AS cidr,
       md5(url) AS uuid, substr(md5(url), 1, 17) AS macaddr, '[' || page_id || ',' || (page_id + 5) || ')' AS int4range,
       '["' || page_id || '",)' AS tstzrange FROM pages"""


@query(NETWORK)
def text_types(spark, sf):
    """Types that stay text: addresses, ids, ranges. From text and from tagged values alike."""
    load(spark, sf, "pages").createOrReplaceTempView("pages")
    rows = spark.sql(NETWORK)
    kinds = [c for c in rows.columns if c != "page_id"]
    none = lambda t: F.lit(None).cast(t)

    def datum(c):
        fields = [F.col(c).alias(f.name) if f.name == "datum_string" else none(f.dataType).alias(f.name) for f in DATUM]
        return F.struct(*fields)

    same = [F.when(V.from_text(k, F.col(k)).eqNullSafe(V.from_datum(k, datum(k))), V.from_text(k, F.col(k))).alias(k) for k in kinds]
    return rows.select("page_id", *same)


@query("""
SELECT o_orderkey, NULL::VARCHAR AS left_out, lower(hex(encode(o_orderpriority))) AS kept,
       CASE WHEN o_orderkey % 2 = 0 THEN '0101000000' || repeat('0', 32) END AS shape, o_orderstatus AS citext
FROM orders""")
def unknown_types(spark, sf):
    """Values of types without a rule are left out, or stay bytes if asked for."""
    octets = F.encode("o_orderpriority", "UTF-8")
    shape = F.when(F.col("o_orderkey") % 2 == 0, F.lit("0101000000" + "0" * 32)).otherwise("no geometry")

    def datum(**given):
        return F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DATUM])

    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.lower(F.hex(V.from_datum("unknown", datum(datum_bytes=octets)))).alias("left_out"),
        F.lower(F.hex(V.from_datum("unknown", datum(datum_bytes=octets), {"include_unknown": True}))).alias("kept"),
        F.lower(F.hex(V.from_datum("geometry", datum(datum_string=shape))["wkb"])).alias("shape"),
        V.from_datum("citext", datum(datum_string=F.col("o_orderstatus"))).alias("citext"),
    )

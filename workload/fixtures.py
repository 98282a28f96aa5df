"""Inputs that both engines derive from the given tables by the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.changes import DATUM, TYPE_INFO

STAMP = "2024-01-01T00:00:00Z"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


#: a change log over the events: users are the keys, clicks do not repeat their props
CHANGES = """
SELECT event_id AS seq,
       16777216 + event_id * 64 AS lsn,
       500 + CAST(floor(event_id / 5.0) AS BIGINT) AS txid,
       CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       CASE WHEN event_type IN ('view', 'click') THEN 'visits' ELSE 'actions' END AS "table",
       user_id AS "key",
       event_type, value,
       CASE WHEN event_type = 'click' THEN NULL ELSE props END AS props,
       (event_type = 'click') AS props_unchanged,
       ts AS commit_ts
FROM events
"""

#: the same log with its BEGIN and COMMIT rows, which have numbers between the changes
LOG = f"""
WITH chg AS ({CHANGES})
SELECT seq * 4 + 1 AS seq, lsn, txid, op, "table" FROM chg
UNION ALL
SELECT min(seq) * 4, min(lsn), txid, 'begin', NULL FROM chg GROUP BY txid
UNION ALL
SELECT max(seq) * 4 + 2, max(lsn) + 32, txid, 'commit', NULL FROM chg GROUP BY txid
"""

#: mixed bulk operations over the line items; lines of an order repeat numbers, so part,
#: supplier and quantity make their order total
OPS = """
SELECT 'items' AS _index,
       CAST(l_orderkey AS VARCHAR) AS _id,
       CAST(l_linenumber AS HUGEINT) * 1000000000000000000000000000000000000
         + CAST(l_partkey AS HUGEINT) * 10000000000000000000 + l_suppkey * 100
         + CAST(l_quantity AS BIGINT) AS seq,
       CASE WHEN l_linenumber = 1 THEN 'INDEX'
            WHEN l_linenumber % 2 = 1 AND l_returnflag = 'R' THEN 'DELETE'
            ELSE 'UPDATE' END AS op,
       l_linenumber, l_quantity, l_tax
FROM lineitem
"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log, with the columns the merge operators expect."""
    e = load(spark, sf_dir, "events")
    kind = F.col("event_type")
    return e.select(
        F.col("event_id").alias("seq"),
        (F.lit(16777216) + F.col("event_id") * 64).alias("lsn"),
        (F.lit(500) + F.floor(F.col("event_id") / 5.0)).cast("long").alias("txid"),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        F.lit("public").alias("schema"),
        F.when(kind.isin("view", "click"), "visits").otherwise("actions").alias("table"),
        F.col("user_id").alias("key"),
        kind,
        "value",
        F.when(kind != "click", F.col("props")).alias("props"),
        F.when(kind == "click", F.array(F.lit("props")))
        .otherwise(F.array().cast("array<string>"))
        .alias("_unchanged"),
        F.col("ts").cast("timestamp").alias("commit_ts"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log with BEGIN and COMMIT rows."""
    chg = changes(spark, sf_dir).select("seq", "lsn", "txid", "op", "table")
    tx = chg.groupBy("txid").agg(
        F.min("seq").alias("s0"), F.max("seq").alias("s1"),
        F.min("lsn").alias("l0"), F.max("lsn").alias("l1"),
    )
    none = F.lit(None).cast("string").alias("table")
    begin = tx.select(
        (F.col("s0") * 4).alias("seq"), F.col("l0").alias("lsn"), "txid",
        F.lit("begin").alias("op"), none,
    )
    commit = tx.select(
        (F.col("s1") * 4 + 2).alias("seq"), (F.col("l1") + 32).alias("lsn"), "txid",
        F.lit("commit").alias("op"), none,
    )
    rows = chg.withColumn("seq", F.col("seq") * 4 + 1)
    return rows.unionByName(begin).unionByName(commit)


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bulk operations; even lines set the quantity, odd ones the tax."""
    line = F.col("l_linenumber")
    whole = line == 1
    return load(spark, sf_dir, "lineitem").select(
        F.lit("items").alias("_index"),
        F.col("l_orderkey").cast("string").alias("_id"),
        # room for part and supplier keys below 10^17
        F.expr(
            "cast(cast(l_linenumber as decimal(2,0)) * 1000000000000000000000000000000000000BD as decimal(38,0))"
            " + cast(cast(l_partkey as decimal(18,0)) * 10000000000000000000BD as decimal(38,0))"
            " + cast(cast(l_suppkey as decimal(18,0)) * 100BD + cast(l_quantity as decimal(10,0)) as decimal(38,0))"
        ).cast("decimal(38,0)").alias("seq"),
        F.when(whole, "INDEX")
        .when((line % 2 == 1) & (F.col("l_returnflag") == "R"), "DELETE")
        .otherwise("UPDATE")
        .alias("op"),
        "l_quantity",
        "l_tax",
        F.when(line % 2 == 0, F.array(F.lit("l_quantity")))
        .otherwise(F.array(F.lit("l_tax")))
        .alias("_fields"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as delivered: tuples of tagged values."""
    e = load(spark, sf_dir, "events")
    click = F.col("event_type") == "click"

    def datum(name: str, oid: int, **tags) -> F.Column:
        fields = []
        for f in DATUM:
            value = {"column_name": F.lit(name), "column_type": F.lit(oid)}.get(f.name)
            value = tags.get(f.name, F.lit(None)) if value is None else value
            fields.append(value.cast(f.dataType).alias(f.name))
        return F.struct(*fields)

    new = F.array(
        datum("user_id", 20, datum_int64=F.col("user_id")),
        datum('"event_type"', 1043, datum_string=F.col("event_type")),
        datum("value", 701, datum_double=F.col("value")),
        datum("seen_at", 1114, datum_int64=F.unix_micros(F.col("ts").cast("timestamp"))),
        datum("props", 3802, datum_string=F.when(~click, F.col("props")), datum_missing=click),
    )
    # every third click brings the old row along, so its props are known after all
    old = F.array(
        datum("user_id", 20, datum_int64=F.col("user_id")),
        datum("props", 3802, datum_string=F.when(F.col("user_id") % 3 == 0, F.col("props"))),
    )
    info = F.transform(
        new, lambda d: F.struct(F.lit("").alias("modifier"), F.lit(True).alias("value_optional"))
    ).cast(f"array<{TYPE_INFO.simpleString()}>")
    code = F.when(F.col("event_type") == "signup", 0).when(F.col("event_type") == "error", 2)
    return e.select(
        F.col("event_id").alias("seq"),
        (F.lit(16777216) + F.col("event_id") * 64).alias("lsn"),
        (F.lit(500) + F.floor(F.col("event_id") / 5.0)).cast("int").alias("transaction_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("commit_time"),
        F.lit('"public"."events"').alias("table"),
        code.otherwise(1).alias("op"),
        F.when(F.col("event_type") != "error", new).alias("new_tuple"),
        old.alias("old_tuple"),
        F.when(F.col("event_type") != "error", info).alias("new_typeinfo"),
    )

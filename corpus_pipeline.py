"""A corpus pipeline: quality, near-duplicates, repeated passages, packing.

``STAGES`` are functions of (spark, docs, sf_dir). Each stage's rows are written as Parquet
and read again as the next one's ``docs``; all but the last have the columns of
``documents``. Null texts do not crash a stage: the first one drops them, as it drops
texts without words. Ids may repeat or be null; rows count one by one. Columns beyond those of
``documents`` are carried along, whatever their names. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, quality, simhash, suffix_dedup
from tidemark.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, unchanged."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    named = plain.withColumn("text", F.col(f"c{docs.columns.index('text')}"))
    judged = quality.classify(named, columns=plain.columns)
    return judged.filter("kept").select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, by the SimHash operator with its 4-word shingles
    and at most 4 differing bits: the smallest id (nulls last), then the smallest text hash; of
    equal rows one stays."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    mark = F.xxhash64(text, F.lit("row"))
    rows = plain.select(key.alias("doc_id"), text.alias("text"), mark.alias("mark"))
    marked = stored(simhash.fingerprints(rows, ["doc_id", "mark"]), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    # one row per fingerprint before the join, so a text copied very often is no hot key there
    lowest = marked.groupBy("fp").agg(F.min(order).alias("first")).join(simhash.classes(marked, "root"), "fp")
    # one row per group, and how many equal rows it stands for
    first = lowest.groupBy("root").agg(F.min("first").alias("first"))
    equal = marked.groupBy("doc_id", "mark").count()
    kept = first.select("first.doc_id", "first.mark").join(
        equal.withColumnsRenamed({"doc_id": "id", "mark": "m"}), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("m"))
    ).select("doc_id", "mark", "count")
    out = plain.join(kept, key.eqNullSafe(F.col("doc_id")) & (mark == F.col("mark")))
    single = out.filter("count = 1").select(*plain.columns)
    # equal ids and texts: seldom, so only these rows are shuffled once more
    several = out.filter("count > 1").dropDuplicates(["doc_id", "mark"]).select(*plain.columns)
    return single.unionByName(several).toDF(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that the suffix dedup removes; characters cut in two
    go whole, ``n_chars`` counts what is left, no row is dropped."""
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {c: f"c{docs.columns.index(c)}" for c in ("doc_id", "text", "n_chars")}
    named = plain.withColumn("doc_id", F.col(at["doc_id"])).withColumn("text", F.col(at["text"]))
    cut = suffix_dedup.dedup(named, keep=True, columns=[c for c in plain.columns if c not in (at["text"], at["n_chars"])])
    cut = cut.withColumn(at["text"], F.col("kept_text"))
    cut = cut.withColumn(at["n_chars"], F.length("kept_text").cast("long"))
    return cut.select(*plain.columns).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)


#: SQL cannot express the trained scorer; the stages are tested against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": pipeline}
SQL: dict[str, str] = {}

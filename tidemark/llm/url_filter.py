"""URL filter: host-suffix and path-prefix expressions joined to rules by hash prefix.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts
with the rule's path. The longest fitting rule wins; of rules of equal length the one
with the longer host, then ``block``. A URL that no rule fits gets ``default``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PREFIX_HEX = 8
#: The rules of the registered query: fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.translate(raw, UPPER, UPPER.lower()), F.regexp_extract(after, r"^[^?#]*", 0)


def decide(keys: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``rule`` and ``verdict`` for every row of ``keys`` (distinct ``host``, ``path``).

    Rule paths are cut at as many lengths as the rules have, and hosts at each dot. All
    expressions of a URL go through one equi-join on the first hex digits of their
    SHA-256; the full digest then confirms.
    """
    spark = keys.sparkSession
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
        if lengths
        else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    both = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    urls = keys.select("host", "path", F.explode(both).alias("expression"))
    urls = urls.withColumn("digest", F.sha2("expression", 256)).drop("expression")
    best = F.max(F.struct(F.length("rule"), F.length("rule_host"),
                          (F.col("rule_verdict") == "block"), "rule", "rule_verdict"))
    known = rules.select(
        F.concat("host", "path").alias("rule"),
        F.col("host").alias("rule_host"),
        F.col("verdict").alias("rule_verdict"),
    ).withColumn("rule_digest", F.sha2("rule", 256))
    # Spark broadcasts the rules only if their size is under its threshold
    hits = (
        urls.withColumn("short", F.substring("digest", 1, PREFIX_HEX))
        .join(known.withColumn("short", F.substring("rule_digest", 1, PREFIX_HEX)), "short")
        .filter("digest = rule_digest")
        .groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", F.col("best.rule_verdict").alias("verdict"))
    )
    return (
        keys.join(hits, ["host", "path"], "left")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
        .select("host", "path", "rule", "verdict")
    )


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages``.

    Reads ``page_id`` and ``url`` only, so other columns cannot clash. A null URL or one
    without ``://`` has an empty host and path and gets the default. Rows with equal or
    null ``page_id`` are judged one by one; repeated rows stay. Each distinct host and
    path is judged once, so a very frequent URL costs one expansion. An empty table
    gives an empty result, empty rules give the default everywhere.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = decide(urls.select("host", "path").distinct(), rules, default)
    return urls.join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict")

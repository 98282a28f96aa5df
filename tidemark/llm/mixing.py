"""Mixing sources to target weights by hash thresholds.

A document's place in its source is a hash, so "the first so many words in hash order" is a
random sample that any executor can test for by itself once the threshold is known. The
threshold is found from histograms: words are summed by source and hash bucket, the bucket
in which the budget ends is cut into finer buckets, and so on. Only rows of that one
bucket are looked at again. A larger budget has a higher threshold, so mixes are nested.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.plans.order import number_rows

#: Bits of the hash, and bits that one histogram looks at. A source has at most 2**12 buckets.
HASH_BITS = 60
STEP = 12
#: Parts of a source in the join of documents with sources.
SALTS = 32
#: White space of the word rule: space and the characters from tab to carriage return.
SPACE = "\\x20\\x09-\\x0D"
BIG = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Number of runs without white space; 0 for null. No list of words is made."""
    ones = F.regexp_replace(text, f"[^{SPACE}]+", "x")
    return F.coalesce(F.length(F.regexp_replace(ones, f"[{SPACE}]+", "")), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column, seed: int) -> Column:
    """60 bits of the MD5 of seed, id and text: the same in every run and on every executor."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _source_key(source: Column) -> Column:
    """Sources in code-point order with null last, as text that is never null."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def targets(sizes: DataFrame, weights: tuple, budget: tuple[int, int], most: int) -> DataFrame:
    """Per source: ``target`` and what the draw needs, as whole numbers.

    ``sizes`` has ``src, source_size``. Of ``budget`` (a ratio) times all words a source gets
    a share by its weight, and no more than ``most`` times its own size; what it cannot
    take is shared anew among the others. Shares only grow from round to round, so sources
    that are full stay full; a round is one aggregate over the sources.
    """
    numbered = number_rows(sizes, [F.col("src")], "at")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    rows = stored(numbered.select("src", F.col("source_size").cast(BIG).alias("s"), weight.cast(BIG).alias("w")), "mix-sources")
    total, all_weights = rows.agg(F.sum("s"), F.sum("w")).first()
    num, den, full = int(total or 0) * budget[0], max(1, int(all_weights or 0)) * budget[1], -1
    whole = int(total or 0) * budget[0]
    while True:  # the share per weight is num / den
        share = F.col("w") * F.lit(str(num)).cast(BIG)
        above = F.lit(most).cast(BIG) * F.col("s") * F.lit(str(den)).cast(BIG) < share
        n, filled, rest = rows.agg(
            F.count_if(above), F.sum(F.when(above, F.col("s"))), F.sum(F.when(~above, F.col("w")))
        ).first()
        if n == full or not rest:
            break
        full = n
        num, den = whole - budget[1] * most * int(filled or 0), budget[1] * int(rest)
    times = F.when(above, F.lit(most)).when(F.col("s") == 0, F.lit(0)).otherwise(
        F.expr(f"CAST(w * CAST('{num}' AS {BIG}) AS {BIG}) div CAST(greatest(s, 1) * CAST('{den}' AS {BIG}) AS {BIG})"))
    owed = F.when(above, F.lit(0)).otherwise(share - F.col("times") * F.col("s") * F.lit(str(den)).cast(BIG))
    target = F.when(above, F.col("s").cast("double") * most).otherwise(F.col("w").cast("double") * F.lit(num / den))
    return rows.withColumn("times", times.cast("long")).select(
        "src", F.col("s").cast("long").alias("source_size"), target.alias("target"), "times",
        # the rest of the target, in units of 1 / den
        owed.cast(BIG).alias("owed"), F.lit(str(den)).cast(BIG).alias("den"),
    )


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``src, cut``: documents whose place is below ``cut`` are taken once more.

    ``rows`` has ``src, size, h``. The document in which the budget ends is taken if that
    brings the sum nearer to it.
    """
    budgets = sources.filter("owed > 0").select("src", "owed", "den")
    open_rows, before = rows, None
    done = []
    for shift in range(HASH_BITS - STEP, -1, -STEP):
        cell = F.shiftright("h", shift).alias("cell")
        cells = open_rows.groupBy("src", cell).agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        joined = cells.join(budgets, "src")
        base = F.lit(0).cast("long") if before is None else F.col("base")
        joined = joined if before is None else joined.join(before.select("src", F.col("prev").alias("base")), "src")
        # at most 2**STEP rows a source: the sums are made before this shuffle
        upto = F.sum("n").over(Window.partitionBy("src").orderBy("cell")) + base
        sums = stored(joined.withColumn("cum", upto).withColumn("prev", F.col("cum") - F.col("n")), "mix-cells")
        big = lambda c: F.col(c).cast(BIG) * F.col("den")
        inside = big("cum") <= F.col("owed")
        border = (big("prev") < F.col("owed")) & ~inside
        one = F.col("lo") == F.col("hi")
        nearer = (F.col("cum") + F.col("prev")).cast(BIG) * F.col("den") <= 2 * F.col("owed")
        taken = inside | (border & one & nearer)
        refine = border & ~one if shift else F.lit(False)
        found = sums.groupBy("src").agg(
            F.max(F.when(taken, F.col("hi") + 1)).alias("above"),
            F.min(F.col("lo")).alias("start"),
            F.max(F.when(refine, F.struct("cell", "prev"))).alias("border"),
        )
        found = stored(found, "mix-borders")
        # a source whose border is cut further settles later
        done.append(found.filter("border IS NULL").select("src", F.coalesce("above", "start").alias("cut")))
        before = found.filter("border IS NOT NULL").select("src", "border.cell", "border.prev")
        if not shift or before.isEmpty():
            break
        open_rows = stored(open_rows.withColumn("cell", cell).join(before.select("src", "cell"), ["src", "cell"]).select("src", "size", "h"), "mix-border-rows")
    return reduce(DataFrame.unionByName, done)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    budget: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: int = 1,
) -> DataFrame:
    """How many words of each document a mix of ``budget`` times all words takes.

    Returns ``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.
    Sources in code-point order, null last, weigh ``weights`` in turn; a source's
    target is at most ``most`` times its words. A source is taken as often as it fits whole into its
    target; the rest goes to the documents with the lowest hashes of seed, id and text. ``taken``
    is a whole multiple of ``size``. A source's sum differs from its target by at most
    half of the document in which the target ends.

    Null texts and texts of white space have size 0 and are taken 0 words. A null id is an id
    like any other. Rows alike in source, id and text have one place, so all of them are
    taken equally often. Empty table, empty result. Columns with other names are left out.
    """
    size, h = word_count(F.col("text")), place(F.col("doc_id"), F.col("text"), seed)
    # texts are read once; what follows reads four narrow columns
    rows = stored(docs.select("doc_id", "source", _source_key(F.col("source")).alias("src"), size.alias("size"), h.alias("h")), "mix-rows")
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    sources = stored(targets(sizes, weights, budget, most), "mix-targets")
    cuts = thresholds(rows, sources)
    plan = sources.join(cuts, "src", "left").select("src", "source_size", "target", "times", F.coalesce("cut", F.lit(0)).alias("cut"))
    # in salts, so that a source with a third of all rows is no single key
    plan = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    out = rows.withColumn("salt", (F.col("h") % SALTS).cast("int")).join(stored(plan, "mix-plan"), ["src", "salt"])
    taken = F.col("size") * (F.col("times") + (F.col("h") < F.col("cut")).cast("long"))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))

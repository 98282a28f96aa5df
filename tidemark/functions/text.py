"""Text analysis: words, word counts, and edit distance, as built-in expressions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes name frequent characters first: a class is tested from left to right, and asking for a
#: character's script is slow. All Han characters are above the bound.
HAN_CHAR = r"[\x{2E80}-\x{3FFFF}&&\p{IsHan}]"
OTHER_CHAR = r"[a-z0-9ß-öø-ÿ[\p{L}\p{N}&&[^\p{IsHan}]]]"
#: a run of letters and digits, or of Han characters
WORD = f"{OTHER_CHAR}+|{HAN_CHAR}+"
HAN = f"^{HAN_CHAR}"
#: what lies between the words of a text without Han characters
BETWEEN = r"[^a-z0-9ß-öø-ÿ\p{L}\p{N}]+"
#: what may stand before a word
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F[^\p{L}\p{N}\p{IsHan}]]*"


def _lowered(text: Column) -> Column:
    """Lower case with as many characters: the one letter that would become two is replaced."""
    return F.lower(F.replace(text, F.lit("İ"), F.lit("i")))


def tokens(text: Column) -> Column:
    """Lower-case words; a run of Han characters becomes its overlapping pairs.

    A text without Han characters is split, which takes half as long as to extract its words.
    """
    words = F.regexp_extract_all(_lowered(text), F.lit(WORD), F.lit(0))
    split = F.array_remove(F.split(_lowered(text), BETWEEN), "")

    def pairs(word: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(word) - 1)
        return F.when(
            word.rlike(HAN) & (F.length(word) > 1),
            F.transform(starts, lambda i: F.substring(word, i, F.lit(2))),
        ).otherwise(F.array(word))

    return F.when(text.rlike(HAN_CHAR), F.flatten(F.transform(words, pairs))).otherwise(split)


def with_running_totals(df: DataFrame, values: str, name: str) -> DataFrame:
    """Add the sums of the integer array ``values`` up to each element.

    Sums are made in chunks of about the root of its size, since appending to an array
    copies it. Each step is a column of its own that the next one uses twice, so the planner
    does not work it out again within a loop.
    """

    def sums(part: Column, base: Column) -> Column:
        grown = F.aggregate(part, F.array(base), lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x)))
        return F.slice(grown, F.lit(2), F.size(part))

    count = F.size(values)
    none = F.array().cast("array<int>")
    chunks = F.when(count > 0, F.transform(
        F.sequence(F.lit(0), F.col("_chunk") - 1),
        lambda c: F.slice(values, c * F.col("_step") + 1, F.col("_step")),
    )).otherwise(F.array().cast("array<array<int>>"))
    totals = F.transform("_chunks", lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x))
    ends = F.transform("_chunks", lambda c, i: sums(c, F.when(i > 0, F.element_at("_bases", F.greatest(i, F.lit(1)))).otherwise(0)))
    return (
        df.withColumn("_step", F.greatest(F.ceil(F.sqrt(count)), F.lit(1)).cast("int"))
        .withColumn("_chunk", F.ceil(count / F.col("_step")).cast("int"))
        .withColumn("_chunks", chunks)
        .withColumn("_bases", sums(totals, F.lit(0)))
        .withColumn(name, F.when(F.size("_bases") > 0, F.flatten(ends)).otherwise(none))
        .drop("_step", "_chunk", "_chunks", "_bases")
    )


def with_spans(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add array<struct<term, start>>: the words of ``tokens`` and where they start, from 1."""
    low = df.withColumn("_low", _lowered(F.col(text)))
    found = low.withColumn("_words", F.regexp_extract_all("_low", F.lit(WORD), F.lit(0))).withColumn(
        "_pieces", F.transform(F.regexp_extract_all("_low", F.lit(f"{GAP}(?:{WORD})"), F.lit(0)), F.length)
    )
    found = with_running_totals(found, "_pieces", "_ends")
    spans = F.zip_with(
        "_words", "_ends", lambda w, end: F.struct(w.alias("term"), (end - F.length(w) + 1).alias("start"))
    )

    def pairs(span: Column) -> Column:
        word = span["term"]
        one = lambda i: F.struct(F.substring(word, i, F.lit(2)).alias("term"), (span["start"] + i - 1).alias("start"))
        return F.when(
            word.rlike(HAN) & (F.length(word) > 1), F.transform(F.sequence(F.lit(1), F.length(word) - 1), one)
        ).otherwise(F.array(span))

    return (
        found.withColumn("_spans", spans)
        .withColumn(name, F.when(F.col("_low").rlike(HAN_CHAR), F.flatten(F.transform("_spans", pairs))).otherwise(F.col("_spans")))
        .drop("_low", "_words", "_pieces", "_ends", "_spans")
    )


def with_term_places(df: DataFrame, spans: str, name: str) -> DataFrame:
    """Add array<struct<term, tf, starts>> for the array column ``spans``.

    Counting by runs of the sorted words keeps a text within its row, so postings need
    no shuffle. Each step is a column of its own: it is used twice by the next one and
    is not worked out again.
    """
    count = F.size("_sorted")
    shifted = F.concat(
        F.array(F.lit(None).cast("string")),
        F.slice("_terms", F.lit(1), F.greatest(count - 1, F.lit(0))),
    )
    heads = F.zip_with("_terms", shifted, lambda w, before: F.when(~w.eqNullSafe(before), w))
    runs = F.array_compact(
        F.transform(
            F.slice(heads, F.lit(1), count),
            lambda w, i: F.when(w.isNotNull(), F.struct(w.alias("term"), i.alias("at"))),
        )
    )
    ends = F.concat(
        F.slice(F.col("_runs.at"), F.lit(2), F.greatest(F.size("_runs"), F.lit(1))), F.array(count)
    )
    counted = F.zip_with(
        "_runs", ends,
        lambda r, end: F.struct(
            r["term"].alias("term"), (end - r["at"]).alias("tf"),
            F.slice("_starts", r["at"] + 1, end - r["at"]).alias("starts"),
        ),
    )
    return (
        df.withColumn("_sorted", F.sort_array(spans))
        .withColumn("_terms", F.col("_sorted.term"))
        .withColumn("_starts", F.col("_sorted.start"))
        .withColumn("_runs", runs)
        .withColumn(name, F.when((count > 0) & (F.size("_starts") > 0), counted))
        .drop("_sorted", "_terms", "_starts", "_runs")
    )


def with_term_counts(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add array<struct<term, tf>>, by term, for the array column ``words``: a text stays within its row."""
    count = F.size("_sorted")
    fresh = lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1))
    heads = F.when(count > 0, F.filter(F.sequence(F.lit(0), count - 1), fresh))
    counted = F.transform("_heads", lambda at, i: F.struct(
        F.get("_sorted", at).alias("term"), (F.coalesce(F.get("_heads", i + 1), count) - at).alias("tf")))
    return (
        df.withColumn("_sorted", F.sort_array(words))
        .withColumn("_heads", heads)
        .withColumn(name, counted)
        .drop("_sorted", "_heads")
    )


# ---- edit distance ------------------------------------------------------------------


def max_edits(word: Column) -> Column:
    """Edits allowed for a word: none up to 2 letters, 1 up to 5, else 2."""
    size = F.length(word)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def _swapped(word: Column, i: Column) -> Column:
    """The word with its letters ``i`` and ``i + 1`` exchanged."""
    return F.concat(
        F.substring(word, F.lit(1), i - 1),
        F.substring(word, i + 1, F.lit(1)),
        F.substring(word, i, F.lit(1)),
        F.substring(word, i + 2, F.length(word)),
    )


def _places(word: Column) -> Column:
    size = F.length(word)
    return F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _swap_beside_insert(short: Column, long: Column) -> Column:
    """Whether one swap and one insert, apart from each other, lead from short to long."""
    size_s, size_l = F.length(short), F.length(long)

    def at(i: Column, shift: int) -> Column:
        j = i + shift
        pair = (F.substring(short, i, F.lit(1)) == F.substring(long, j + 1, F.lit(1))) & (
            F.substring(short, i + 1, F.lit(1)) == F.substring(long, j, F.lit(1))
        )
        left = F.levenshtein(
            F.substring(short, F.lit(1), i - 1), F.substring(long, F.lit(1), j - 1)
        )
        right = F.levenshtein(
            F.substring(short, i + 2, size_s), F.substring(long, j + 2, size_l)
        )
        return pair & (left + right <= 1)

    return F.exists(_places(short), lambda i: at(i, 0) | at(i, 1))


def edit_distance(a: Column, b: Column) -> Column:
    """Edits from ``a`` to ``b`` where exchanging two neighbours is one edit and no
    letter is edited twice: 0, 1 or 2; null above."""
    plain = F.levenshtein(a, b, 4)
    same_size = F.length(a) == F.length(b)
    one_swap = F.exists(_places(a), lambda i: _swapped(a, i) == b)
    swap_and_edit = F.exists(
        _places(a),
        lambda i: (F.levenshtein(_swapped(a, i), b) <= 1)
        | F.exists(_places(a), lambda j: _swapped(_swapped(a, i), j) == b),
    )
    apart = (
        F.when(same_size, swap_and_edit)
        .when(F.length(b) - F.length(a) == 1, _swap_beside_insert(a, b))
        .when(F.length(a) - F.length(b) == 1, _swap_beside_insert(b, a))
        .otherwise(False)
    )
    return (
        F.when(plain.isin(0, 1), plain)
        .when(plain == 2, F.when(same_size & one_swap, 1).otherwise(2))
        .when(plain.isin(3, 4), F.when(apart, 2))
    )


# ---- keys by which similar words meet -----------------------------------------------

#: letters of a word that its keys are made of
KEY_LETTERS = 6
#: places of none, one and two letters left out, from 0; a place behind the letters leaves out none
DELETIONS = [
    [(KEY_LETTERS, KEY_LETTERS)],
    [(i, KEY_LETTERS) for i in range(KEY_LETTERS)],
    list(combinations(range(KEY_LETTERS), 2)),
]


def head(word: Column) -> Column:
    """The letters of a word that its keys are made of."""
    return F.substring(word, 1, KEY_LETTERS)


def deletion_keys(word: Column, edits: Column) -> Column:
    """A word's first letters and what up to ``edits`` (0 to 2) deletions leave of them, hashed.

    Words within that distance share a key: an edit takes at most one letter from what
    the two beginnings have in common, be it changed, exchanged, or pushed out at the end.
    A word has at most 22 keys, however long it is. A key is 32 bits: words that share one
    by chance are told apart by their distance.
    """
    # a loop: written out, the code of all keys is too long a method for the JVM to compile
    letters = head(word)

    def key(gap: Column) -> Column:
        i, j = gap["i"], gap["j"]
        return F.hash(F.concat(F.substring(letters, F.lit(1), i), F.substring(letters, i + 2, j - i - 1), F.substring(letters, j + 2, F.lit(KEY_LETTERS))))

    def gaps(n: int) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for g in DELETIONS[: n + 1] for i, j in g])

    return F.array_distinct(F.transform(F.when(edits == 0, gaps(0)).when(edits == 1, gaps(1)).otherwise(gaps(2)), key))


# ---- numbers ------------------------------------------------------------------------

DECIMAL = "decimal(38,6)"


def number_text(value: Column) -> Column:
    """The one text form of a number: no exponent, up to six places, no closing zeros.

    Null for what is no number or has over 32 digits before the point.
    """
    # there are always six places, so zeros before the point stay
    return F.rtrim(F.rtrim(value.try_cast(DECIMAL).cast("string"), F.lit("0")), F.lit("."))


def typed_numbers(keyword: Column) -> Column:
    """The parts of a keyword, between spaces, that are numbers, in their text form."""
    parts = F.filter(F.split(keyword, r"\s+"), lambda p: p.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"))
    return F.array_distinct(F.array_compact(F.transform(parts, number_text)))

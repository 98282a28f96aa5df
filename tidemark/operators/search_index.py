"""A search index as tables below a path, in generations.

A generation holds documents and what was made of them; it is written once. ``update`` adds
a generation for the documents that change and notes which older copies are dead;
``merge`` writes the live rows of all generations as one. The manifest says which
generations count and is written last, so a run that fails leaves the index as it was.

Tables of a generation:

- ``docs``: the documents, by a hash of the id, so that a page reads the parts of its hits;
- ``postings``: a row per word, document and field, with its count. Per word, field and block of
  neighbouring documents the first of them also holds what bounds their scores, and lies in a
  folder of its own: the blocks;
- ``sources``: index, schema, table and field by the number that postings have for them;
- ``places``: the id of each document by its place, so that postings need not repeat it;
- ``terms``, ``fields``: changes of the document counts and lengths, which add up;
- ``near``: keys of the first letters of new words, by which misspelt ones are found;
- ``heads``: the new words by their first letters;
- ``exact``: the whole value of each text field;
- ``dead``: which documents of older generations no longer count.

Postings lie in folders by word and are bucketed by block. A query reads the folders of its
words. All postings of a document are in one bucket, so scores are summed where they are
read, and no hit is shuffled before the best are chosen.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text as X
from tidemark.plans.scratch import materialise

#: Documents whose scores one bound covers. They are neighbours in the order of ties.
BLOCK = 32
#: bits of a block's number within the generation that made it
BLOCK_BITS = 46
ID = ["_index", "_id"]
#: document columns that searches filter and order by
CARRIED = ["_schema", "_table", "_sync_timestamp"]
#: values up to this length stand for themselves in the exact table, longer ones by digest
LONG_VALUE = 64
TEXT, NUMBER = "text", "number"
#: ids, blocks and keys repeat much, so the tables are packed tighter than by default
CODEC = "zstd"

MANIFEST = (
    "version long, folder string, number long, covers array<string>, buckets int, parts int, "
    "fields array<struct<name: string, kind: string>>, columns string"
)
#: the bounds are null but for the first of its block, and where it is the only one
POSTINGS = (
    "term string, source long, tf int, field_len int, head int, seat int, block long, "
    "max_tf int, min_len int, docs long, bucket int, more int"
)
SOURCES = "source long, _index string, _schema string, _table string, field string"
PLACES = "block long, seat int, _index string, _id string, _sync_timestamp string"
TERMS = "term string, _index string, field string, df long, bucket int"
FIELDS = "_index string, field string, docs long, total long"
NEAR = "head string, key int, bucket int"
HEADS = "head string, term string, bucket int"
EXACT = (
    "field string, value string, _index string, _id string, block long, "
    "_schema string, _table string, _sync_timestamp string, bucket int"
)
DEAD = "_index string, _id string, block long, seat int, number long"
#: tasks write rows of up to so many folders side by side, which saves ordering them by folder
OPEN_FOLDERS = 64
#: bytes that each of these files holds back
HELD_BACK = 8 << 20


def seat_of(at: Column) -> Column:
    """A document's number within its block."""
    return at.bitwiseAND(F.lit(BLOCK - 1)).cast("int")


def at_of(block: Column, seat: Column) -> Column:
    """The place in the order of ties that a generation gave a document."""
    return F.shiftleft(block.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)), BLOCK.bit_length() - 1) + seat


def searchable_fields(docs: DataFrame) -> dict[str, str]:
    """Kind of each searchable column: text, which is split into words, or number.

    Ids and the carried columns are none; nor are columns of other types (truth values, bytes, nested
    ones). Documents hold times as text, so they are found by their words.
    """
    own = {*ID, *CARRIED}
    out = {}
    for f in docs.schema:
        if f.name not in own and isinstance(f.dataType, T.StringType):
            out[f.name] = TEXT
        elif f.name not in own and isinstance(f.dataType, T.NumericType):
            out[f.name] = NUMBER
    return out


def _carried(docs: DataFrame) -> list[Column]:
    none = F.lit(None).cast("string")
    return [(F.col(c) if c in docs.columns else none).alias(c) for c in CARRIED]


def field_texts(docs: DataFrame, fields: dict[str, str], more: list[str]) -> DataFrame:
    """A row per document and filled text field."""
    names = [f for f, kind in fields.items() if kind == TEXT and f in docs.columns]
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in names])
    rows = docs.select(*ID, *_carried(docs), *more, F.explode(texts if names else F.array().cast("array<struct<field:string,text:string>>")).alias("f"))
    return rows.filter("f.text IS NOT NULL").select(*ID, *CARRIED, *more, "f.field", "f.text")


def source_of() -> Column:
    """A number for index, schema, table and field, which all postings would repeat; null is a value of its own."""
    names = ["_index", *CARRIED[:2], "field"]
    return F.xxhash64(*[c for n in names for c in (F.isnull(n), F.col(n))])


def sources(docs: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Index, schema, table and field by their number."""
    every = F.explode(F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>"))
    kinds = docs.select("_index", *_carried(docs)[:2]).distinct().withColumn("field", every)
    return kinds.select(source_of().alias("source"), *kinds.columns)


def postings(docs: DataFrame, fields: dict[str, str], more: list[str] = (), coded: bool = False) -> DataFrame:
    """A row per word, document and field: its count and the field's length.

    A number is one word of its own kind: its text form. Documents are told apart by ``more`` alone.
    ``coded`` rows have the number of their source, others index and field.
    """
    more, kept, named = list(more), ["source"] if coded else ["_index", "field"], ["_index", *CARRIED[:2], "field"]
    code = lambda rows: rows.withColumn("source", source_of()) if coded else rows
    words = code(field_texts(docs, fields, more).select(*named, *more, X.tokens(F.col("text")).alias("words"))).select(*kept, *more, "words")
    # The length is taken first, so that exploding copies no word lists. Of an inner
    # explode the planner would make a filter that works out the words once more.
    sized = X.with_term_counts(words.withColumn("field_len", F.size("words")), "words", "counts").drop("words")
    exploded = sized.select(*kept, *more, "field_len", F.posexplode_outer("counts").alias("place", "c"))
    split = exploded.filter("c IS NOT NULL").select(
        F.col("c.term").alias("term"), *kept, F.col("c.tf").alias("tf"), "field_len",
        # one posting per document and field counts for both
        (F.col("place") == 0).cast("int").alias("head"), *more,
    )
    names = [f for f, kind in fields.items() if kind == NUMBER and f in docs.columns]
    if not names:
        return split
    # a whole number's text is its text form
    value = lambda f: F.col(f).cast("string") if isinstance(docs.schema[f].dataType, T.IntegralType) else X.number_text(F.col(f))
    numbers = F.array(*[F.struct(value(f).alias("term"), F.lit(f).alias("field")) for f in names])
    one = F.lit(1)
    values = docs.select("_index", *_carried(docs)[:2], *more, F.explode(numbers).alias("n")).filter("n.term IS NOT NULL")
    values = code(values.withColumn("field", F.col("n.field")))
    return split.unionByName(values.select(
        F.col("n.term").alias("term"), *kept, one.alias("tf"), one.alias("field_len"), one.alias("head"), *more,
    ))


def with_bounds(rows: DataFrame) -> DataFrame:
    """Postings with what no score in their block exceeds, and ``more``: 0 for the first of its block, which holds
    it, else 1. All postings of a block are in one task."""
    # the word first: it tells most rows apart, so ordering them is little work
    block = Window.partitionBy("term", "block", "source")
    found = rows.withColumns({
        "more": (F.col("seat") != F.min("seat").over(block)).cast("int"),
        "max_tf": F.max("tf").over(block), "min_len": F.min("field_len").over(block), "docs": F.count(F.lit(1)).over(block),
    })
    held = (F.col("more") == 0) & (F.col("docs") > 1)
    return found.select(*rows.columns, "more", *[F.when(held, F.col(c)).alias(c) for c in ("max_tf", "min_len", "docs")])


def exact_key(value: Column) -> Column:
    """A whole value, or the digest of a long one."""
    return F.when(F.length(value) <= LONG_VALUE, value).otherwise(F.concat(F.lit("sha256:"), F.sha2(value, 256)))


def term_counts(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents per word, by index and field. One source stands for all of an index and field."""
    one = sources.groupBy("_index", "field").agg(F.min("source").alias("one"))
    by = F.col("s._index").eqNullSafe(F.col("o._index")) & (F.col("s.field") == F.col("o.field"))
    stands = materialise(sources.alias("s").join(one.alias("o"), by).select("source", "one"), "sources")
    counts = blocks.join(stands, "source").groupBy("term", "one").agg(F.sum("docs").alias("df"))
    return counts.join(sources.select(F.col("source").alias("one"), "_index", "field"), "one").select("term", "_index", "field", "df")


def field_totals(rows: DataFrame) -> DataFrame:
    """Documents and words per index and field."""
    return rows.groupBy("_index", "field").agg(F.sum("head").alias("docs"), F.sum("tf").alias("total"))


def near_keys(terms: DataFrame) -> DataFrame:
    """Keys of the vocabulary. Words of up to three letters are only reached by words that allow one edit.

    Keys are made of a word's first letters, so those stand for all words that begin so.
    """
    word = F.col("term")
    keys = X.deletion_keys(word, F.when(F.length(word) <= 3, 1).otherwise(2))
    return terms.select("term", F.explode(keys).alias("key"))


@dataclass(frozen=True)
class Generation:
    folder: str
    number: int
    columns: str  # the documents' schema


@dataclass(frozen=True)
class SearchIndex:
    """An index below ``path`` as its manifest stands when it is opened."""

    spark: SparkSession
    path: str
    buckets: int
    parts: int
    fields: tuple[tuple[str, str], ...]
    generations: tuple[Generation, ...]

    # ---- writing --------------------------------------------------------------------

    @staticmethod
    def write(
        docs: DataFrame,
        path: str,
        fields: list[str] | None = None,
        buckets: int = 32,
        parts: int | None = None,
    ) -> SearchIndex:
        """Build an index of ``docs``, one row per (``_index``, ``_id``).

        Words and ids are looked up in ``buckets`` folders; ``parts`` tasks share each, by
        default as many as a shuffle has.
        """
        spark = docs.sparkSession
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        kinds = searchable_fields(docs)
        kinds = kinds if fields is None else {f: kinds[f] for f in fields}
        index = SearchIndex(spark, path, buckets, parts, tuple(kinds.items()), ())
        with index._side_by_side():
            made = index._write_generation(docs, 1, kinds)
        return index._finish(made, [])

    @staticmethod
    def open(spark: SparkSession, path: str) -> SearchIndex:
        rows = spark.read.schema(MANIFEST).json(f"{path}/manifest").orderBy("version").collect()
        covered = {c for r in rows for c in r.covers}
        live = tuple(Generation(r.folder, r.number, r.columns) for r in rows if r.folder not in covered)
        fields = {f.name: f.kind for r in rows for f in r.fields}
        return SearchIndex(spark, path, rows[-1].buckets, rows[-1].parts, tuple(fields.items()), live)

    def update(self, docs: DataFrame | None = None, deleted: DataFrame | None = None) -> SearchIndex:
        """Replace or add ``docs`` and remove the documents of ``deleted`` (``_index, _id``).

        A document in both is replaced. What is written grows with the documents given and the copies they replace.
        Counts change by difference: up by the new documents, down by the old ones.
        """
        if docs is None and deleted is None:
            return self
        number = max(g.number for g in self.generations) + 1
        kinds = dict(self.fields)
        gone = [d.select(*ID) for d in (docs, deleted) if d is not None]
        ids = reduce(DataFrame.unionByName, gone).distinct().withColumn("slot", self._slot())
        # only where they are is written; their texts are read once more
        whole = self.located(materialise(ids, "changed-ids"))
        old = materialise(whole.select(*ID, "block", "at", "number"), "replaced-documents")
        if docs is not None:
            kinds = {**searchable_fields(docs), **kinds}
        texts = whole.drop("slot", "block", "at", "number")
        new = docs if docs is not None else texts.limit(0)
        with self._side_by_side():
            made = self._write_generation(new, number, kinds, old, texts)
        return self._finish(made, [], kinds)

    def patch(self, ops: DataFrame, columns: list[str], seq: str) -> SearchIndex:
        """Apply queued operations (INDEX, UPDATE of ``_fields``, DELETE) in order of ``seq``.

        Only the documents that are named are read, folded and written anew.
        """
        from tidemark.operators.sinks import apply_ops

        ids = materialise(ops.select(*ID).distinct().withColumn("slot", self._slot()), "patched-ids")
        before = self.located(ids).drop("slot", "block", "at", "number")
        after = materialise(apply_ops(before, ops, columns, seq), "patched-documents")
        return self.update(after, ids.select(*ID).join(after.select(*ID), ID, "left_anti"))

    def merge(self, keep: bool = True) -> SearchIndex:
        """One generation of all live rows. Texts are not analysed again.

        The generations it is made of stay for those who opened the index before; without ``keep`` they are
        removed once the new one counts.
        """
        if len(self.generations) == 1:
            return self
        number, folder = max(g.number for g in self.generations), f"merged-{uuid.uuid4().hex}"
        with self._side_by_side():
            made = self._write_merged(number, folder)
        merged = self._finish(made, [g.folder for g in self.generations])
        for g in [] if keep else self.generations:
            self._remove(g.folder)
        return merged

    def _remove(self, folder: str) -> None:
        for name in ("postings", "places"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(folder, name)}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _write_merged(self, number: int, folder: str) -> Generation:
        docs = self.docs(every=True)
        self._partitioned(docs.withColumn("slot", self._slot()), folder, "docs", "slot")
        # a generation after the other, so its postings stay in their buckets
        self.sources().write.parquet(f"{self.path}/{folder}/sources")
        for g in self.generations:
            self._write_postings(self.live(g, "postings"), folder)
            self._write_places(self.live(g, "places"), folder)
        self._partitioned(self.terms().filter("df > 0"), folder, "terms", "bucket")
        self._field_rows().write.option("compression", CODEC).parquet(f"{self.path}/{folder}/fields")
        made = Generation(folder, number, docs.schema.json())
        self._write_near(self._read(made, "terms", TERMS).filter(self._is(TEXT)).select("term"), folder)
        self._partitioned(self._union(self.live(g, "exact") for g in self.generations), folder, "exact", "bucket")
        return made

    def _finish(self, made: Generation, covers: list[str], kinds: dict | None = None) -> SearchIndex:
        fields = list((kinds or dict(self.fields)).items())
        row = [(time.time_ns(), made.folder, made.number, covers, self.buckets, self.parts, fields, made.columns)]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return SearchIndex.open(self.spark, self.path)

    def _write_generation(
        self, docs: DataFrame, number: int, kinds: dict[str, str], old: DataFrame | None = None, texts: DataFrame | None = None
    ) -> Generation:
        """``old``: where the copies are that this generation replaces; ``texts``: these copies."""
        folder = f"{number}-{uuid.uuid4().hex}"
        stamp = _carried(docs)[-1]
        order = [F.desc("_stamp"), F.col("_index"), F.col("_id")]
        ranged = docs.withColumn("_stamp", stamp).repartitionByRange(*order).sortWithinPartitions(*order)
        # the place in the order of ties; neighbours make a block, whose number no other generation has
        at = F.monotonically_increasing_id()
        placed = ranged.drop("_stamp").withColumn("at", at)
        placed = placed.withColumn("block", F.shiftleft(F.lit(number).cast("long"), BLOCK_BITS) + F.shiftright("at", BLOCK.bit_length() - 1))
        placed = placed.withColumn("slot", self._slot())
        # written from the range's tasks, so a text is not moved again for its folder
        self._folders(placed, folder, "docs", "slot")
        made = Generation(folder, number, placed.drop("slot").schema.json())
        stored = self._read_docs(made).withColumn("seat", seat_of(F.col("at")))
        values = field_texts(stored, kinds, ["block"]).withColumn("value", exact_key(F.col("text"))).drop("text")
        ids = stored.select("block", "seat", *ID, _carried(stored)[-1])
        self._at_once(
            # postings are made where the documents of a block are, and stay there
            lambda: self._write_postings(postings(stored.repartition(self.parts, "block"), kinds, ["seat", "block"], coded=True), folder),
            lambda: sources(stored, kinds).coalesce(1).write.parquet(f"{self.path}/{folder}/sources"),
            lambda: self._write_places(ids.repartition(self.parts, "block"), folder),
            lambda: self._folders(values.withColumn("bucket", self._bucket(F.xxhash64("field", "value"))), folder, "exact", "bucket"),
        )
        # the rest comes from the written tables, so texts are read once for all words
        known_sources, text = self._read(made, "sources", SOURCES), F.col("field").isin([f for f, k in kinds.items() if k == TEXT])
        summed = self._table(folder, "postings").groupBy("source").agg(F.sum("head").alias("head"), F.sum("tf").alias("tf"))
        totals = field_totals(summed.join(known_sources, "source"))
        # counts add up from the blocks, which are fewer rows than the postings
        counts = term_counts(self.blocks(made), known_sources)
        if old is not None:
            # added up before it is written: words are fewer than postings
            words = postings(texts, kinds).groupBy("term", "_index", "field")
            before = materialise(words.agg(F.sum("head").alias("head"), F.sum("tf").alias("tf"), F.sum(F.lit(-1)).alias("df")), "replaced-words")
            fewer = field_totals(before).withColumns({"docs": -F.col("docs"), "total": -F.col("total")})
            totals = totals.unionByName(fewer).groupBy("_index", "field").agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"))
            counts = counts.unionByName(before.select("term", "_index", "field", "df")).groupBy("term", "_index", "field").agg(F.sum("df").alias("df")).filter("df <> 0")
            old.select(*ID, "block", seat_of(F.col("at")).alias("seat"), "number").write.parquet(f"{self.path}/{folder}/dead")
        self._at_once(
            # dealt by word already, so no task gets a word's rows in bulk
            lambda: self._folders(counts.withColumn("bucket", self._bucket(F.xxhash64("term"))), folder, "terms", "bucket"),
            lambda: totals.write.option("compression", CODEC).parquet(f"{self.path}/{folder}/fields"),
        )
        if old is None:
            words = self._read(made, "terms", TERMS).filter(text).select("term")
        else:
            known = self._union(self._read(g, "terms", TERMS) for g in self.generations).filter(text).select("bucket", "term")
            words = self.blocks(made).join(known_sources, "source").filter(text).select("bucket", "term").distinct().join(known, ["bucket", "term"], "left_anti").select("term")
        self._write_near(words, folder)
        return made

    def _at_once(self, *writes) -> None:
        """Submit jobs that do not depend on each other together; Spark shares its cores among them."""
        with ThreadPoolExecutor(len(writes)) as pool:
            for done in [pool.submit(inheritable_thread_target(self.spark)(w)) for w in writes]:
                done.result()

    @contextmanager
    def _side_by_side(self):
        """Tasks keep the files of several folders open, so their rows keep their order and are not sorted by folder."""
        name = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(name)
        self.spark.conf.set(name, str(OPEN_FOLDERS))
        try:
            yield
        finally:
            self.spark.conf.set(name, before)

    def _write_postings(self, rows: DataFrame, folder: str) -> None:
        """Add postings, which are dealt by block already, with their bounds."""
        names = [c for c in rows.columns if c not in ("max_tf", "min_len", "docs", "bucket", "more")]
        found = with_bounds(rows.select(*names)).withColumn("bucket", self._bucket(F.xxhash64("term")))
        self._bucketed(found, folder, "postings", ["bucket", "more"], [])

    def _write_places(self, ids: DataFrame, folder: str) -> None:
        self._bucketed(ids, folder, "places", [], ["block", "seat"])

    def _write_near(self, terms: DataFrame, folder: str) -> None:
        """The words by their first letters, and keys of these. Many words begin alike, so the keys are far fewer
        than those of each word. Keys are made where the letters are and not shuffled; a fixed number of
        partitions, as words are small but each is much work."""
        # dealt by word, so no task gets all words that begin alike
        words = terms.distinct().repartition(self.parts, "term").select(X.head(F.col("term")).alias("head"), "term")
        words = words.sortWithinPartitions("head", "term").withColumn("bucket", self._bucket(F.xxhash64("head")))
        self._folders(words, folder, "heads", "bucket")
        written = self.spark.read.schema(HEADS).parquet(f"{self.path}/{folder}/heads")
        # by another number than the one they are told apart by, or the planner takes fewer partitions
        heads = written.select(F.col("head").alias("term")).distinct().repartition(self.parts, F.xxhash64("term"))
        keys = near_keys(heads).withColumnRenamed("term", "head")
        self._folders(keys.withColumn("bucket", self._bucket(F.col("key"))), folder, "near", "bucket")

    def _folders(self, rows: DataFrame, folder: str, name: str, by: str) -> None:
        """A table in folders, written from the tasks that ``rows`` are in."""
        writer = rows.write.option("compression", CODEC).option("parquet.block.size", HELD_BACK)
        writer.partitionBy(by).parquet(f"{self.path}/{folder}/{name}")

    def _partitioned(self, rows: DataFrame, folder: str, name: str, by: str) -> None:
        """A table in folders. Rebalancing splits a folder that is too large for one task,
        so a word or value with very many rows burdens none, and joins small ones."""
        self._folders(rows.hint("rebalance", by), folder, name, by)

    def _bucketed(self, rows: DataFrame, folder: str, name: str, folders: list[str], order: list[str]) -> None:
        """Add to a table bucketed by block, in folders. ``rows`` are dealt by block already."""
        writer = rows.write.mode("append").option("compression", CODEC).option("parquet.block.size", HELD_BACK)
        writer = writer.bucketBy(self.parts, "block")
        writer = writer.partitionBy(*folders) if folders else writer
        writer = writer.sortBy(*order) if order else writer
        writer.option("path", f"{self.path}/{folder}/{name}").saveAsTable(self._name(folder, name))

    # ---- reading --------------------------------------------------------------------

    def _bucket(self, key: Column) -> Column:
        return F.pmod(key, F.lit(self.buckets)).cast("int")

    def _slot(self) -> Column:
        return self._bucket(F.xxhash64("_id"))

    def _name(self, folder: str, name: str) -> str:
        return f"index_{hashlib.sha256(f'{self.path}/{folder}'.encode()).hexdigest()[:24]}_{name}"

    def _table(self, folder: str, name: str) -> DataFrame:
        """A bucketed table; a session that did not write it has to learn of it first."""
        table = self._name(folder, name)
        if not self.spark.catalog.tableExists(table):
            folders = name == "postings"
            self.spark.sql(
                f"CREATE TABLE {table} ({POSTINGS if folders else PLACES}) USING parquet {'PARTITIONED BY (bucket, more) ' if folders else ''}"
                f"CLUSTERED BY (block) INTO {self.parts} BUCKETS LOCATION '{self.path}/{folder}/{name}'"
            )
            if folders:
                self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return self.spark.table(table)

    def blocks(self, g: Generation) -> DataFrame:
        """Per word, source and block what bounds the scores of its documents; ``lead`` is the place of the first."""
        bound = lambda held, own: F.coalesce(held, own).alias(held)
        return self._table(g.folder, "postings").filter("more = 0").select(
            "term", "source", "block", bound("max_tf", "tf"), bound("min_len", "field_len"),
            at_of(F.col("block"), F.col("seat")).alias("lead"), bound("docs", F.lit(1).cast("long")), "bucket",
        )

    def sources(self) -> DataFrame:
        """Index, schema, table and field by the number that postings have for them."""
        rows = self._union(self._read(g, "sources", SOURCES) for g in self.generations)
        return rows if len(self.generations) == 1 else rows.distinct()

    def _read(self, g: Generation, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{g.folder}/{name}")

    def _read_docs(self, g: Generation) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(g.columns)).add("slot", T.IntegerType())
        return self.spark.read.schema(schema).parquet(f"{self.path}/{g.folder}/docs")

    @staticmethod
    def _union(parts) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _is(self, kind: str) -> Column:
        return F.col("field").isin([f for f, k in self.fields if k == kind])

    def live(self, g: Generation, name: str) -> DataFrame:
        """Rows of a generation whose documents no later one has replaced or removed."""
        if name == "docs":
            rows = self._read_docs(g)
        else:
            rows = self._read(g, name, EXACT) if name == "exact" else self._table(g.folder, name)
        later = [h for h in self.generations if h.number > g.number]
        if not later:
            return rows
        dead = self._union(self._read(h, "dead", DEAD) for h in later).filter(F.col("number") == g.number).drop("number")
        # a document's block is in the key, so rows that are dealt by block stay where they are
        by = [*ID, "block"] if name in ("docs", "exact") else ["block", "seat"]
        return rows.join(dead.select(*by), by, "left_anti")

    def docs(self, every: bool = False) -> DataFrame:
        """The documents; with ``every``, also their places."""
        rows = self._union(self.live(g, "docs") for g in self.generations).drop("slot")
        return rows if every else rows.drop("at", "block")

    def located(self, ids: DataFrame) -> DataFrame:
        """Live documents of ``ids`` (``_index, _id, slot``) with place and generation."""
        return self._union(
            self.live(g, "docs").join(ids, ["slot", *ID], "left_semi").withColumn("number", F.lit(g.number)) for g in self.generations
        )

    def named(self, g: Generation, rows: DataFrame, *columns: str) -> DataFrame:
        """Rows by ``block`` and ``seat`` with these columns of their documents, which lie in the same bucket."""
        return rows.join(self._table(g.folder, "places").select("block", "seat", *columns).hint("shuffle_hash"), ["block", "seat"])

    def postings(self) -> DataFrame:
        """A row per word, document and field of all live documents."""
        parts = (self.named(g, self.live(g, "postings"), "_id", CARRIED[-1]) for g in self.generations)
        rows = self._union(parts).join(self.sources(), "source").drop("source", "max_tf", "min_len", "docs", "more")
        return rows.withColumn("at", at_of(F.col("block"), F.col("seat")))

    def _sums(self, rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        if len(self.generations) == 1:
            return rows.select(*keys, *values)
        return rows.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])

    def terms(self) -> DataFrame:
        """Documents per word, index and field; a word that is no longer used may have none."""
        rows = self._union(self._read(g, "terms", TERMS) for g in self.generations)
        return self._sums(rows, ["term", "_index", "field", "bucket"], ["df"])

    def _field_rows(self) -> DataFrame:
        return self._sums(self._union(self._read(g, "fields", FIELDS) for g in self.generations), ["_index", "field"], ["docs", "total"]).filter("docs > 0")

    def field_stats(self) -> DataFrame:
        """Documents and mean length per index and field."""
        return self._field_rows().select("_index", "field", "docs", (F.col("total") / F.col("docs")).alias("avg_len"))

    def near(self) -> DataFrame:
        """Keys of words' first letters."""
        return self._union(self._read(g, "near", NEAR) for g in self.generations)

    def heads(self) -> DataFrame:
        """Words by their first letters."""
        return self._union(self._read(g, "heads", HEADS) for g in self.generations)

"""Keyword search over documents made of three tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import documents as D
from tidemark.operators import search as S
from tidemark.operators.search_index import SearchIndex
from tidemark.session import shared_dir
from workload.fixtures import load
from workload.sync_queries import ISO

QUERIES = {}
SQL = {}
STATEMENTS = ["orders", "customer", "documents"]
KEYWORD = "mahcinery customer 2-hgih tionth the src7"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def search_documents(spark, sf) -> DataFrame:
    """Orders, customers and documents as three indices of unlike fields."""
    sources = {
        "orders": ("o_orderkey", "shop", "2024-01-03T00:00:00Z"),
        "customer": ("c_custkey", "crm", "2024-01-01T00:00:00Z"),
        "documents": ("doc_id", "shop", "2024-01-02T00:00:00Z"),
    }
    docs = [
        D.documents(load(spark, sf, t), t, stamp, key, f"{schema}_{t}", schema, t).drop("_query")
        for t, (key, schema, stamp) in sources.items()
    ]
    return D.all_indices(*docs)


_BUILT: dict[tuple, str] = {}


def build(spark, sf, path: str) -> SearchIndex:
    return SearchIndex.write(search_documents(spark, sf), path, buckets=8)


def new_path(spark) -> str:
    return f"{shared_dir(spark)}/tidemark/index-{uuid.uuid4().hex}"


def _data_key(spark, sf) -> tuple:
    """The files that an index is made of, so that an index of other files is not taken for it."""
    return spark.sparkContext.applicationId, tuple(sorted(f for t in STATEMENTS for f in load(spark, sf, t).inputFiles()))


def index_of(spark, sf) -> SearchIndex:
    """The index over the three tables, built once per session and set of files."""
    key = _data_key(spark, sf)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf, new_path(spark)).path
    return SearchIndex.open(spark, _BUILT[key])


# ---- SQL ----------------------------------------------------------------------------

WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
NUMBER = r"regexp_replace(CAST(TRY_CAST({} AS DECIMAL(38,6)) AS VARCHAR), '\.?0+$', '')"


def _fields(texts: dict[str, str], numbers: list[str]) -> str:
    """Text fields by their expressions, and number columns."""
    rows = [f"{{'f': '{f}', 't': {e}, 'n': NULL}}" for f, e in texts.items()]
    rows += [f"{{'f': '{f}', 't': NULL, 'n': {NUMBER.format(f)}}}" for f in numbers]
    return f"unnest([{', '.join(rows)}])"


def texts_of(documents: str = "documents", where: str = "") -> str:
    """Tables of an index: d (fields), w (words), p (postings), t (counts), f (fields' statistics)."""
    return """
d AS (
  SELECT 'shop_orders' AS _index, 'orders_' || o_orderkey AS _id, 'shop' AS _schema, 'orders' AS _table,
         '2024-01-03T00:00:00Z' AS stamp, """ + _fields(
        {"o_orderstatus": "o_orderstatus", "o_orderpriority": "o_orderpriority", "o_orderdate": ISO.format(c="o_orderdate")},
        ["o_orderkey", "o_custkey", "o_totalprice"]) + """ AS x FROM orders
  UNION ALL
  SELECT 'crm_customer', 'customer_' || c_custkey, 'crm', 'customer', '2024-01-01T00:00:00Z', """ + _fields(
        {"c_name": "c_name", "c_mktsegment": "c_mktsegment"}, ["c_custkey", "c_nationkey", "c_acctbal"]) + """ FROM customer
  UNION ALL
  SELECT 'shop_documents', 'documents_' || doc_id, 'shop', 'documents', '2024-01-02T00:00:00Z', """ + _fields(
        {"text": "text", "lang": "lang", "source": "source"}, ["doc_id", "n_chars"]) + """ FROM documents),""" + FROM_FIELDS


FROM_FIELDS = """
w AS (SELECT _index, _id, _schema, _table, stamp, x.f AS field, x.t AS t, x.n AS n,
        CASE WHEN x.n IS NULL THEN """ + WORDS.format("x.t") + """ ELSE [x.n] END AS ws FROM d WHERE x.t IS NOT NULL OR x.n IS NOT NULL),
p AS (SELECT _index, _id, _schema, _table, stamp, field, len(ws) AS fl, term, n IS NOT NULL AS number, count(*) AS tf
      FROM (SELECT *, unnest(ws) AS term FROM w) GROUP BY ALL),
t AS (SELECT term, _index, field, number, count(*) AS df FROM p GROUP BY ALL),
f AS (SELECT _index, field, count(*) AS docs, avg(len(ws)) AS avg_len FROM w WHERE len(ws) > 0 GROUP BY ALL)
"""
TEXTS = texts_of()
INDEX = "WITH " + TEXTS

# exchanging two neighbours is one edit, and no letter is edited twice; the built-in
# distance allows that, which matters only where lengths differ by one
SPLIT = """
len(list_filter(range(1, length({s})), lambda i:
  (substr({s}, i, 1) = substr({l}, i + 1, 1) AND substr({s}, i + 1, 1) = substr({l}, i, 1)
   AND levenshtein(substr({s}, 1, i - 1), substr({l}, 1, i - 1))
     + levenshtein(substr({s}, i + 2), substr({l}, i + 2)) <= 1)
  OR (substr({s}, i, 1) = substr({l}, i + 2, 1) AND substr({s}, i + 1, 1) = substr({l}, i + 1, 1)
   AND levenshtein(substr({s}, 1, i - 1), substr({l}, 1, i))
     + levenshtein(substr({s}, i + 2), substr({l}, i + 3)) <= 1))) > 0"""
# DuckDB counts the bytes of a letter as edits, so letters outside ASCII stand as capitals,
# which no word of the index has
PLAIN = "translate({}, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')"
NEAR = f"""
v AS (SELECT DISTINCT term, {PLAIN.format("term")} AS b FROM t WHERE NOT number),
pairs AS (SELECT word, term, a, b, damerau_levenshtein(a, b) AS distance
  FROM (SELECT DISTINCT word, {PLAIN.format("word")} AS a FROM qw) JOIN v
    ON abs(length(a) - length(b)) <= 2 AND damerau_levenshtein(a, b) <=
       CASE WHEN length(a) <= 2 THEN 0 WHEN length(a) <= 5 THEN 1 ELSE 2 END),
near AS (SELECT word, term, distance FROM pairs
  WHERE distance <= 1 OR length(a) = length(b) OR levenshtein(a, b) <= 2
     OR (length(a) < length(b) AND {SPLIT.format(s="a", l="b")})
     OR (length(a) > length(b) AND {SPLIT.format(s="b", l="a")}))
"""
#: numbers as words, too
NEAR_ALL = NEAR.replace(" WHERE NOT number", "")
SCORE = NEAR + """,
weights AS (SELECT query_id, near.term, false AS number, sum(1 - distance / least(length(qw.word), length(near.term))) AS weight
  FROM qw JOIN near ON qw.word = near.word GROUP BY ALL
  UNION ALL SELECT DISTINCT query_id, term, true, 1.0 FROM qn),
hits AS (SELECT query_id, p._index, p._id, p._schema, p._table, p.stamp, p.field,
    sum(weight * ln(1 + (docs - df + 0.5) / (df + 0.5)) * 2.2 * tf
        / (tf + 1.2 * (0.25 + 0.75 * fl / avg_len))) AS points
  FROM weights JOIN p ON p.term = weights.term AND p.number = weights.number
  JOIN t ON t.term = p.term AND t._index = p._index AND t.field = p.field
  JOIN f ON f._index = p._index AND f.field = p.field GROUP BY ALL),
scored AS (SELECT query_id, _index, _id, _schema, _table, stamp, round(max(points), 6) AS score
  FROM hits GROUP BY ALL)
"""
TYPED_NUMBERS = r"""qn AS (SELECT query_id, """ + NUMBER.format("part") + r""" AS term
  FROM (SELECT query_id, unnest(string_split_regex(keyword, '\s+')) AS part FROM queries)
  WHERE regexp_full_match(part, '[+-]?[0-9]+(\.[0-9]+)?') AND TRY_CAST(part AS DECIMAL(38,6)) IS NOT NULL)"""
QUERY_WORDS = f"""qw AS (SELECT DISTINCT query_id, unnest({WORDS.format("keyword")}) AS word FROM queries), {TYPED_NUMBERS}"""


def one(keyword: str, tables: str = TEXTS) -> str:
    """SQL up to the scores of one keyword, given as an expression."""
    return f"WITH queries AS (SELECT 0 AS query_id, {keyword} AS keyword), {QUERY_WORDS}, {tables}, {SCORE}"


ONE = one(f"'{KEYWORD}'")
ORDER = "ORDER BY score DESC, stamp DESC, _index, _id"

#: one word of every document whose id is divisible by 100, from each searchable field in
#: turn, misspelt by the rule above; the id is the number of the query
TYPED = f"""
typed AS (SELECT doc_id AS query_id, doc_id // 100 AS n, {WORDS.format("CASE (doc_id // 100) % 5 WHEN 0 THEN text WHEN 1 THEN lang WHEN 2 THEN source WHEN 3 THEN CAST(doc_id AS VARCHAR) ELSE CAST(n_chars AS VARCHAR) END")} AS ws
  FROM documents WHERE doc_id % 100 = 0),
picked AS (SELECT query_id, n, ws[1 + n % len(ws)] AS term FROM typed WHERE len(ws) > 0),
queries AS (SELECT query_id, CASE n % 4
    WHEN 0 THEN term || ' ' || substr(term, 1, 2)
    WHEN 1 THEN term
    WHEN 2 THEN substr(term, 1, 1) || substr(term, 3, 1) || substr(term, 2, 1) || substr(term, 4)
    ELSE substr(term, 1, 2) || substr(term, 4) END AS keyword FROM picked),
{QUERY_WORDS}
"""


def typed_table(docs: DataFrame) -> DataFrame:
    """``query_id``, ``keyword``: grows with the documents, no order over all of them."""
    n = F.expr("doc_id div 100")
    fields = ["text", "lang", "source", "doc_id", "n_chars"]
    value = F.coalesce(*[F.when(n % len(fields) == i, F.col(f).cast("string")) for i, f in enumerate(fields)])
    words = docs.filter("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), n.alias("n"), X.tokens(value).alias("ws"))
    picked = words.filter("size(ws) > 0").selectExpr("query_id", "n", "ws[CAST(n % size(ws) AS INT)] AS term")
    return picked.selectExpr(
        "query_id",
        """CASE n % 4
             WHEN 0 THEN term || ' ' || substr(term, 1, 2)
             WHEN 1 THEN term
             WHEN 2 THEN substr(term, 1, 1) || substr(term, 3, 1) || substr(term, 2, 1) || substr(term, 4)
             ELSE substr(term, 1, 2) || substr(term, 4) END AS keyword""",
    )


# ---- queries ------------------------------------------------------------------------


@query(INDEX + "SELECT _index, field, docs, round(avg_len, 6) AS avg_len FROM f")
def search_index_build(spark, sf):
    """Build a fresh index; its field statistics are the result."""
    index = build(spark, sf, new_path(spark))
    _BUILT.setdefault(_data_key(spark, sf), index.path)
    return index.field_stats().withColumn("avg_len", F.round("avg_len", 6))


@query(INDEX + "SELECT term, _index, field, df FROM t")
def term_index(spark, sf):
    return index_of(spark, sf).terms().drop("bucket")


@query(INDEX + """
SELECT _index, _id, field, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS words, max(tf) AS top_tf,
       min(term) AS first_term, CAST(max(fl) AS BIGINT) AS field_len FROM p GROUP BY ALL""")
def document_postings(spark, sf):
    rows = index_of(spark, sf).postings()
    return rows.groupBy("_index", "_id", "field").agg(
        F.count(F.lit(1)).alias("terms"),
        F.sum("tf").alias("words"),
        F.max("tf").cast("long").alias("top_tf"),
        F.min("term").alias("first_term"),
        F.max("field_len").cast("long").alias("field_len"),
    )


@query(rf"""
SELECT page_id, len({WORDS.format("html")}) AS words, list_distinct({WORDS.format("html")}) IS NOT NULL AS analysed,
       ({WORDS.format("html")})[1] AS first_word FROM pages""")
def analysed_pages(spark, sf):
    words = load(spark, sf, "pages").select("page_id", X.tokens(F.col("html")).alias("w"))
    return words.select(
        "page_id",
        F.size("w").cast("long").alias("words"),
        F.col("w").isNotNull().alias("analysed"),
        F.try_element_at("w", F.lit(1)).alias("first_word"),
    )


@query("SELECT DISTINCT _index FROM (" + INDEX + "SELECT _index FROM p)")
def list_indices(spark, sf):
    return D.list_indices(search_documents(spark, sf))


@query("""
SELECT 'shop_orders' AS _index, count(*) AS docs, count(o_orderstatus) AS with_status, 0 AS with_text FROM orders
UNION ALL SELECT 'crm_customer', count(*), 0, 0 FROM customer
UNION ALL SELECT 'shop_documents', count(*), 0, count(text) FROM documents""")
def all_indices(spark, sf):
    return search_documents(spark, sf).groupBy("_index").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count("o_orderstatus").alias("with_status"),
        F.count("text").alias("with_text"),
    )


@query(f"WITH {TEXTS}, {TYPED}, {NEAR_ALL} SELECT word, term, distance FROM near")
def fuzzy_terms_typed(spark, sf):
    index = index_of(spark, sf)
    words = S.query_words(typed_table(load(spark, sf, "documents")))
    return S.similar_terms(index, words, numbers=True).withColumn("distance", F.col("distance").cast("long"))


@query(f"""WITH {TEXTS}, {TYPED}, {SCORE}
SELECT query_id, _index, _id, score, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id {ORDER}) AS "rank" FROM scored) WHERE "rank" <= 20""")
def search_many_typed(spark, sf):
    typed = typed_table(load(spark, sf, "documents"))
    return S.search_many(index_of(spark, sf), typed).withColumn("rank", F.col("rank").cast("long"))


@query(f"""{ONE} SELECT _index, _id, score FROM scored {ORDER} LIMIT 20 OFFSET 20""")
def search_page(spark, sf):
    hits = S.search(index_of(spark, sf), KEYWORD, page=1, highlight=False).hits
    return hits.select("_index", "_id", "score")


@query(f"{ONE} SELECT count(*) AS total_hits, max(score) AS max_score FROM scored")
def search_summary(spark, sf):
    return S.summarise(S.scored_hits(index_of(spark, sf), KEYWORD))


@query(f"{ONE} SELECT _index, _id, score FROM scored WHERE _schema = 'shop' AND _table = 'documents' {ORDER} LIMIT 50")
def search_advanced(spark, sf):
    """With schema and table filter."""
    out = S.search(index_of(spark, sf), KEYWORD, "shop", "documents", size=50, highlight=False)
    return out.hits.select("_index", "_id", "score")


@query(f"{ONE} SELECT _index, _id, score FROM scored WHERE _schema = 'crm' {ORDER} LIMIT 20")
def search_schema(spark, sf):
    hits = S.search(index_of(spark, sf), KEYWORD, schema="crm", highlight=False).hits
    return hits.select("_index", "_id", "score")


@query(f"{ONE} SELECT _index, _id, score FROM scored WHERE _index = 'shop_orders' {ORDER} LIMIT 20")
def search_one_table(spark, sf):
    hits = S.search_table(index_of(spark, sf), "Shop", "Orders", KEYWORD, highlight=False).hits
    return hits.select("_index", "_id", "score")


@query(f"""{ONE} SELECT _index, split_part(_id, '_', 2) AS id FROM
(SELECT * FROM scored {ORDER} LIMIT 100)""")
def search_ids(spark, sf):
    return S.search_ids(index_of(spark, sf), KEYWORD, STATEMENTS, size=200)


@query(f"""
SELECT 'shop_orders' AS _index, 'orders_' || o_orderkey AS _id, 1.0::DOUBLE AS score FROM orders
UNION ALL SELECT 'crm_customer', 'customer_' || c_custkey, 1.0 FROM customer
UNION ALL SELECT 'shop_documents', 'documents_' || doc_id, 1.0 FROM documents""")
def search_no_keyword(spark, sf):
    return S.scored_hits(index_of(spark, sf), "  ").select("_index", "_id", "score")


#: matches of the page's hits: field, where they start and stop, whether the field is a number
PAGE_SPANS = rf"""{ONE},
top AS (SELECT _index, _id, score FROM scored {ORDER} LIMIT 20),
parts AS (  -- words with what stands before them, so that lengths give their places
  SELECT _index, _id, field, t, unnest(regexp_extract_all(lower(t), '[^\p{{L}}\p{{N}}]*[\p{{L}}\p{{N}}]+')) AS piece,
         generate_subscripts(regexp_extract_all(lower(t), '[^\p{{L}}\p{{N}}]*[\p{{L}}\p{{N}}]+'), 1) AS place
  FROM w JOIN top USING (_index, _id) WHERE n IS NULL),
ends AS (SELECT *, regexp_extract(piece, '[\p{{L}}\p{{N}}]+$') AS term,
         CAST(sum(length(piece)) OVER (PARTITION BY _index, _id, field ORDER BY place) AS INTEGER) + 1 AS stop FROM parts),
spans AS (
  SELECT _index, _id, field, t, stop - length(term) AS start, stop FROM ends
  WHERE term IN (SELECT term FROM weights WHERE NOT number)
  UNION ALL
  SELECT _index, _id, field, n, 1, length(n) + 1 FROM w JOIN top USING (_index, _id)
  WHERE n IN (SELECT term FROM weights WHERE number)),
first AS (SELECT _index, _id, field, t, min(start) AS s FROM spans GROUP BY ALL),
second AS (SELECT _index, _id, field, t, min(start) AS s FROM spans JOIN first USING (_index, _id, field, t) WHERE start >= s + 150 GROUP BY ALL),
third AS (SELECT _index, _id, field, t, min(start) AS s FROM spans JOIN second USING (_index, _id, field, t) WHERE start >= s + 150 GROUP BY ALL),
starts AS (SELECT 1 AS place, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third),
pieces AS (SELECT *, CASE WHEN length(substr(t, s, 151)) <= 150 THEN substr(t, s, 151)
    WHEN regexp_extract(substr(t, s, 151), '(?s)^(.*)[ \t\n\r]', 1) <> '' THEN regexp_extract(substr(t, s, 151), '(?s)^(.*)[ \t\n\r]', 1)
    ELSE substr(t, s, 150) END AS piece FROM starts)
"""


@query(PAGE_SPANS + """
SELECT _index, _id, score, field, place, CAST(s AS INTEGER) AS start, any_value(piece) AS fragment,
       string_agg(substr(t, start, stop - start), ' ' ORDER BY start) AS marked
FROM pieces JOIN spans USING (_index, _id, field, t) JOIN top USING (_index, _id)
WHERE start >= s AND stop <= s + length(piece) GROUP BY _index, _id, score, field, place, s""")
def search_highlights(spark, sf):
    """Per hit, field and fragment: where it starts, its text, and the marked words in order."""
    index = index_of(spark, sf)
    hits = S.search(index, KEYWORD).hits
    texts = F.create_map(*[c for f, kind in index.fields for c in (
        F.lit(f), F.col("source")[f] if kind == "text" else X.number_text(F.col("source")[f]))])
    # one list of fragments per hit, so that it is unrolled once
    pieces = F.flatten(F.transform(F.map_entries("highlight"), lambda e: F.transform(
        e["value"], lambda html, i: F.struct(e["key"].alias("field"), i.alias("place"), html.alias("html")))))
    rows = hits.select("_index", "_id", "score", texts.alias("texts"), pieces.alias("pieces"))
    rows = rows.select("_index", "_id", "score", "texts", F.inline("pieces"))
    plain = F.regexp_replace("html", "</?mark>", "")
    spans = F.regexp_extract_all("html", F.lit("(?s)<mark>(.*?)</mark>"), F.lit(1))
    return rows.select(
        "_index", "_id", "score", "field", (F.col("place") + 1).alias("place"),
        F.instr(F.col("texts")[F.col("field")], plain).alias("start"),
        plain.alias("fragment"), F.array_join(spans, " ").alias("marked"),
    )


@query(one("(SELECT max(o_orderkey) || ' ' || strftime(max(o_orderdate), '%Y-%m-%d') FROM orders)")
       + f"SELECT _index, _id, score FROM scored {ORDER} LIMIT 20")
def search_number(spark, sf):
    """The last order's key and the last date, as a user would type them."""
    last = load(spark, sf, "orders").agg(F.max("o_orderkey"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd")).first()
    hits = S.search(index_of(spark, sf), f"{last[0]} {last[1]}", highlight=False).hits
    return hits.select("_index", "_id", "score")


AMOUNT = NUMBER.format("max(o_totalprice)")


@query(one(f"(SELECT {AMOUNT} || '0 ' || {NUMBER.format('min(c_acctbal)')} FROM orders, customer)")
       + f"SELECT _index, _id, score FROM scored {ORDER} LIMIT 20")
def search_amount(spark, sf):
    """The highest price, with a closing zero, and the lowest balance."""
    price = load(spark, sf, "orders").agg(X.number_text(F.max("o_totalprice"))).first()[0]
    balance = load(spark, sf, "customer").agg(X.number_text(F.min("c_acctbal"))).first()[0]
    hits = S.search(index_of(spark, sf), f"{price}0 {balance}", highlight=False).hits
    return hits.select("_index", "_id", "score")


#: every status and priority, and the price or balance of each row whose key is divisible by 100
WANTED = """
SELECT DISTINCT 'o_orderstatus' AS field, o_orderstatus AS value FROM orders
UNION SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders
UNION SELECT 'o_totalprice', CAST(o_totalprice AS {text}) FROM orders WHERE o_orderkey % 100 = 0
UNION SELECT 'c_acctbal', CAST(c_acctbal AS {text}) FROM customer WHERE c_custkey % 100 = 0
UNION SELECT 'text', text FROM documents WHERE doc_id % 100 = 0"""


@query(INDEX + f""",
wanted AS ({WANTED.format(text="VARCHAR")}),
met AS (SELECT wanted.field, value, _index, _id, stamp FROM wanted JOIN w ON w.field = wanted.field
        AND (w.t = value OR w.n = {NUMBER.format("value")}))
SELECT field, md5(value) AS value, _index, _id, "rank", total FROM (
  SELECT *, row_number() OVER (PARTITION BY field, value ORDER BY stamp DESC, _index, _id) AS "rank",
         count(*) OVER (PARTITION BY field, value) AS total FROM met) WHERE "rank" <= 20""")
def search_exact(spark, sf):
    """Whole values of text fields and amounts: the latest 20 documents of each, and their number."""
    for name in ("orders", "customer", "documents"):
        load(spark, sf, name).createOrReplaceTempView(name)
    wanted = spark.sql(WANTED.format(text="STRING"))
    # a value's digest is its query's number
    wanted = wanted.withColumn("query_id", F.concat("field", F.lit(":"), F.md5("value")))
    hits = S.search_exact(index_of(spark, sf), wanted)
    return hits.select(
        F.substring_index("query_id", ":", 1).alias("field"), F.substring_index("query_id", ":", -1).alias("value"),
        "_index", "_id", F.col("rank").cast("long").alias("rank"), "total",
    )


#: documents after an update: every third is replaced, one in ten is gone, some are new
UPDATED = """updated AS (
  SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || ' ' || substr(text, 1, 200) || ' renewed' ELSE text END AS text,
         lang, source, CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE n_chars END AS n_chars,
         CASE WHEN doc_id % 3 = 0 THEN '2024-02-01T00:00:00Z' ELSE '2024-01-02T00:00:00Z' END AS stamp
  FROM documents WHERE doc_id % 10 <> 1
  UNION ALL
  SELECT -1 - doc_id, 'added ' || source, lang, source, n_chars, '2024-02-01T00:00:00Z' FROM documents WHERE doc_id % 50 = 7)"""
UPDATED_TABLES = UPDATED + """,
d AS (SELECT 'shop_documents' AS _index, 'documents_' || doc_id AS _id, 'shop' AS _schema, 'documents' AS _table, stamp,
    """ + _fields({"text": "text", "lang": "lang", "source": "source"}, ["doc_id", "n_chars"]) + """ AS x FROM updated),""" + FROM_FIELDS


def _as_documents(df: DataFrame, stamp: str) -> DataFrame:
    return D.documents(df, "documents", stamp, "doc_id", "shop_documents", "shop", "documents").drop("_query")


@query(f"""WITH {UPDATED_TABLES}, {TYPED}, {SCORE}
SELECT query_id, _index, _id, score, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id {ORDER}) AS "rank" FROM scored) WHERE "rank" <= 20""")
def search_after_update(spark, sf):
    """An index of the documents that was updated in two steps, one of them merged."""
    docs = load(spark, sf, "documents")
    index = SearchIndex.write(_as_documents(docs, "2024-01-02T00:00:00Z"), new_path(spark), buckets=8)
    changed = docs.filter("doc_id % 3 = 0").withColumns({
        "text": F.concat("source", F.lit(" "), F.substring("text", 1, 200), F.lit(" renewed")), "n_chars": F.col("doc_id"),
    })
    added = docs.filter("doc_id % 50 = 7").withColumns({"doc_id": -1 - F.col("doc_id"), "text": F.concat(F.lit("added "), "source")})
    gone = _as_documents(docs.filter("doc_id % 10 = 1"), "").select("_index", "_id")
    index = index.update(_as_documents(changed, "2024-02-01T00:00:00Z")).merge(keep=False)
    index = index.update(_as_documents(added, "2024-02-01T00:00:00Z"), gone)
    return S.search_many(index, typed_table(docs)).withColumn("rank", F.col("rank").cast("long"))


@query(f"""{PAGE_SPANS}
SELECT _index, _id, field, lower(arg_min(substr(t, start, stop - start), start)) AS first_word, true AS in_text
FROM spans GROUP BY _index, _id, field""")
def search_highlight_words(spark, sf):
    """Per hit and field: the first marked word, and whether all fragments are in the text."""
    index = index_of(spark, sf)
    hits = S.search(index, KEYWORD).hits
    texts = F.create_map(*[c for f, kind in index.fields for c in (
        F.lit(f), F.col("source")[f] if kind == "text" else X.number_text(F.col("source")[f]))])
    plain = lambda p: F.regexp_replace(p, "</?mark>", "")
    rows = hits.select("_index", "_id", texts.alias("texts"), F.explode("highlight").alias("field", "fragments"))
    return rows.select(
        "_index", "_id", "field",
        F.lower(F.regexp_extract(F.col("fragments")[0], "(?s)<mark>(.*?)</mark>", 1)).alias("first_word"),
        F.forall("fragments", lambda p: F.col("texts")[F.col("field")].contains(plain(p))).alias("in_text"),
    )

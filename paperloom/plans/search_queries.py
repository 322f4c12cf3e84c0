"""Queries on search: facets, filters, BM25, vectors, fusion; and Spark's own extras, named ext_."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import pages, search
from paperloom.plans.registry import query
from paperloom.sources.tables import Made, table

WORDS = "and the of error with"
RECORDS = Made(
    "lineitem",
    (
        "l_orderkey * 10 + l_linenumber AS id",
        "CASE l_partkey % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'table' WHEN 2 THEN 'table_row' WHEN 3 THEN 'diagram' ELSE 'summary' END AS record_type",
        "CASE WHEN l_suppkey % 6 = 0 THEN 'toc_like' ELSE 'ok' END AS processing_status",
        "l_partkey % 2 = 0 AS has_diagram",
        "CAST(l_linenumber AS INT) AS physical_pdf_page",
        "CAST(l_linenumber + l_suppkey % 3 AS INT) AS physical_pdf_page_end",
        "concat('GE-', l_partkey % 30) AS equipment",
        "CASE WHEN l_suppkey % 4 > 0 THEN concat('it''s part ', l_partkey) END AS chunk",
    ),
)


def _records(spark: SparkSession, d: str) -> DataFrame:
    r = RECORDS.df(spark, d)
    return r.withColumns({"equipment_ids": F.array("equipment", F.concat("equipment", F.lit("-B"))), "physical_pdf_pages": F.sequence("physical_pdf_page", "physical_pdf_page_end")})


@query(f"SELECT record_type AS value, count(*) AS count FROM {RECORDS.sql()} WHERE processing_status = 'ok' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def facet_counts(spark: SparkSession, d: str) -> DataFrame:
    return search.facet(_records(spark, d).where("processing_status = 'ok'"), "record_type")


@query(f"SELECT value, count(*) AS count FROM (SELECT unnest([equipment, equipment || '-B']) AS value FROM {RECORDS.sql()}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def facet_collection(spark: SparkSession, d: str) -> DataFrame:
    return search.facet(_records(spark, d), "equipment_ids")


@query(f"SELECT record_type, processing_status, count(*) AS n, count_if(has_diagram)::BIGINT AS with_diagram FROM {RECORDS.sql()} GROUP BY ALL")
def record_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).groupBy("record_type", "processing_status").agg(F.count(F.lit(1)).alias("n"), F.count_if("has_diagram").alias("with_diagram"))


def _filter_query(name: str, expression: str, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        r = _records(spark, d)
        return r.where(search.parse_filter(expression, r.columns)).select("id", "record_type", "physical_pdf_page")

    run.__name__ = name
    query(f"SELECT id, record_type, physical_pdf_page FROM {RECORDS.sql()} WHERE {sql}")(run)


_filter_query("odata_filter_page_range", "physical_pdf_page ge 2 and physical_pdf_page le 4 and record_type ne 'table'", "physical_pdf_page BETWEEN 2 AND 4 AND record_type <> 'table'")
_filter_query("odata_filter_any", "equipment_ids/any(e: e eq 'GE-7-B') or physical_pdf_pages/any(p: p eq 6 and p gt 5)", "equipment = 'GE-7' OR 6 BETWEEN physical_pdf_page AND physical_pdf_page_end")
_filter_query("odata_filter_columns", "physical_pdf_page lt physical_pdf_page_end and not (has_diagram eq true)", "physical_pdf_page < physical_pdf_page_end AND NOT has_diagram")
_filter_query("odata_filter_status", "processing_status eq 'toc_like' and chunk ne null and contains(chunk, 'it''s part 1')", "processing_status = 'toc_like' AND contains(chunk, 'it''s part 1')")


_TERMS = sorted(set(WORDS.split()))
_BM25 = f"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '{search.WORD}') AS ts FROM documents), c AS (SELECT doc_id, len(ts) AS n, {", ".join(f"len(list_filter(ts, lambda x: x = '{w}')) AS tf{i}" for i, w in enumerate(_TERMS))} FROM t),
    s AS (SELECT count(*) AS docs, avg(n) AS mean, {", ".join(f"count_if(tf{i} > 0) AS df{i}" for i in range(len(_TERMS)))} FROM c),
    b AS (SELECT doc_id, {" + ".join(f"ln(1 + (docs - df{i} + 0.5::DOUBLE) / (df{i} + 0.5::DOUBLE)) * (tf{i} * 2.2::DOUBLE) / (tf{i} + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * n / mean))" for i in range(len(_TERMS)))} AS score FROM c, s WHERE {" OR ".join(f"tf{i} > 0" for i in range(len(_TERMS)))})"""


@query(f"{_BM25} SELECT doc_id, round(score, 6) AS score FROM b ORDER BY round(score, 6) DESC, doc_id LIMIT 50")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    scored = search.bm25(table(spark, d, "documents"), WORDS, "doc_id").withColumn("score", F.round("score", 6))
    return search.top(scored, "doc_id", 50)


_V = "[" + ", ".join(f"{(i * 37 % 19 - 9) / 8}" for i in range(64)) + "]"
_VECTOR = [(i * 37 % 19 - 9) / 8 for i in range(64)]


@query(f"SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], {_V}::DOUBLE[]), 6) AS score FROM embeddings ORDER BY 2 DESC, 1 LIMIT 20")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    scored = search.vector_scores(table(spark, d, "embeddings"), _VECTOR, "vec_id").withColumn("score", F.round("score", 6))
    return search.top(scored, "vec_id", 20)


@query(
    f"""{_BM25}, x AS (SELECT doc_id AS id, row_number() OVER (ORDER BY round(score, 6) DESC, doc_id) AS r FROM b QUALIFY r <= 50),
    y AS (SELECT vec_id AS id, row_number() OVER (ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], {_V}::DOUBLE[]), 6) DESC, vec_id) AS r FROM embeddings QUALIFY r <= 50)
    SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 9) AS score FROM (SELECT * FROM x UNION ALL SELECT * FROM y) GROUP BY id"""
)
def hybrid_rrf(spark: SparkSession, d: str) -> DataFrame:
    by_words = search.bm25(table(spark, d, "documents"), WORDS, "doc_id").select(F.col("doc_id").alias("id"), F.round("score", 6).alias("score"))
    by_vector = search.vector_scores(table(spark, d, "embeddings"), _VECTOR, "vec_id").select(F.col("vec_id").alias("id"), F.round("score", 6).alias("score"))
    return search.fuse([search.top(by_words, "id", 50), search.top(by_vector, "id", 50)], "id").withColumn("score", F.round("score", 9))


_SENTENCES = "list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"


@query(
    f"""{_BM25}, h AS (SELECT doc_id FROM b ORDER BY round(score, 6) DESC, doc_id LIMIT 50), x AS (SELECT doc_id, {_SENTENCES} AS ss FROM h JOIN documents USING (doc_id)),
    e AS (SELECT doc_id, i, ss[i] AS s, len(list_intersect(list_distinct(regexp_extract_all(lower(ss[i]), '{search.WORD}')), {_TERMS})) AS n FROM (SELECT *, unnest(range(1, len(ss) + 1)) AS i FROM x))
    SELECT doc_id, arg_min(s, (-n, i)) AS caption FROM e GROUP BY doc_id"""
)
def captions(spark: SparkSession, d: str) -> DataFrame:
    """The best sentence of each of the first hits."""
    docs = table(spark, d, "documents")
    best = search.top(search.bm25(docs, WORDS, "doc_id").withColumn("score", F.round("score", 6)), "doc_id", 50)
    return docs.join(F.broadcast(best), "doc_id").select("doc_id", search.caption(F.col("text"), WORDS).alias("caption"))


# -- Spark's own, beyond the operators above --


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def ext_rollup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query(
    """WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events),
    s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS events, round(sum(value), 4) AS value FROM s GROUP BY user_id, k"""
)
def ext_session_window(spark: SparkSession, d: str) -> DataFrame:
    w = F.session_window("ts", "30 minutes")
    return table(spark, d, "events").groupBy("user_id", w.alias("w")).agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 4).alias("value")).select("user_id", F.col("w.start").alias("started"), "events", "value")


@query("SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY event_type")
def ext_approx_distinct(spark: SparkSession, d: str) -> DataFrame:
    """The estimate itself has no SQL; that it is within a tenth of the count has."""
    # each user once before both counts: beside a distinct count, every user would carry a sketch of the estimate
    each = table(spark, d, "events").select("event_type", "user_id").distinct()
    n = each.groupBy("event_type").agg(F.count("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("about"))
    return n.select("event_type", "users", (F.abs(F.col("about") - F.col("users")) * 10 <= F.col("users")).alias("near"))


@query("SELECT l_orderkey, l_linenumber, e.event_id FROM (SELECT l_orderkey, l_linenumber, l_suppkey % 50 AS u, l_shipdate AS ts FROM lineitem) l ASOF LEFT JOIN (SELECT user_id AS u, ts, max(event_id) AS event_id FROM events GROUP BY 1, 2) e ON l.u = e.u AND l.ts >= e.ts")
def ext_asof(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").groupBy(F.col("user_id").alias("u"), "ts").agg(F.max("event_id").alias("event_id"))
    probes = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 50).alias("u"), F.col("l_shipdate").alias("ts"))
    return pages.as_of(probes, events, ["u"], "ts", "event_id").select("l_orderkey", "l_linenumber", "event_id")



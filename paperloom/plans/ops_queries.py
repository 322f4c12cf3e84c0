"""Queries on figures and upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import figures, upkeep
from paperloom.plans.registry import query
from paperloom.sources.tables import Made, table
from paperloom.streaming import incremental

FIGURES = Made(
    "part",
    (
        "CAST(p_partkey % 40 AS INT) AS doc",
        "p_partkey AS pos",
        "CAST(p_size AS DOUBLE) / 8 AS w_in",
        "CAST(p_partkey % 17 + 1 AS DOUBLE) / 4 AS h_in",
        "CASE WHEN p_partkey % 19 > 0 THEN p_partkey * 37 % 40000 END AS n_bytes",
        "p_partkey % 5 = 0 AS precomputed",
        "p_partkey % 7 = 0 AS hash_hit",
        "p_partkey % 11 = 0 AS phash_hit",
        "CASE WHEN p_partkey % 13 = 0 THEN 'Timeout' END AS error",
        "p_size % 2 = 0 AS useful",
        "CASE p_size % 3 WHEN 0 THEN 'schematic' WHEN 1 THEN 'nameplate' ELSE 'decorative' END AS category",
        "CASE WHEN p_size % 4 = 0 THEN '' ELSE p_name END AS description",
        "substr(sha1(p_type), 1, 16) AS sha",
    ),
)
NOW = "TIMESTAMP '1998-01-01 00:00:00'"


@query(f"SELECT doc, pos, CASE WHEN least(w_in, h_in) < 1 THEN 'tiny' WHEN greatest(w_in, h_in) > least(w_in, h_in) * 8 THEN 'aspect' WHEN n_bytes < 10000 THEN 'small' END AS reason FROM {FIGURES.sql()}")
def figure_triage(spark: SparkSession, d: str) -> DataFrame:
    return FIGURES.df(spark, d).select("doc", "pos", figures.triage(F.col("w_in"), F.col("h_in"), F.col("n_bytes")).alias("reason"))


@query(
    f"""SELECT doc, pos, CASE WHEN n_bytes IS NULL THEN 'no_image' WHEN n_bytes < 10000 THEN 'skipped_tiny' WHEN precomputed THEN 'precomputed' WHEN hash_hit THEN 'cache_hit' WHEN phash_hit THEN 'cache_hit_phash'
    WHEN error IS NOT NULL THEN 'vision_error:' || error WHEN useful AND category <> 'decorative' AND description <> '' THEN 'ok' WHEN useful AND category <> 'decorative' THEN 'vision_empty' ELSE 'skipped_decorative' END AS processing_status FROM {FIGURES.sql()}"""
)
def figure_status_ladder(spark: SparkSession, d: str) -> DataFrame:
    return figures.status_ladder(FIGURES.df(spark, d)).select("doc", "pos", "processing_status")


@query(
    f"""SELECT *, CASE WHEN missing * 10 > total THEN 'failed' WHEN missing > 0 OR errored > 0 THEN 'partial_vision' ELSE 'ok' END AS status FROM
    (SELECT doc, count(*) AS total, count_if(n_bytes IS NULL)::BIGINT AS missing, count_if(error IS NOT NULL)::BIGINT AS errored FROM {FIGURES.sql()} GROUP BY doc)"""
)
def vision_coverage(spark: SparkSession, d: str) -> DataFrame:
    return figures.vision_coverage(FIGURES.df(spark, d).select("doc", F.col("n_bytes").isNull().alias("missing"), F.col("error").isNotNull().alias("errored")))


@query(f"SELECT doc, CASE WHEN n = lost THEN 'all_figures_dropped' WHEN lost >= greatest(5, n // 4) THEN 'partial_figure_loss' ELSE 'ok' END AS status FROM (SELECT doc, count(*) AS n, count_if(w_in < 2) AS lost FROM {FIGURES.sql()} GROUP BY doc)")
def figure_loss_status(spark: SparkSession, d: str) -> DataFrame:
    n = FIGURES.df(spark, d).groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("w_in") < 2).alias("lost"))
    return n.select("doc", figures.loss_status(F.col("n"), F.col("lost")).alias("status"))


@query(f"SELECT doc, pos, sha FROM {FIGURES.sql()} QUALIFY row_number() OVER (PARTITION BY doc, sha ORDER BY pos) = 1")
def crop_dedup(spark: SparkSession, d: str) -> DataFrame:
    return figures.dedup_crops(FIGURES.df(spark, d).select("doc", "pos", "sha"))


_HISTORY = Made("part", ("CAST(p_partkey % 40 AS INT) AS doc", "substr(sha1(p_type), 1, 16) AS sha", "p_partkey AS seen", "CASE WHEN p_partkey % 3 = 0 THEN 'ok' ELSE 'cache_hit' END AS status", "p_name AS description", "p_brand AS category"), "p_partkey % 2 = 1")


@query(
    f"""WITH h AS (SELECT doc, sha, arg_max({{'d': description, 'c': category}}, (seen, description)) AS hit FROM {_HISTORY.sql()} WHERE status = 'ok' GROUP BY doc, sha)
    SELECT f.doc, f.pos, f.sha, hit IS NOT NULL AS hash_hit, hit.d AS description, hit.c AS category FROM {FIGURES.sql()} f LEFT JOIN h USING (doc, sha)"""
)
def hash_cache_lookup(spark: SparkSession, d: str) -> DataFrame:
    return figures.cache_lookup(FIGURES.df(spark, d).select("doc", "pos", "sha"), _HISTORY.df(spark, d), ["doc", "sha"])


@query(
    """WITH m AS (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY label, i), c AS (SELECT label, list(m ORDER BY i) AS centroid FROM m GROUP BY label),
    s AS (SELECT vec_id, c.label, list_cosine_similarity(embedding::DOUBLE[], centroid) AS s FROM embeddings, c),
    r AS (SELECT vec_id, list({'s': s, 'label': label} ORDER BY s DESC, label DESC) AS r FROM s GROUP BY vec_id)
    SELECT vec_id, r[1].label AS label, round(least(greatest(0.5 + (r[1].s - coalesce(r[2].s, 0)) * 2.5, 0), 1), 6) AS confidence FROM r"""
)
def centroid_classify(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return figures.nearest_class(vectors, figures.centroids(vectors), "vec_id").select("vec_id", "label", F.round("confidence", 6).alias("confidence"))


BLOBS = Made("orders", ("concat('m', o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '.docx' ELSE '.pdf' END) AS name", "o_orderdate AS last_modified"), "o_orderkey % 3 > 0")
INDEX = Made("orders", ("concat('m', o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '.docx' ELSE '.pdf' END) AS name", "o_custkey % 5 AS records"), "o_orderkey % 4 > 0")
STATE = Made("orders", ("concat('m', o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '.docx' ELSE '.pdf' END) AS name", "o_orderdate + INTERVAL 10 DAY - INTERVAL 1 DAY * (o_custkey % 20) AS last_indexed_at"), "o_orderkey % 5 > 0")
STATE_SPARK = Made("orders", (STATE.columns[0], "o_orderdate + make_interval(0, 0, 0, CAST(10 - o_custkey % 20 AS INT)) AS last_indexed_at"), STATE.where)


@query(
    f"""SELECT coalesce(b.name, i.name) AS name, CASE WHEN i.name IS NULL THEN 'ADDED' WHEN b.name IS NULL THEN 'DELETED' WHEN last_modified > last_indexed_at THEN 'EDITED' ELSE 'STABLE' END AS change
    FROM {BLOBS.sql()} b FULL JOIN (SELECT * FROM {INDEX.sql()} WHERE records > 0) i ON i.name = b.name LEFT JOIN {STATE.sql()} s ON s.name = coalesce(b.name, i.name)"""
)
def reconcile_plan(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.reconcile(BLOBS.df(spark, d), INDEX.df(spark, d), STATE_SPARK.df(spark, d))


@query(
    f"""SELECT coalesce(b.name, s.name) AS name, CASE WHEN b.name IS NULL THEN 'orphan' WHEN d.name IS NOT NULL THEN 'done' WHEN s.name IS NOT NULL THEN 'in_progress' ELSE 'not_started' END AS state
    FROM {BLOBS.sql()} b FULL JOIN {INDEX.sql()} s ON s.name = b.name LEFT JOIN (SELECT name FROM {INDEX.sql()} WHERE records > 2) d ON d.name = coalesce(b.name, s.name)"""
)
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    started = INDEX.df(spark, d)
    return upkeep.coverage(BLOBS.df(spark, d), started, started.where("records > 2"))


@query(f"SELECT name, last_modified FROM {BLOBS.sql()} WHERE last_modified < {NOW} - INTERVAL 60 MINUTE AND name NOT IN (SELECT name FROM {INDEX.sql()})")
def stuck_documents(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.stuck(BLOBS.df(spark, d), INDEX.df(spark, d), F.expr(NOW))


_RECORDS = Made("orders", ("o_orderkey AS id", "concat('1.', o_custkey % 3, '.0') AS skill_version", "o_orderdate AS last_indexed_at"))


@query(f"SELECT * FROM {_RECORDS.sql()} WHERE skill_version <> '1.2.0' AND last_indexed_at < {NOW} - INTERVAL 30 DAY")
def stale_rows(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.stale(_RECORDS.df(spark, d), "1.2.0", F.expr(NOW), 30)


_CACHE = Made("orders", ("concat('_dicache/m', o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '.docx' ELSE '.pdf' END, CASE o_custkey % 4 WHEN 0 THEN '.di.json' WHEN 1 THEN '.crop.fig_1.json' WHEN 2 THEN '.vision.fig_1.json' ELSE '.output.json' END) AS blob",))


@query(f"SELECT regexp_extract(blob, '^_dicache/(.+?\\.(?:pdf|docx|pptx|xlsx))\\..+$', 1) AS name, blob FROM {_CACHE.sql()} WHERE regexp_extract(blob, '^_dicache/(.+?\\.(?:pdf|docx|pptx|xlsx))\\..+$', 1) NOT IN (SELECT name FROM {BLOBS.sql()})")
def orphan_cache(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.orphaned_cache(_CACHE.df(spark, d), BLOBS.df(spark, d)).select("name", "blob")


@query(f"SELECT name, count_if(k = 'crop')::BIGINT AS crop, count_if(k = 'vision')::BIGINT AS vision, count_if(k = 'output')::BIGINT AS output FROM (SELECT regexp_extract(blob, '^_dicache/(.+?\\.(?:pdf|docx|pptx|xlsx))\\..+$', 1) AS name, regexp_extract(blob, '\\.(crop|vision|output)\\b', 1) AS k FROM {_CACHE.sql()}) GROUP BY name")
def cache_counts(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.cache_counts(_CACHE.df(spark, d))


@query(f"SELECT name FROM {BLOBS.sql()} EXCEPT SELECT name FROM {INDEX.sql()} WHERE records > 2")
def incremental_todo(spark: SparkSession, d: str) -> DataFrame:
    return incremental.todo(BLOBS.df(spark, d).select("name"), INDEX.df(spark, d).where("records > 2")).distinct()


@query("SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'not_started' WHEN toxic = 1 THEN 'blocked' ELSE 'done' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)")
def label_coverage(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return t.select("doc_id", F.when(F.col("quality").isNull(), "not_started").when(F.col("toxic") == 1, "blocked").otherwise("done").alias("state"))


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.latest(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


_RUNS = Made("events", ("concat('indexer-', user_id) AS name", "event_id AS run", "ts AS started_at", "CASE WHEN event_id % 3 > 0 THEN 'failed' WHEN event_id % 2 = 0 THEN 'inProgress' ELSE 'success' END AS status"))


@query(
    f"""SELECT name, count(*) >= 5 AND bool_and(status = 'failed') AS all_failed, bool_or(n = 1 AND status = 'inProgress' AND started_at < TIMESTAMP '2030-01-01' - INTERVAL 24 HOUR) AS hangs
    FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY started_at DESC, run) AS n FROM {_RUNS.sql()}) WHERE n <= 5 GROUP BY name"""
)
def run_history_last5(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.run_health(_RUNS.df(spark, d), F.expr("TIMESTAMP '2030-01-01'"))


_DONE = Made("orders", ("o_orderkey AS doc", "CASE o_custkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'partial_vision' WHEN 2 THEN 'failed' END AS status", "o_orderkey % 5 > 0 AS has_output", "CAST(o_custkey % 3 AS INT) AS figures", "CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 2 AS INT) END AS layout_figures"))


@query(f"SELECT doc, has_output AND (coalesce(status IN ('ok', 'di_missed_images', 'partial_vision'), false) OR figures > 0 OR coalesce(layout_figures, 0) = 0) AS done FROM {_DONE.sql()}")
def done_predicate(spark: SparkSession, d: str) -> DataFrame:
    return _DONE.df(spark, d).select("doc", upkeep.is_done(*map(F.col, ("status", "has_output", "figures", "layout_figures"))).alias("done"))


_WAY = Made("orders", ("o_orderkey AS doc", "o_orderkey % 6 > 0 AS has_layout", "CAST(o_custkey % 4 AS INT) AS figures", "CAST(o_custkey % 3 AS INT) AS crops", "CAST(o_orderkey % 3 AS INT) AS visions", "o_custkey % 5 = 0 AS has_output"))


@query(f"SELECT doc, CASE WHEN has_output THEN 'done' WHEN NOT has_layout THEN 'needs_layout' WHEN figures > 0 AND crops = 0 THEN 'needs_crops' WHEN visions < crops THEN 'needs_vision' ELSE 'needs_output' END AS state FROM {_WAY.sql()}")
def document_status(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.document_status(_WAY.df(spark, d)).select("doc", "state")


_CONTRACT = Made("orders", ("o_orderkey AS id", "CASE WHEN o_custkey % 7 > 0 THEN o_orderpriority ELSE '' END AS chunk", "CAST(o_custkey % 9 AS INT) AS physical_pdf_page", "CAST(o_custkey % 9 + o_orderkey % 3 AS INT) AS physical_pdf_page_end", "CASE WHEN o_orderkey % 4 = 0 THEN '{}' ELSE '[]' END AS text_bbox"))


@query(
    f"""SELECT id, list_filter([CASE WHEN chunk = '' THEN 'chunk is empty' END, CASE WHEN text_bbox NOT LIKE '[%' THEN 'text_bbox is no JSON list' END,
    CASE WHEN physical_pdf_page_end NOT IN (physical_pdf_page, physical_pdf_page + 1) THEN 'physical_pdf_page_end isn''t among the pages' END], lambda x: x IS NOT NULL) AS breaks FROM {_CONTRACT.sql()}"""
)
def field_contracts(spark: SparkSession, d: str) -> DataFrame:
    rows = _CONTRACT.df(spark, d).withColumn("physical_pdf_pages", F.array("physical_pdf_page", F.col("physical_pdf_page") + 1))
    return upkeep.contract_breaks(rows, ["id", "chunk"], ["physical_pdf_pages"], ["text_bbox"]).select("id", "breaks")


@query("SELECT name, change FROM (SELECT 'q' || l_orderkey::VARCHAR AS name, CASE WHEN bool_or(l_returnflag = 'R') THEN 'purge' ELSE 'keep' END AS change FROM lineitem GROUP BY 1)")
def purge_targets(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.concat(F.lit("q"), F.col("l_orderkey").cast("string")).alias("name"), F.when(F.col("l_returnflag") == "R", "DELETED").otherwise("STABLE").alias("change"))
    return upkeep.plan_with(lines, upkeep.purges(lines, 1 << 62))


@query("SELECT 'r' || event_id::VARCHAR AS recordId, value * 2 AS data, CASE WHEN value IS NULL OR value > 50 THEN ['too large'] ELSE [] END AS errors FROM (SELECT event_id, CASE WHEN value <= 50 THEN value END AS value FROM events)")
def record_envelope(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("recordId"), "value")
    out = upkeep.envelope(rows, lambda df: (F.when(F.col("value") <= 50, F.col("value") * 2), F.lit("too large")))
    return out.select("recordId", "data", F.transform("errors", lambda e: e["message"]).alias("errors"))

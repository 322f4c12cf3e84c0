"""Queries on what records are made of: merged tables, boxes of chunks, pages found by text, crops, mappings, and batches of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import figures, layout, pages, records, search, tables, upkeep
from paperloom.plans.layout_queries import TABLES
from paperloom.plans.ops_queries import BLOBS, FIGURES
from paperloom.plans.registry import query
from paperloom.plans.search_queries import RECORDS
from paperloom.sources.tables import Made, table

# Every table has four body rows; every third one of those that go on leaves its header out.
_HEAD = "['Size', 'of ' || cols::VARCHAR]"
_ROWS = "[['a' || pos::VARCHAR, (pos % 7)::VARCHAR], ['b' || pos::VARCHAR, ''], ['c', 'x'], ['', 'end']]"
_MERGED = f"""WITH l AS (SELECT *, lag(last_page) OVER w AS p, lag(cols) OVER w AS c FROM {TABLES.sql()} WINDOW w AS (PARTITION BY doc ORDER BY first_page, pos)),
    k AS (SELECT *, (sum(CASE WHEN p + 1 = first_page AND c = cols AND caption = '' THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY first_page, pos) - 1)::BIGINT AS cluster FROM l),
    t AS (SELECT *, row_number() OVER (PARTITION BY doc, cluster ORDER BY first_page, pos) AS nth, CASE WHEN pos % 3 = 0 THEN [] ELSE [{_HEAD}] END || {_ROWS} AS grid FROM k),
    h AS (SELECT *, (first_value(grid) OVER (PARTITION BY doc, cluster ORDER BY nth))[1] AS head FROM t),
    b AS (SELECT doc, cluster, nth, first_page, last_page, head, i, grid[i] AS vals FROM (SELECT *, unnest(range(1, len(grid) + 1)) AS i FROM h) WHERE NOT (i = 1 AND (nth = 1 OR grid[1] = head))),
    m AS (SELECT doc, cluster, any_value(head) AS heads, list(first_page::VARCHAR || '|' || array_to_string(vals, '|') ORDER BY nth, i) AS body, list(first_page ORDER BY nth, i) AS body_pages, list(vals ORDER BY nth, i) AS body_vals FROM b GROUP BY doc, cluster),
    s AS (SELECT doc, cluster, min(first_page) AS page_start, arg_max(last_page, nth) AS page_end FROM t GROUP BY doc, cluster)"""


def _merged(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    head = F.array(F.lit("Size"), F.concat(F.lit("of "), s("cols")))
    body = F.array(F.array(F.concat(F.lit("a"), s("pos")), (F.col("pos") % 7).cast("string")), F.array(F.concat(F.lit("b"), s("pos")), F.lit("")), F.array(F.lit("c"), F.lit("x")), F.array(F.lit(""), F.lit("end")))
    grid = F.when(F.col("pos") % 3 == 0, body).otherwise(F.concat(F.array(head), body))
    return tables.merge_continuations(TABLES.df(spark, d).withColumns({"grid": grid, "header_rows": F.lit(1)}))


@query(f"{_MERGED} SELECT m.doc, m.cluster, heads, body, page_start, page_end FROM m JOIN s USING (doc, cluster)")
def table_merge(spark: SparkSession, d: str) -> DataFrame:
    line = F.transform("body", lambda b: F.concat_ws("|", b["page"].cast("string"), F.array_join(b["values"], "|")))
    return _merged(spark, d).select("doc", "cluster", "heads", line.alias("body"), "page_start", "page_end")


@query(
    f"""{_MERGED} SELECT doc, cluster::VARCHAR || '_0' AS table_index, (i - 1)::INT AS row_index, body_pages[i] AS page,
    array_to_string(list_filter(list_transform(list_zip(heads, body_vals[i]), lambda z: CASE WHEN z[2] = '' THEN '' WHEN z[1] = '' THEN z[2] ELSE z[1] || ': ' || z[2] END), lambda x: x <> ''), '; ') AS row_text
    FROM (SELECT *, unnest(range(1, len(body) + 1)) AS i FROM m WHERE len(body) BETWEEN 5 AND 5000)"""
)
def table_row_records(spark: SparkSession, d: str) -> DataFrame:
    return tables.row_records(_merged(spark, d)).select("doc", "table_index", "row_index", "page", "row_text")


@query(
    f"""{_MERGED} SELECT m.doc, m.cluster::VARCHAR || '_0' AS table_index, len(body)::INT AS row_count, 2 AS col_count, page_start, page_end,
    array_to_string(['| ' || array_to_string(heads, ' | ') || ' |', '| --- | --- |'] || list_transform(body_vals, lambda v: '| ' || array_to_string(v, ' | ') || ' |'), chr(10)) AS markdown FROM m JOIN s USING (doc, cluster)"""
)
def table_chunk_records(spark: SparkSession, d: str) -> DataFrame:
    """None of these tables is long enough to be split; ``table_split`` has those."""
    return tables.table_records(_merged(spark, d)).select("doc", "table_index", "row_count", "col_count", "page_start", "page_end", "markdown")


def _said(order: str, line: str) -> str:
    return f"concat('the relay of order ', {order}, ' and line ', {line}, ' trips at ', {order} % 50, ' amps when the bus is dead', CASE WHEN {order} % 3 = 0 THEN concat(repeat(' and so on', 12), ' until ', {line}) ELSE '' END)"


_LINE = _said("l_orderkey", "l_linenumber")
_PARAGRAPHS = Made("lineitem", ("l_orderkey AS doc", "CAST(l_linenumber AS INT) AS page", "CAST(l_partkey % 8 AS DOUBLE) AS x_in", "CAST(l_suppkey % 8 AS DOUBLE) AS y_in", "CAST(1.5 AS DOUBLE) AS w_in", "CAST(0.5 AS DOUBLE) AS h_in", f"{_LINE} AS normal", f"length({_LINE}) AS raw_length"))
_HOLDERS = Made("orders", ("o_orderkey AS key", "o_orderkey AS doc", f"concat('see ', {_said('o_orderkey', 'o_custkey % 4 + 1')}, ' or ', {_said('o_orderkey', '2')}, CASE WHEN o_custkey % 2 = 0 THEN ' or else the relay of order ' ELSE '' END, 'x') AS normal"))


@query(
    f"""SELECT key, page, x_in, y_in, w_in, h_in FROM {_HOLDERS.sql()} c JOIN {_PARAGRAPHS.sql()} p ON p.doc = c.doc AND contains(c.normal, substr(p.normal, 1, 120)) AND (length(p.normal) < 200 OR contains(c.normal, substr(p.normal, 101, 100)))
    WHERE raw_length >= 40 AND length(p.normal) >= 40"""
)
def chunk_boxes(spark: SparkSession, d: str) -> DataFrame:
    return pages.chunk_boxes(_HOLDERS.df(spark, d), _PARAGRAPHS.df(spark, d))


_FOUND = Made("supplier", ("s_nationkey AS doc", "CAST(s_suppkey AS INT) AS section_idx", "CASE WHEN s_suppkey % 9 > 0 THEN CAST(s_suppkey % 40 + 3 AS INT) END AS page_start", "concat('section of ', s_suppkey % 3, ' and more of it ', CASE WHEN s_suppkey % 2 = 0 THEN 'with an end' ELSE '' END) AS normal"))
_SOUGHT = Made("orders", ("o_orderkey AS key", "CAST(o_custkey % 25 AS INT) AS doc", "concat('section of ', o_orderkey % 3, CASE o_custkey % 3 WHEN 0 THEN ' and more' WHEN 1 THEN ' and more of it with an end here' ELSE ' and none' END) AS normal"))


@query(
    f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY section_idx) AS pos FROM {_FOUND.sql()}),
    p AS (SELECT c.key, pos, page_start, contains(n.normal, substr(c.normal, 1, 200)) AS ends, least(length(n.normal), length(c.normal)) AS size FROM {_SOUGHT.sql()} c JOIN n ON n.doc = c.doc AND pos <= 100 AND page_start IS NOT NULL
      WHERE contains(n.normal, substr(c.normal, 1, 200)) OR contains(c.normal, substr(n.normal, 1, 200))),
    s AS (SELECT *, min(CASE WHEN ends THEN pos END) OVER (PARTITION BY key) AS stop FROM p)
    SELECT c.key, f.page AS fuzzy_page FROM {_SOUGHT.sql()} c LEFT JOIN (SELECT key, arg_max(page_start, (size, -pos)) AS page FROM s WHERE stop IS NULL OR pos <= stop GROUP BY key) f ON f.key = c.key"""
)
def fuzzy_pages(spark: SparkSession, d: str) -> DataFrame:
    return pages.fuzzy_pages(_SOUGHT.df(spark, d), _FOUND.df(spark, d)).select("key", "fuzzy_page")


_CROPS = Made("lineitem", ("l_orderkey * 10 + l_linenumber AS key", "CAST(l_partkey % 100 AS DOUBLE) / 8 - 1 AS x0", "CAST(l_suppkey % 100 AS DOUBLE) / 8 AS y0", "CAST(l_linenumber AS DOUBLE) / 4 AS w", "CAST(l_partkey % 7 AS DOUBLE) / 2 AS h"))


@query(
    f"""SELECT key, CASE WHEN x1 > x0 AND y1 > y0 THEN round(x0, 4) END AS x_in, CASE WHEN x1 > x0 AND y1 > y0 THEN round(y0, 4) END AS y_in, CASE WHEN x1 > x0 AND y1 > y0 THEN round(x1 - x0, 4) END AS w_in, CASE WHEN x1 > x0 AND y1 > y0 THEN round(y1 - y0, 4) END AS h_in
    FROM (SELECT key, greatest(0::DOUBLE, x0 - 0.05::DOUBLE) AS x0, greatest(0::DOUBLE, y0 - 0.05::DOUBLE) AS y0, least(8.5::DOUBLE, x0 + w + 0.05::DOUBLE) AS x1, least(11::DOUBLE, y0 + h + 0.05::DOUBLE) AS y1 FROM {_CROPS.sql()})"""
)
def crop_boxes(spark: SparkSession, d: str) -> DataFrame:
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    box = layout.crop_box(F.array(x0, y0, x1, y0, x1, y1, x0, y1), F.lit(8.5), F.lit(11.0))
    return _CROPS.df(spark, d).select("key", box.alias("b")).select("key", "b.x_in", "b.y_in", "b.w_in", "b.h_in")


_META = Made("part", ("p_partkey AS id", "p_brand AS metadata_operationalarea", "CASE WHEN p_size % 3 > 0 THEN p_type END AS metadata_functionalarea", "p_name AS metadata_doctype", "CASE WHEN p_size % 2 = 0 THEN '.pdf' ELSE '.docx' END AS metadata_storage_file_extension"))


@query(f"SELECT id, metadata_operationalarea AS operationalarea, metadata_functionalarea AS functionalarea, metadata_doctype AS doctype, metadata_storage_file_extension AS filetype FROM {_META.sql()}")
def field_mappings(spark: SparkSession, d: str) -> DataFrame:
    return records.mapped_fields(_META.df(spark, d))


_WANTED = Made("orders", ("concat('m', o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '.docx' ELSE '.pdf' END) AS name",), "o_orderkey % 5 = 0")


@query(f"SELECT DISTINCT w.name, b.name IS NOT NULL AS found FROM {_WANTED.sql()} w LEFT JOIN {BLOBS.sql()} b ON b.name = w.name")
def requested_documents(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.requested(BLOBS.df(spark, d), _WANTED.df(spark, d))


_OUTCOMES = Made("events", ("user_id % 20 AS run", "CASE event_id % 7 WHEN 0 THEN '  FAIL-crash  a: Timeout' WHEN 1 THEN '  skip  a' WHEN 2 THEN '  ok, but FAIL at the end' ELSE '  OK  a' END AS result"))


@query(f"SELECT run, count_if(lower(result) LIKE '%ok%' AND result NOT LIKE '%FAIL%')::BIGINT AS processed, count_if(lower(result) LIKE '%skip%')::BIGINT AS skipped, count_if(result LIKE '%FAIL%')::BIGINT AS failed FROM {_OUTCOMES.sql()} GROUP BY run")
def run_counters(spark: SparkSession, d: str) -> DataFrame:
    return upkeep.run_counters(_OUTCOMES.df(spark, d), ["run"])


_MISSED = Made("lineitem", ("l_suppkey AS doc", "CAST(l_orderkey AS INT) AS page", "CAST(l_linenumber AS INT) AS image_count"), "l_partkey % 3 = 0")


@query(
    f"""SELECT doc, count(*) AS missed_image_pages, sum(image_count)::BIGINT AS missed_image_count, list(page ORDER BY page)[1:50] AS missed_pages
    FROM (SELECT doc, page, sum(image_count) AS image_count FROM {_MISSED.sql()} GROUP BY doc, page) GROUP BY doc"""
)
def missed_images(spark: SparkSession, d: str) -> DataFrame:
    """The list of pages is a report of the first 50, as the counts beside it are of all."""
    return figures.missed_images(_MISSED.df(spark, d))


_OLD = Made("part", ("substr(sha1(p_type), 1, 16) AS image_phash", "'diagram' AS record_type", "CASE WHEN p_partkey % 3 = 0 THEN 'ok' ELSE 'cache_hit' END AS status", "p_partkey AS seen", "p_name AS description", "p_brand AS category"), "p_partkey % 2 = 1")


@query(
    f"""WITH h AS (SELECT image_phash, arg_max({{'d': description, 'c': category}}, (seen, description)) AS hit FROM {_OLD.sql()} WHERE status = 'ok' GROUP BY image_phash)
    SELECT f.doc, f.pos, f.sha AS image_phash, hit IS NOT NULL AS phash_hit, hit.d AS description, hit.c AS category FROM {FIGURES.sql()} f LEFT JOIN h ON h.image_phash = f.sha"""
)
def phash_lookup(spark: SparkSession, d: str) -> DataFrame:
    figs = FIGURES.df(spark, d).select("doc", "pos", F.col("sha").alias("image_phash"))
    return figures.phash_lookup(figs, _OLD.df(spark, d), across=True)


@query(f"SELECT count(*) AS count, count_if(record_type = 'text')::BIGINT AS texts FROM {RECORDS.sql()} WHERE physical_pdf_page >= 2 AND processing_status = 'ok'")
def search_count(spark: SparkSession, d: str) -> DataFrame:
    """The count beside the facets, and one facet's value that it must agree with."""
    found = search.matching(RECORDS.df(spark, d), "physical_pdf_page ge 2 and processing_status eq 'ok'")
    return search.count(found).join(F.broadcast(search.facet(found, "record_type").where("value = 'text'").select(F.col("count").alias("texts"))))


_WORDS_OF = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9äöüßéèêàçôûùîïñáíóúœ]+'))"


@query(
    f"""WITH p AS (SELECT p_partkey AS id, p_name, p_type, (p_size / 8)::DOUBLE AS score FROM part ORDER BY score DESC, id LIMIT 50)
    SELECT id, round(len(list_intersect({_WORDS_OF.format("p_name")}, ['blue', 'green', 'steel'])) / 3.0::DOUBLE * 2 + len(list_intersect({_WORDS_OF.format("p_type")}, ['blue', 'green', 'steel'])) / 3.0::DOUBLE, 6) AS rerank FROM p"""
)
def rerank(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_type", (F.col("p_size") / 8).cast("double").alias("score"))
    return search.rerank(hits, "green steel blue", {"p_name": 2.0, "p_type": 1.0}).select("id", F.round("rerank", 6).alias("rerank"))

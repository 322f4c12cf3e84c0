"""Queries on layout: sections, pages, boxes, tables. Inputs are made from the tables' keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import markers, text
from paperloom.operators import layout, pages, tables
from paperloom.plans.registry import query
from paperloom.sources.tables import Made

SECTIONS = Made("supplier", ("s_nationkey AS doc", "CAST(s_suppkey AS INT) AS section_idx", "CAST(s_suppkey % 40 + 1 AS INT) AS page_start", "CAST(s_suppkey % 40 + 1 + (s_suppkey * 7) % 12 AS INT) AS page_end", "s_suppkey % 9 = 0 AS is_orphan"))
ENTITIES = Made("orders", ("o_orderkey AS key", "CAST(o_custkey % 25 AS INT) AS doc", "CAST(o_orderkey % 60 + 1 AS INT) AS page", "CAST(o_orderkey % 60 + 1 + o_custkey % 6 AS INT) AS page_to"))
BOXES = Made("lineitem", ("l_orderkey AS key", "CAST(l_partkey % 5 + 1 AS INT) AS page", "CAST(l_suppkey % 16 AS DOUBLE) / 8 AS x_in", "CAST(l_partkey % 32 AS DOUBLE) / 8 AS y_in", "CAST(l_linenumber AS DOUBLE) / 4 AS w_in", "CAST(l_suppkey % 9 + 1 AS DOUBLE) / 4 AS h_in"))


@query(
    f"""SELECT key, e.doc, page, arg_min(section_idx, (CASE WHEN is_orphan THEN 1 ELSE 0 END, page_end - page_start, -section_idx)) AS section_idx
    FROM {ENTITIES.sql()} e LEFT JOIN {SECTIONS.sql()} s ON s.doc = e.doc AND page BETWEEN page_start AND page_end GROUP BY key, e.doc, page"""
)
def section_for_page(spark: SparkSession, d: str) -> DataFrame:
    return pages.section_for_page(ENTITIES.df(spark, d).select("key", "doc", "page"), SECTIONS.df(spark, d)).select("key", "doc", "page", "section_idx")


@query(
    f"""WITH m AS (SELECT key, page, page_to, section_idx, CASE WHEN is_orphan THEN 1 ELSE 0 END AS o, page_end - page_start AS span, least(page_end, page_to) - greatest(page_start, page) + 1 AS met
    FROM {ENTITIES.sql()} e JOIN {SECTIONS.sql()} s ON s.doc = e.doc AND page_start <= page_to AND page_end >= page),
    b AS (SELECT key, arg_min(section_idx, CASE WHEN met = page_to - page + 1 THEN (0, o, span::BIGINT, -section_idx::BIGINT) ELSE (1, o, -met::BIGINT, section_idx::BIGINT) END) AS section_idx FROM m GROUP BY key)
    SELECT e.key, page, page_to, section_idx FROM {ENTITIES.sql()} e LEFT JOIN b USING (key)"""
)
def section_for_range(spark: SparkSession, d: str) -> DataFrame:
    return pages.section_for_range(ENTITIES.df(spark, d), SECTIONS.df(spark, d), "key").select("key", "page", "page_to", "section_idx")


_EVENTS = Made("events", ("user_id % 50 AS doc", "event_id * 3 AS off", "CAST(event_id % 700 AS INT) AS page"), "event_type <> 'click'")
_PROBES = Made("events", ("event_id AS key", "user_id % 50 AS doc", "event_id * 3 + 1 AS off"))


@query(f"SELECT key, p.doc, p.off, e.page FROM {_PROBES.sql()} p ASOF LEFT JOIN {_EVENTS.sql()} e ON p.doc = e.doc AND p.off >= e.off")
def page_at_marker(spark: SparkSession, d: str) -> DataFrame:
    return pages.as_of(_PROBES.df(spark, d), _EVENTS.df(spark, d), ["doc"], "off", "page")


_SPAN = "concat('intro ', l_partkey, ' <!-- PageBreak --> second', chr(10), '<!-- PageNumber=\"', l_linenumber + 20, '\" --> third ', l_suppkey, '<!-- PageBreak -->', 'end')"
_CUT = "CAST(l_partkey % 2 AS INT)"


@query(
    f"""SELECT l_orderkey, l_linenumber, CASE l_partkey % 2 WHEN 0 THEN l_linenumber ELSE l_linenumber + 1 END AS first, CASE l_partkey % 2 WHEN 0 THEN l_linenumber + 20 ELSE l_linenumber + 21 END AS last,
    CASE l_partkey % 2 WHEN 0 THEN [l_linenumber, l_linenumber + 1, l_linenumber + 20] ELSE [l_linenumber + 1, l_linenumber + 20, l_linenumber + 21] END AS pages FROM lineitem"""
)
def page_span(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that run from the first page to the third, or from the second to the last."""
    rows = Made("lineitem", ("l_orderkey", "l_linenumber", f"{_SPAN} AS section", f"CASE WHEN {_CUT} = 0 THEN concat('intro ', l_partkey, ' <!-- PageBreak --> second', chr(10), '<!-- PageNumber=\"', l_linenumber + 20, '\" --> third') ELSE concat('second', chr(10), '<!-- PageNumber=\"', l_linenumber + 20, '\" --> third ', l_suppkey, '<!-- PageBreak -->', 'end') END AS chunk")).df(spark, d)
    span = markers.page_span(F.col("chunk"), F.col("section"), F.col("l_linenumber"))
    return rows.select("l_orderkey", "l_linenumber", span.alias("s")).select("l_orderkey", "l_linenumber", "s.*")


@query(f"SELECT key, page, min(x_in) AS x_in, min(y_in) AS y_in, max(x_in + w_in) - min(x_in) AS w_in, max(y_in + h_in) - min(y_in) AS h_in FROM {BOXES.sql()} GROUP BY key, page")
def bbox_union(spark: SparkSession, d: str) -> DataFrame:
    return pages.union_boxes(BOXES.df(spark, d), ["key"])


@query(f"SELECT key, arg_max(page, (area, -page)) AS primary_page, max(page) AS last_page, list(page ORDER BY page) AS pages FROM (SELECT key, page, sum(w_in * h_in) AS area FROM {BOXES.sql()} GROUP BY key, page) GROUP BY key")
def bbox_primary_page(spark: SparkSession, d: str) -> DataFrame:
    return pages.primary_page(BOXES.df(spark, d), ["key"])


_LADDER = Made(
    "orders",
    (
        "o_orderkey AS key",
        "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey % 20 + 1 AS INT) END AS di_page",
        "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 20 + 2 AS INT) END AS header_page",
        "CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_custkey % 20 + 3 AS INT) END AS fuzzy_page",
        "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey % 20 + 1 AS INT) END AS bbox_primary",
        "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_custkey % 20 + 2 AS INT) END AS bbox_last",
        "CASE WHEN o_custkey % 11 = 0 THEN CAST(o_custkey % 30 AS INT) END AS marker_page",
    ),
)


@query(
    f"""WITH b AS (SELECT *, coalesce(di_page, header_page, fuzzy_page) AS p FROM {_LADDER.sql()}),
    m AS (SELECT *, CASE WHEN p IS NOT NULL AND bbox_primary IS NOT NULL AND p NOT IN (bbox_primary, bbox_last) THEN 'bbox_corrected' WHEN di_page IS NOT NULL THEN 'di_input' WHEN header_page IS NOT NULL THEN 'header_match'
    WHEN fuzzy_page IS NOT NULL THEN 'fuzzy_match' WHEN bbox_primary IS NOT NULL THEN 'paragraph_bbox' WHEN marker_page IS NOT NULL THEN 'marker_inline' ELSE 'missing' END AS m FROM b)
    SELECT key, m AS page_resolution_method, CASE WHEN m IN ('bbox_corrected', 'paragraph_bbox') THEN bbox_primary WHEN m = 'marker_inline' THEN marker_page ELSE p END AS first_page,
    CASE m WHEN 'bbox_corrected' THEN bbox_primary WHEN 'paragraph_bbox' THEN bbox_last WHEN 'marker_inline' THEN marker_page ELSE p + 1 END AS last_page,
    CASE m WHEN 'bbox_corrected' THEN [bbox_primary] WHEN 'paragraph_bbox' THEN [bbox_primary, bbox_last] WHEN 'marker_inline' THEN [marker_page] WHEN 'missing' THEN [] ELSE [p, p + 1] END AS pages FROM m"""
)
def page_resolution_ladder(spark: SparkSession, d: str) -> DataFrame:
    p = F.coalesce("di_page", "header_page", "fuzzy_page")
    rows = _LADDER.df(spark, d).withColumn("bbox_pages", F.array_compact(F.array("bbox_primary", "bbox_last"))).withColumn("span", F.struct(p.alias("first"), (p + 1).alias("last"), F.array(p, p + 1).alias("pages")))
    return pages.resolve_pages(rows).select("key", "page_resolution_method", "first_page", "last_page", "pages")


_HEADED = Made("orders", ("o_orderkey AS key", "CAST(o_custkey % 25 AS INT) AS doc", "concat('Chapter  ', o_custkey % 4) AS header_1", "concat('Part ', o_orderkey % 6) AS header_2", "concat('Item ', o_orderkey % 11) AS header_3"))
_HEADS = Made("supplier", ("s_nationkey AS doc", "CAST(s_suppkey AS INT) AS section_idx", "CASE WHEN s_suppkey % 13 <> 0 THEN CAST(s_suppkey % 40 + 1 AS INT) END AS page_start", "concat('Chapter ', s_suppkey % 4) AS header_1", "concat('Part ', s_suppkey % 5) AS header_2", "concat('Item ', s_suppkey % 7) AS header_3"))


@query(
    f"""WITH h AS (SELECT * FROM {_HEADS.sql()} WHERE page_start IS NOT NULL), c AS (SELECT *, regexp_replace(header_1, '\\s+', ' ', 'g') AS g1 FROM {_HEADED.sql()})
    SELECT key, coalesce((SELECT arg_min(page_start, section_idx) FROM h WHERE h.doc = c.doc AND h.header_1 = g1 AND h.header_2 = c.header_2 AND h.header_3 = c.header_3),
    (SELECT arg_min(page_start, section_idx) FROM h WHERE h.doc = c.doc AND h.header_1 = g1 AND h.header_2 = c.header_2), (SELECT arg_min(page_start, section_idx) FROM h WHERE h.doc = c.doc AND h.header_1 = g1)) AS header_page FROM c"""
)
def header_page_tiers(spark: SparkSession, d: str) -> DataFrame:
    return pages.header_pages(_HEADED.df(spark, d), _HEADS.df(spark, d)).select("key", "header_page")


_WORDS = Made("lineitem", ("l_suppkey AS doc", "CAST(l_linenumber AS INT) AS page", "CASE WHEN l_partkey % 7 > 0 THEN CAST(l_quantity AS INT) * 2 END AS confidence", "l_partkey % 10 = 0 AS is_note", "concat('note ', l_orderkey) AS content", "l_orderkey AS pos"))
_SPANS = Made("supplier", ("s_suppkey AS doc", "CAST(s_suppkey % 4 + 1 AS INT) AS first_page", "CAST(s_suppkey % 4 + 2 AS INT) AS last_page"))


@query(f"SELECT s.doc, min(confidence) AS ocr_min FROM {_SPANS.sql()} s LEFT JOIN {_WORDS.sql()} w ON w.doc = s.doc AND w.page BETWEEN first_page AND last_page GROUP BY s.doc")
def ocr_min_confidence(spark: SparkSession, d: str) -> DataFrame:
    spans = _SPANS.df(spark, d).withColumn("key", F.col("doc"))
    return layout.span_confidence(spans, _WORDS.df(spark, d)).select(F.col("key").alias("doc"), F.col("ocr_min_confidence").alias("ocr_min"))


@query(f"SELECT s.doc, coalesce(list(left(content, 500) ORDER BY page, pos) FILTER (content IS NOT NULL), []) AS footnotes FROM {_SPANS.sql()} s LEFT JOIN (SELECT * FROM {_WORDS.sql()} WHERE is_note) w ON w.doc = s.doc AND w.page BETWEEN first_page AND last_page GROUP BY s.doc")
def footnotes_by_page(spark: SparkSession, d: str) -> DataFrame:
    paras = _WORDS.df(spark, d).withColumn("role", F.when(F.col("is_note"), "footnote").otherwise(""))
    return layout.footnotes(_SPANS.df(spark, d).withColumn("key", F.col("doc")), paras).select(F.col("key").alias("doc"), "footnotes")


PARAS = Made("lineitem", ("l_suppkey AS doc", "CAST(l_linenumber + l_partkey % 20 AS INT) AS page", "l_orderkey * 8 + l_linenumber AS pos", "l_partkey % 3 = 0 AS referenced", "CASE WHEN l_partkey % 5 = 0 THEN 'pageFooter' ELSE '' END AS role", "concat('a paragraph of order ', l_orderkey, CASE WHEN l_partkey % 2 = 0 THEN ' with parts' ELSE '' END) AS content"))
_COVER = Made("supplier", ("s_suppkey AS doc", "CAST(s_suppkey % 9 + 1 AS INT) AS page_start", "CAST(s_suppkey % 9 + 8 AS INT) AS page_end"))


@query(
    f"""SELECT p.doc, page, string_agg(content, chr(10) ORDER BY pos, content) AS content, count(*) AS paragraphs FROM {PARAS.sql()} p JOIN {_COVER.sql()} c ON c.doc = p.doc
    WHERE NOT referenced AND role = '' AND length(content) >= 30 AND NOT (page BETWEEN page_start AND page_end) GROUP BY p.doc, page"""
)
def orphan_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return layout.orphan_paragraphs(PARAS.df(spark, d), _COVER.df(spark, d))


TABLES = Made("orders", ("CAST(o_custkey % 200 AS INT) AS doc", "o_orderkey AS pos", "CAST(o_orderkey % 23 + 1 AS INT) AS first_page", "CAST(o_orderkey % 23 + 1 + o_custkey % 2 AS INT) AS last_page", "CAST(o_custkey % 3 AS INT) AS cols", "CASE WHEN o_orderkey % 4 = 0 THEN 'Ratings' ELSE '' END AS caption"))


@query(
    f"""WITH l AS (SELECT *, lag(last_page) OVER w AS p, lag(cols) OVER w AS c FROM {TABLES.sql()} WINDOW w AS (PARTITION BY doc ORDER BY first_page, pos))
    SELECT doc, pos, (sum(CASE WHEN p + 1 = first_page AND c = cols AND caption = '' THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY first_page, pos) - 1)::BIGINT AS cluster FROM l"""
)
def table_continuations(spark: SparkSession, d: str) -> DataFrame:
    return tables.clusters(TABLES.df(spark, d)).select("doc", "pos", "cluster")


CELLS = Made("lineitem", ("l_orderkey AS table_id", "l_orderkey * 10 + l_linenumber + l_partkey AS pos", "CAST(l_linenumber - 1 AS INT) AS r", "CAST(l_partkey % 4 AS INT) AS c", "CAST(1 + l_suppkey % 2 AS INT) AS rs", "CAST(1 + l_partkey % 2 AS INT) AS cs", "concat('v', l_partkey % 100, CASE WHEN l_suppkey % 5 = 0 THEN ' | x' ELSE '' END) AS text"))
_GRID = f"""(SELECT table_id, row, col, replace(arg_max(text, (pos, text)), '|', '\\|') AS text FROM (SELECT table_id, pos, text, row, unnest(range(c, c + cs)) AS col FROM (SELECT *, unnest(range(r, r + rs)) AS row FROM {CELLS.sql()}))
    WHERE row < 7 AND col < 5 GROUP BY table_id, row, col)"""


@query(f"SELECT table_id, row::INT AS row, col::INT AS col, text FROM {_GRID}")
def table_grid(spark: SparkSession, d: str) -> DataFrame:
    """The cells that a span fills; the later cell wins."""
    return tables.grid_cells(CELLS.df(spark, d).withColumns({"rows": F.lit(7), "cols": F.lit(5)})).select("table_id", "row", "col", "text")


_FULL = f"(SELECT t.table_id, y AS row, list(coalesce(text, '') ORDER BY x) AS vals FROM (SELECT DISTINCT table_id, y, x FROM {CELLS.sql()}, range(7) a(y), range(5) b(x)) t LEFT JOIN {_GRID} g ON g.table_id = t.table_id AND g.row = y AND g.col = x GROUP BY t.table_id, y)"


@query(f"SELECT table_id, string_agg(CASE WHEN row = 0 THEN '| ' || array_to_string(vals, ' | ') || ' |' || chr(10) || '| --- | --- | --- | --- | --- |' ELSE '| ' || array_to_string(vals, ' | ') || ' |' END, chr(10) ORDER BY row) AS markdown FROM {_FULL} GROUP BY table_id")
def table_markdown(spark: SparkSession, d: str) -> DataFrame:
    grid = tables.grids(CELLS.df(spark, d).withColumns({"rows": F.lit(7), "cols": F.lit(5)}))
    return grid.select("table_id", tables.markdown(F.col("grid"), F.array(*[F.element_at(F.col("grid")[0], i) for i in range(1, 6)]), F.lit(1)).alias("markdown"))


@query(
    f"""WITH h AS (SELECT table_id, vals AS heads FROM {_FULL} WHERE row = 0)
    SELECT table_id, row::INT AS row_index, array_to_string(list_filter(list_transform(list_zip(heads, vals), lambda z: CASE WHEN z[2] = '' THEN '' WHEN z[1] = '' THEN z[2] ELSE z[1] || ': ' || z[2] END), lambda x: x <> ''), '; ') AS text FROM {_FULL} JOIN h USING (table_id) WHERE row > 0"""
)
def table_rows(spark: SparkSession, d: str) -> DataFrame:
    grid = tables.grids(CELLS.df(spark, d).withColumns({"rows": F.lit(7), "cols": F.lit(5)}))
    rows = grid.select("table_id", F.col("grid")[0].alias("heads"), F.posexplode("grid").alias("row_index", "vals")).where("row_index > 0")
    return rows.select("table_id", "row_index", tables.row_text(F.col("heads"), F.col("vals")).alias("text"))


_SPLIT_ROWS = "list_transform(range(1, 3 + (l_partkey % 60)::BIGINT), lambda i: repeat('x', (i * 37 + l_suppkey) % 400 + 1))"


@query(
    f"""WITH RECURSIVE t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_SPLIT_ROWS} AS rs FROM lineitem WHERE l_linenumber = 1),
    u AS (SELECT *, row_number() OVER () AS id FROM t),
    f(id, i, cur, part, has) AS (SELECT id, 0, 46, 0, false FROM u UNION ALL
      SELECT f.id, f.i + 1, CASE WHEN has AND cur + length(rs[f.i + 1]) + 1 > 3000 THEN 46 ELSE cur END + length(rs[f.i + 1]) + 1, CASE WHEN has AND cur + length(rs[f.i + 1]) + 1 > 3000 THEN part + 1 ELSE part END, true FROM f JOIN u ON u.id = f.id WHERE f.i < len(rs))
    SELECT l_orderkey, l_partkey, l_suppkey, list(n ORDER BY part) AS sizes FROM (SELECT id, part, count(*) AS n FROM f WHERE i > 0 GROUP BY id, part) JOIN u USING (id) GROUP BY id, l_orderkey, l_partkey, l_suppkey"""
)
def table_split(spark: SparkSession, d: str) -> DataFrame:
    rows = Made("lineitem", ("l_orderkey", "l_partkey", "l_suppkey", "transform(sequence(1L, 2 + l_partkey % 60), i -> repeat('x', CAST((i * 37 + l_suppkey) % 400 + 1 AS INT))) AS rs"), "l_linenumber = 1").df(spark, d)
    parts = tables.split_rows(F.col("rs"), F.lit(46), 3000)
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", F.transform(parts, lambda p: F.size(p).cast("bigint")).alias("sizes"))


_COVERS = Made("lineitem", ("l_suppkey AS doc", "CAST(l_linenumber AS INT) AS page", "l_orderkey * 8 + l_linenumber AS pos", "CASE l_partkey % 9 WHEN 0 THEN concat('Revision ', l_orderkey, '.') WHEN 1 THEN concat('Publication No. PB-', l_orderkey) WHEN 2 THEN concat('May ', 2000 + l_orderkey % 30) ELSE 'words' END AS content"), "l_suppkey % 2 = 0")


@query(
    f"""SELECT doc, coalesce(arg_min(r, (pos, r)) FILTER (r <> ''), '') AS document_revision, coalesce(arg_min(n, (pos, n)) FILTER (n <> ''), '') AS document_number, coalesce(arg_min(d, (pos, d)) FILTER (d <> ''), '') AS effective_date FROM
    (SELECT doc, min(pos) AS pos, r, n, d FROM (SELECT doc, pos, rtrim(regexp_extract(content, '{text.REVISION}', 1), '.,;:') AS r, rtrim(regexp_extract(content, '{text.DOC_NUMBER}', 1), '.,;:') AS n, CASE WHEN content LIKE 'May %' THEN substr(content, 5) || '-05' ELSE '' END AS d
    FROM {_COVERS.sql()} WHERE page BETWEEN 1 AND 3) GROUP BY doc, r, n, d) GROUP BY doc"""
)
def cover_metadata(spark: SparkSession, d: str) -> DataFrame:
    return layout.cover_metadata(_COVERS.df(spark, d))


_KINDS = Made("lineitem", ("l_orderkey AS table_id", "CAST(l_linenumber - 1 AS INT) AS r", "CASE WHEN (l_partkey + l_linenumber) % 3 > 0 AND l_linenumber < 4 THEN 'columnHeader' ELSE 'content' END AS kind"))


@query(
    f"""WITH s AS (SELECT table_id, r, count_if(kind = 'columnHeader') * 2 >= count(*) AS h FROM {_KINDS.sql()} GROUP BY 1, 2)
    SELECT table_id, greatest(coalesce(min(CASE WHEN NOT h THEN r END), max(r) + 1), 1)::INT AS header_rows FROM s GROUP BY table_id"""
)
def table_header_rows(spark: SparkSession, d: str) -> DataFrame:
    return tables.header_rows(_KINDS.df(spark, d))


_LABELLED = Made("lineitem", ("l_orderkey * 10 + l_linenumber AS key", "concat('Chapter ', l_suppkey, chr(10), 'some text', chr(10), CASE l_partkey % 4 WHEN 0 THEN concat('Page ', l_linenumber, '-', l_suppkey % 40) WHEN 1 THEN concat('A-', l_suppkey % 90) WHEN 2 THEN concat('- ', l_partkey % 400, ' -') ELSE 'xiv' END) AS t", "CASE l_partkey % 4 WHEN 0 THEN concat(l_linenumber, '-', l_suppkey % 40) WHEN 1 THEN concat('A-', l_suppkey % 90) WHEN 2 THEN CAST(l_partkey % 400 AS STRING) ELSE 'xiv' END AS label"))


@query(f"SELECT key, label FROM {_LABELLED.sql()}")
def printed_label(spark: SparkSession, d: str) -> DataFrame:
    return _LABELLED.df(spark, d).select("key", text.printed_label(F.col("t")).alias("label"))


_ANCHORED = Made("part", ("p_partkey AS key", "concat(repeat('w ', 150), 'Figure ', p_size, ' shows ', p_name, ' ', repeat('z ', 150)) AS section", "concat('Figure ', p_size, ' shows') AS anchor"))


@query(f"SELECT key, trim(substr(section, 301 - 60, 60)) || ' [...] ' || trim(substr(section, 301 + length(anchor), 60)) AS around FROM {_ANCHORED.sql()}")
def surrounding_text(spark: SparkSession, d: str) -> DataFrame:
    return _ANCHORED.df(spark, d).select("key", text.surrounding_text(F.col("section"), F.col("anchor"), 60).alias("around"))

"""Queries on texts: chunking, classes, references, normalising, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import ids, text
from paperloom.operators.chunks import chunk
from paperloom.operators.semantic import semantic_diagram, semantic_text
from paperloom.plans.registry import query
from paperloom.sources.tables import MANUAL, table

_CHUNKS = """(SELECT doc_id, lang, source, (i // 1000)::INT AS ordinal, substring(text, i + 1, 1200) AS chunk
    FROM (SELECT *, unnest(range(0, greatest(length(text) - 200, 1), 1000)) AS i FROM documents WHERE length(text) > 0))"""


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunk(table(spark, d, "documents").select("doc_id", "lang", "source", "text"))


@query(f"SELECT concat_ws('_', 'txt', substr(sha1(source || '/' || doc_id::VARCHAR), 1, 16), ordinal::VARCHAR, substr(sha1(chunk), 1, 12)) AS chunk_id, doc_id, ordinal, chunk, (length(chunk) + 3) // 4 AS tokens FROM {_CHUNKS}")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    parent = ids.parent_id(F.concat_ws("/", "source", F.col("doc_id").cast("string")), F.lit(""))
    return _chunks(spark, d).select(ids.text_chunk_id(parent, F.col("ordinal"), F.col("chunk")).alias("chunk_id"), "doc_id", "ordinal", "chunk", ids.token_estimate(F.col("chunk")).alias("tokens"))


def _lang_sql(t: str) -> str:
    n = {k: " + ".join(f"contains(lower(substring({t}, 1, 500)), ' {w} ')::INT" for w in ws) for k, ws in text.STOPWORDS.items()}
    best = f"greatest({', '.join(n.values())})"
    return f"CASE WHEN length({t}) < 30 OR {best} = 0 THEN '' WHEN {n['en']} = {best} THEN 'en' WHEN {n['es']} = {best} THEN 'es' ELSE 'fr' END"


@query(f"SELECT lang, {_lang_sql('chunk')} AS detected, count(*) AS chunks, sum((length(chunk) + 3) // 4)::BIGINT AS tokens FROM {_CHUNKS} GROUP BY ALL")
def chunk_stats_by_lang(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("chunk")
    return _chunks(spark, d).groupBy("lang", text.detect_language(c).alias("detected")).agg(F.count(F.lit(1)).alias("chunks"), F.sum(ids.token_estimate(c)).alias("tokens"))


@query(f"SELECT doc_id, {_lang_sql('text')} AS detected FROM documents")
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.detect_language(F.col("text")).alias("detected"))


_LINES = "list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
_TOC_TEXT = "concat(text, chr(10), 'Meters ....... 18-', doc_id % 9, chr(10), 'Relays, molded   ', doc_id % 300, chr(10), repeat(concat('Breaker parts . . . . ', doc_id % 40, chr(10)), CAST(doc_id % 30 AS INT)))"


@query(
    f"""WITH a AS (SELECT doc_id, {_TOC_TEXT} AS t FROM documents), l AS (SELECT doc_id, {_LINES} AS ls FROM a),
    h AS (SELECT doc_id, len(ls) AS n, greatest(len(list_filter(ls, lambda x: regexp_matches(x, '{text.LEADER}'))), len(list_filter(ls, lambda x: regexp_matches(x, '{text.POINTER}')))) AS hits FROM l)
    SELECT doc_id, n >= 5 AND hits >= 5 AND hits * 10 >= n * 6 AS toc_like FROM h"""
)
def toc_like(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("doc_id", f"{_TOC_TEXT} AS t").select("doc_id", text.is_toc_like(F.col("t")).alias("toc_like"))


_GLOSS = "concat(repeat(concat('Bus bar ', doc_id % 7, ': a rail', chr(10)), CAST(doc_id % 5 AS INT)), text)"


@query(f"""SELECT doc_id, source = 'src3' OR len(regexp_extract_all({_GLOSS}, '{text.GLOSSARY_LINE.replace("'", "''")}')) >= 3 AS glossary FROM documents""")
def glossary_like(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").selectExpr("doc_id", "CASE WHEN source = 'src3' THEN 'Terms and Definitions' ELSE 'Meters' END AS h", f"{_GLOSS} AS t")
    return rows.select("doc_id", text.is_glossary(F.col("t"), F.col("h")).alias("glossary"))


@query(
    """WITH s AS (SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 300 WHEN 1 THEN 300 WHEN 2 THEN 200 WHEN 3 THEN 200 WHEN 4 THEN 250 WHEN 5 THEN 0 WHEN 6 THEN 200 ELSE 100 END
      + CASE WHEN source < 'src5' THEN 200 ELSE 0 END + CASE WHEN length(text) BETWEEN 200 AND 3000 THEN 200 WHEN length(text) BETWEEN 100 AND 199 THEN 100 ELSE 0 END
      + CASE WHEN lang = 'fr' THEN 100 ELSE 0 END + CASE WHEN lang = 'de' THEN 100 ELSE 0 END - CASE WHEN n_chars % 5 = 0 THEN 300 ELSE 0 END AS p FROM documents)
    SELECT doc_id, least(greatest(p, 0), 1000) / 1000.0::DOUBLE AS score FROM s"""
)
def quality_score(spark: SparkSession, d: str) -> DataFrame:
    method = F.element_at(F.array(*map(F.lit, ("di_input", "header_match", "fuzzy_match", "paragraph_bbox", "bbox_corrected", "missing", "document_summary", "marker_inline"))), (F.col("doc_id") % 8 + 1).cast("int"))
    score = text.quality_score(method, F.length("text"), F.col("source") < "src5", F.col("n_chars") % 5 == 0, F.col("lang") == "fr", F.col("lang") == "de")
    return table(spark, d, "documents").select("doc_id", score.alias("score"))


def _refs_sql(p: str, group: int, make: str = "x") -> str:
    return f"list_sort(list_distinct(list_transform(list_filter(list_transform(regexp_extract_all(text, '{p}', {group}), lambda x: regexp_replace(x, '[.,;:-]+$', '')), lambda x: x <> ''), lambda x: {make})))"


def _ref_query(name: str, fn, sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return MANUAL.df(spark, d).select("doc", "pos", fn(F.col("text")).alias("refs"))

    run.__name__ = name
    query(f"SELECT doc, pos, {sql} AS refs FROM {MANUAL.sql()}")(run)


_ref_query("figure_refs", text.figure_refs, f"list_sort(list_distinct(list_transform(list_zip(regexp_extract_all(text, '{text.FIGURE}', 1), regexp_extract_all(text, '{text.FIGURE}', 2)), lambda z: upper(z[1][1]) || lower(z[1][2:]) || ' ' || regexp_replace(z[2], '[.,;:-]+$', ''))))")
_ref_query("table_refs", text.table_refs, _refs_sql(text.TABLE, 2, "'Table ' || x"))
_ref_query("section_refs", text.section_refs, _refs_sql(text.SECTION, 1))
_ref_query("page_refs", text.page_refs, _refs_sql(text.PAGE, 1))
_ref_query("equation_refs", text.equation_refs, _refs_sql(text.EQUATION, 2, "'Equation ' || x"))
_ref_query("equipment_ids", text.equipment_ids, _refs_sql(text.EQUIPMENT, 0))
_ref_query("callouts", text.callouts, f"list_transform(list_zip(regexp_extract_all(text, '{text.CALLOUT}', 1), regexp_extract_all(text, '{text.CALLOUT}', 2)), lambda z: upper(z[1]) || ': ' || trim(z[2]))")
_ref_query("callout_kinds", text.callout_kinds, f"list_sort(list_distinct(list_transform(regexp_extract_all(text, '{text.CALLOUT}', 1), lambda x: upper(x))))")

_FIG_KEY = "lower(regexp_replace(regexp_replace({}, '(?i)\\bfig(?:ure)?\\.?\\s*[-:]?\\s*', '', 'g'), '[^A-Za-z0-9]+', '', 'g'))"
_DIAGRAMS = "(SELECT p_partkey AS figure, concat('FIG. ', p_size % 8, '.', p_partkey % 40) AS ref FROM part)"


@query(
    f"""SELECT k, sum(n)::BIGINT AS mentions, (count(DISTINCT figure))::BIGINT AS figures FROM
    (SELECT {_FIG_KEY.format("r")} AS k, count(*) AS n FROM (SELECT unnest(list_distinct(list_transform(regexp_extract_all(text, '{text.FIGURE}'), lambda x: regexp_replace(x, '[.,;:-]+$', '')))) AS r FROM {MANUAL.sql()}) GROUP BY 1)
    JOIN (SELECT {_FIG_KEY.format("ref")} AS k, figure FROM {_DIAGRAMS}) USING (k) GROUP BY k"""
)
def figure_ref_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Texts to the figures that they mention, by key; mentions are counted before the join, so that it meets each key once."""
    found = MANUAL.df(spark, d).select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", text.pattern(text.FIGURE), F.lit(0)), text.clean_ref))).alias("r"))
    mentions = found.groupBy(text.figure_key(F.col("r")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    figures = table(spark, d, "part").selectExpr("p_partkey AS figure", "concat('FIG. ', p_size % 8, '.', p_partkey % 40) AS ref").select(text.figure_key(F.col("ref")).alias("k"), "figure")
    return mentions.join(figures, "k").groupBy("k").agg(F.sum("n").alias("mentions"), F.countDistinct("figure").alias("figures"))


_MONTH_NO = "lpad((list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(substr({}, 1, 3))))::VARCHAR, 2, '0')"


def _get(p: str, g: int) -> str:
    return f"regexp_extract(text, '{p}', {g})"


@query(
    f"""SELECT doc, pos, CASE WHEN {_get(text.ISO_DATE, 1)} <> '' THEN {_get(text.ISO_DATE, 1)} || '-' || lpad({_get(text.ISO_DATE, 2)}, 2, '0') || '-' || lpad({_get(text.ISO_DATE, 3)}, 2, '0')
    WHEN {_get(text.DAY_DATE, 1)} <> '' THEN {_get(text.DAY_DATE, 3)} || '-' || {_MONTH_NO.format(_get(text.DAY_DATE, 1))} || '-' || lpad({_get(text.DAY_DATE, 2)}, 2, '0')
    WHEN {_get(text.MONTH_DATE, 1)} <> '' THEN {_get(text.MONTH_DATE, 2)} || '-' || {_MONTH_NO.format(_get(text.MONTH_DATE, 1))} ELSE '' END AS issued,
    rtrim({_get(text.REVISION, 1)}, '.,;:') AS revision, rtrim({_get(text.DOC_NUMBER, 1)}, '.,;:') AS number FROM {MANUAL.sql()}"""
)
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return MANUAL.df(spark, d).select("doc", "pos", text.parse_date(t).alias("issued"), text.revision(t).alias("revision"), text.document_number(t).alias("number"))


_NORMAL = "lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '(?s)<!--.*?-->', ' ', 'g'), '(?m)^\\s*#{{1,6}}\\s*', ' ', 'g'), '(?m)^\\s*[*+-]\\s+', ' ', 'g'), '[^A-Za-z0-9]+', ' ', 'g')))"
_MARKED = "concat('# ', lang, chr(10), '- ', text, ' <!-- PageNumber=\"', doc_id, '\" -->', chr(10), source)"


@query(f"SELECT doc_id, {_NORMAL.format('t')} AS normal FROM (SELECT doc_id, {_MARKED} AS t FROM documents)")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("doc_id", f"{_MARKED} AS t").select("doc_id", text.normalize_text(F.col("t")).alias("normal"))


_HEAD = "concat('  ', p_name, '  —  ', p_type, '--', p_brand, ' ;.')"


@query(f"SELECT p_partkey, regexp_replace(regexp_replace(lower(trim(regexp_replace({_HEAD}, '\\s+', ' ', 'g'))), '[–—―-]+', '-', 'g'), '[.,:;]+$', '') AS header FROM part")
def norm_header(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("p_partkey", f"{_HEAD} AS t").select("p_partkey", text.norm_header(F.col("t")).alias("header"))


_TABLED = "concat('Ratings of ', p_name, chr(10), '| size | price |', chr(10), '| --- | --- |', chr(10), repeat(concat('| ', p_size, ' | x |', chr(10)), 1 + CAST(p_partkey % 3 AS INT)), 'as <TABLE><tr><td>', p_size, '</td></tr></TABLE> shows', CASE WHEN p_partkey % 2 = 0 THEN '<td>1</td> <td>2</td>' ELSE '<td>3</td>' END)"
_NOTE = "chr(10) || '[Table left out here; it has records of its own]' || chr(10)"


@query(
    f"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace({_TABLED}, '(?:^|\\n)\\|[^\\n]+\\|\\s*\\n\\|\\s*[-:|\\s]+\\|\\s*\\n(?:\\|[^\\n]+\\|\\s*\\n?)+', {_NOTE}, 'g'), '(?is)<table.*?</table\\s*>', {_NOTE}, 'g'),
    '(?is)(?:<t(?:[rdh]|head|body|foot)[^>]*>.*?</t(?:[rdh]|head|body|foot)\\s*>\\s*){{2,}}', {_NOTE}, 'g') AS stripped FROM part"""
)
def strip_inline_tables(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr("p_partkey", f"{_TABLED} AS t").select("p_partkey", text.strip_inline_tables(F.col("t")).alias("stripped"))


@query()
def highlight_text(spark: SparkSession, d: str) -> DataFrame:
    """Checked by unit tests: composition and look-around are beyond the SQL's engine."""
    return table(spark, d, "documents").select("doc_id", text.highlight_text(F.col("text")).alias("highlight"))


_STAMPED = "concat('Page ', l_linenumber, ' of ', l_suppkey, chr(10), 'Rev. ', l_linenumber, '.2', chr(10), 'body ', l_partkey, chr(10), 'Page ', l_linenumber, chr(10), 'more', chr(10), 'March 2024', chr(10), ' Confidential. ', chr(10), '<!-- PageBreak -->', chr(10), l_partkey, chr(10), 'Page ', l_suppkey)"
_EDGE = "list_filter(list_transform(string_split(b, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


@query(
    f"""SELECT l_orderkey * 10 + l_linenumber AS key, array_to_string(list_filter(list_transform(list_transform(string_split_regex({_STAMPED}, '{text.MARKER}'), lambda b: {_EDGE}),
    lambda ls: array_to_string(list_filter(ls, lambda x, i: NOT ((i <= 2 OR i > len(ls) - 2) AND regexp_matches(x, '{text.STAMP}'))), chr(10))), lambda t: t <> ''), chr(10)) AS stripped FROM lineitem"""
)
def strip_running(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS key", f"{_STAMPED} AS t").select("key", text.strip_running(F.col("t")).alias("stripped"))


@query(
    """SELECT l_orderkey, l_linenumber, substr(sha1('manuals/' || (l_orderkey % 97)::VARCHAR || '.pdf'), 1, 16) AS parent_id,
    concat_ws('_', 'trow', substr(sha1('manuals/' || (l_orderkey % 97)::VARCHAR || '.pdf'), 1, 16), l_partkey::VARCHAR || '_0', l_linenumber::VARCHAR) AS row_id,
    sha256(from_base64(to_base64(encode(l_shipmode)))) AS image_hash,
    bit_count(xor(('0x' || substr(md5(l_partkey::VARCHAR), 1, 8))::BIGINT, ('0x' || substr(md5(l_suppkey::VARCHAR), 1, 8))::BIGINT)) + bit_count(xor(('0x' || substr(md5(l_partkey::VARCHAR), 9, 8))::BIGINT, ('0x' || substr(md5(l_suppkey::VARCHAR), 9, 8))::BIGINT)) AS phash_distance
    FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)"""
)
def ids_and_hashes(spark: SparkSession, d: str) -> DataFrame:
    parent = ids.parent_id(F.concat(F.lit("manuals/"), (F.col("l_orderkey") % 97).cast("string"), F.lit(".pdf")), F.lit(""))
    phash = lambda c: F.substring(F.md5(F.col(c).cast("string")), 1, 16)
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        parent.alias("parent_id"),
        ids.table_row_chunk_id(parent, F.concat(F.col("l_partkey").cast("string"), F.lit("_0")), F.col("l_linenumber")).alias("row_id"),
        ids.image_hash(F.base64(F.concat("l_returnflag", "l_linestatus").cast("binary"))).alias("image_hash"),
        ids.phash_distance(phash("l_partkey"), phash("l_suppkey")).alias("phash_distance"),
    )


_TEXT_ROW = "SELECT doc, pos, text, concat('Chapter ', doc % 9) AS h1, CASE WHEN pos > 2 THEN concat('Part ', pos) ELSE '' END AS h2 FROM " + MANUAL.sql()


@query(
    f"""SELECT doc, pos, concat_ws(chr(10), 'Source: m' || (doc % 5)::VARCHAR || '.pdf', 'Section: ' || h1 || CASE WHEN h2 <> '' THEN ' > ' || h2 ELSE '' END, 'References: ' || concat_ws(' | ', nullif(array_to_string({_refs_sql(text.EQUATION, 2, "'Equation ' || x")}, ', '), ''),
    nullif(array_to_string(list_transform({_refs_sql(text.SECTION, 1)}, lambda x: 'Section ' || x), ', '), '')), 'Callouts: ' || nullif(array_to_string(list_transform(list_zip(regexp_extract_all(text, '{text.CALLOUT}', 1), regexp_extract_all(text, '{text.CALLOUT}', 2)), lambda z: upper(z[1]) || ': ' || trim(z[2])), ' || '), ''),
    array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '{text.STAMP}')), chr(10))) AS semantic FROM ({_TEXT_ROW})"""
)
def semantic_string_text(spark: SparkSession, d: str) -> DataFrame:
    rows = MANUAL.df(spark, d).selectExpr("doc", "pos", "text AS chunk", "concat('m', doc % 5, '.pdf') AS source_file", "concat('Chapter ', doc % 9) AS header_1", "CASE WHEN pos > 2 THEN concat('Part ', pos) ELSE '' END AS header_2", "'' AS header_3", "'' AS printed_page_label", "'' AS figure_ref", "'' AS table_ref")
    return semantic_text(rows).select("doc", "pos", F.col("chunk_for_semantic").alias("semantic"))


@query(
    """SELECT p_partkey, concat_ws(chr(10), 'Source: ' || p_brand || '.pdf', 'Page: ' || p_size::VARCHAR, CASE WHEN p_size % 3 = 0 THEN 'Diagram' ELSE 'Diagram: Figure ' || p_size::VARCHAR || CASE WHEN p_size % 2 = 0 THEN ' (schematic)' ELSE '' END END,
    p_type, CASE WHEN p_size % 5 <> 0 THEN 'Context: ' || p_name END) AS semantic FROM part"""
)
def semantic_string_diagram(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey", "concat(p_brand, '.pdf') AS source_file", "p_size AS physical_pdf_page", "CASE WHEN p_size % 3 = 0 THEN '' ELSE concat('Figure ', p_size) END AS figure_ref", "CASE WHEN p_size % 2 = 0 AND p_size % 3 <> 0 THEN 'schematic' ELSE '' END AS diagram_category", "concat(' ', p_type, ' ') AS diagram_description", "CASE WHEN p_size % 5 <> 0 THEN p_name ELSE ' ' END AS context_text")
    return semantic_diagram(rows).select("p_partkey", F.col("chunk_for_semantic").alias("semantic"))


@query(
    """SELECT p_partkey, CASE WHEN regexp_matches(c, 'schematic|circuit|wiring diagram|(single|one)[- ]line') THEN 'schematic_wiring' WHEN regexp_matches(c, 'name ?plate|(rating|label|data) plate') THEN 'nameplate'
    WHEN regexp_matches(c, 'p ?& ?id|(block|flow|logic) diagram|control logic|process flow') THEN 'block_flow' WHEN regexp_matches(c, 'exploded view|parts (list|diagram)|assembly drawing|call-?outs') THEN 'parts_exploded' ELSE 'default' END AS guess
    FROM (SELECT p_partkey, lower(CASE p_partkey % 6 WHEN 0 THEN 'One-line Circuit' WHEN 1 THEN 'Rating Plate' WHEN 2 THEN 'P&ID of ' WHEN 3 THEN 'Exploded View' ELSE 'Photo' END || ' ' || p_name) AS c FROM part)"""
)
def guess_category(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").selectExpr("p_partkey", "p_name", "CASE p_partkey % 6 WHEN 0 THEN 'One-line Circuit' WHEN 1 THEN 'Rating Plate' WHEN 2 THEN 'P&ID of ' WHEN 3 THEN 'Exploded View' ELSE 'Photo' END AS caption")
    return rows.select("p_partkey", text.guess_category(F.col("caption"), F.col("p_name")).alias("guess"))

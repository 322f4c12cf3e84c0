"""Records of the index: five kinds, each made by one plan, projected to one wide schema and put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import ids, markers, text
from paperloom.operators import figures, pages, tables
from paperloom.operators.semantic import semantic_diagram, semantic_text
from paperloom.schemas import RECORD, RECORD_TYPES

#: Fields that come from a document's metadata.
MAPPINGS = {"metadata_operationalarea": "operationalarea", "metadata_functionalarea": "functionalarea", "metadata_doctype": "doctype", "metadata_storage_file_extension": "filetype"}


def mapped_fields(df: DataFrame) -> DataFrame:
    """Rows with the fields of a document's metadata under the names that they have in the index."""
    return df.withColumnsRenamed(MAPPINGS)


def provenance(df: DataFrame, kind: str, version: str, now: Column) -> DataFrame:
    """The fields of every kind: its type, the parent in the one column of that type, versions and time."""
    return df.withColumns({"record_type": F.lit(kind), RECORD_TYPES[kind]: F.col("parent_id"), "skill_version": F.lit(version), "last_indexed_at": now, "id": F.col("chunk_id")})


def printed_labels(df: DataFrame) -> DataFrame:
    """Adds the printed labels of chunks (chunk, first_page, last_page) and of the furniture of their first and last page
    (first_furniture, last_furniture): a marker's, one that the text seems to carry, the furniture's, or the page's number."""
    labels = F.filter(F.transform(F.regexp_extract_all("chunk", text.pattern(text.NUMBER_MARKER), F.lit(1)), text.strip), lambda x: x != "")
    start = F.coalesce(F.get(labels, F.lit(0)), text.printed_label(F.col("chunk")), F.col("first_furniture"))
    end = F.coalesce(F.get(labels, F.size(labels) - 1), text.printed_label(markers.last_page_part(F.col("chunk"))), F.col("last_furniture"), F.col("last_page").cast("string"))
    several = F.col("last_page") > F.col("first_page")
    label = F.coalesce(start, F.col("first_page").cast("string"), F.lit(""))
    return df.withColumns({"printed_page_label": label, "printed_page_label_end": F.when(several, end).otherwise(label), "printed_page_label_is_synthetic": start.isNull() & F.col("first_page").isNotNull()})


def boxes_json(boxes: Column) -> Column:
    """Boxes as a JSON list; '' for none."""
    return F.when(F.size(boxes) > 0, F.to_json(boxes)).otherwise("")


def text_records(chunks: DataFrame, version: str, now: Column) -> DataFrame:
    """Text records of chunks (parent_id, source_file, source_path, layout_ordinal, chunk, section_content, header_1..3, di_page,
    header_page, fuzzy_page, bbox_primary, bbox_last, bbox_pages, boxes, first_furniture, last_furniture, pdf_total_pages)."""
    c = F.col("chunk")
    known = F.coalesce("di_page", "header_page", "fuzzy_page")
    numbers = F.concat(markers.whole_numbers(c), markers.whole_numbers(F.coalesce("section_content", F.lit(""))))
    df = chunks.withColumns({"span": markers.page_span(c, F.col("section_content"), known), "marker_page": F.get(numbers, F.lit(0))})
    df = printed_labels(pages.resolve_pages(df))
    figs, tabs = text.figure_refs(c), text.table_refs(c)
    df = df.withColumns(
        {
            "figures_referenced": figs,
            "figures_referenced_normalized": F.array_sort(F.array_distinct(F.transform(figs, text.figure_key))),
            "figure_ref": F.coalesce(F.get(figs, F.lit(0)), F.lit("")),
            "tables_referenced": tabs,
            "table_ref": F.coalesce(F.get(tabs, F.lit(0)), F.lit("")),
            "sections_referenced": text.section_refs(c),
            "pages_referenced": text.page_refs(c),
            "equipment_ids": text.equipment_ids(c),
            "callouts": text.callout_kinds(c),
            "language": text.detect_language(c),
            "highlight_text": text.highlight_text(c),
            "chunk_token_count": ids.token_estimate(c).cast("int"),
            "chunk_content_hash": ids.short_hash(c),
            "chunk_id": ids.text_chunk_id(F.col("parent_id"), F.col("layout_ordinal"), c),
            "toc": text.is_toc_like(c),
            "glossary": text.is_glossary(c, *[F.col(f"header_{k}") for k in (1, 2, 3)]),
            "text_bbox": boxes_json(F.col("boxes")),
        }
    )
    headed = F.concat_ws("", "header_1", "header_2", "header_3") != ""
    refs = (F.size("figures_referenced") > 0) | (F.size("tables_referenced") > 0)
    df = df.withColumns(
        {
            "safety_callout": F.size("callouts") > 0,
            "record_subtype": F.when(F.col("glossary"), "glossary").otherwise(""),
            "processing_status": F.when(F.col("toc"), "toc_like").otherwise("ok"),
            "chunk_quality_score": text.quality_score(F.col("page_resolution_method"), F.length(c), headed, F.col("toc"), F.size("callouts") > 0, refs),
        }
    )
    df = semantic_text(df).withColumnsRenamed({"first_page": "physical_pdf_page", "last_page": "physical_pdf_page_end", "pages": "physical_pdf_pages"})
    return provenance(df, "text", version, now)


def table_records(merged: DataFrame, version: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """Table records and row records of merged tables (doc is the parent's id)."""
    split = tables.table_records(merged).withColumn("parent_id", F.col("doc"))
    t = split.select(
        "parent_id",
        ids.table_chunk_id(F.col("parent_id"), F.col("table_index")).alias("chunk_id"),
        "table_index",
        F.col("markdown").alias("chunk"),
        F.concat_ws("\n", F.nullif("caption", F.lit("")), "markdown").alias("chunk_for_semantic"),
        F.coalesce("caption", F.lit("")).alias("table_caption"),
        F.col("row_count").alias("table_row_count"),
        F.col("col_count").alias("table_col_count"),
        F.col("page_start").alias("physical_pdf_page"),
        F.col("page_end").alias("physical_pdf_page_end"),
        F.sequence("page_start", "page_end").alias("physical_pdf_pages"),
        ids.short_hash(F.col("markdown"), 16).alias("chunk_content_hash"),
        F.lit("ok").alias("processing_status"),
    )
    r = tables.row_records(merged).withColumn("parent_id", F.col("doc"))
    rows = r.select(
        "parent_id",
        ids.table_row_chunk_id(F.col("parent_id"), F.col("table_index"), F.col("row_index")).alias("chunk_id"),
        ids.table_chunk_id(F.col("parent_id"), F.col("table_index")).alias("table_parent_chunk_id"),
        "table_index",
        F.col("row_index").cast("int").alias("table_row_index"),
        F.col("row_text").alias("chunk"),
        F.col("row_text").alias("chunk_for_semantic"),
        F.col("page").alias("physical_pdf_page"),
        F.col("page").alias("physical_pdf_page_end"),
        F.array("page").alias("physical_pdf_pages"),
        ids.short_hash(F.col("row_text"), 16).alias("chunk_content_hash"),
        F.lit("ok").alias("processing_status"),
    )
    return provenance(t, "table", version, now), provenance(rows, "table_row", version, now)


def diagram_records(figs: DataFrame, version: str, now: Column) -> DataFrame:
    """Diagram records of figures (parent_id, source_file, figure_id, image_b64, page, caption, context_text, precomputed, hash_hit,
    phash_hit, error, useful, category, figure_ref, description, ocr_text)."""
    seen = F.when(F.col("image_b64").isNotNull(), F.length(F.try_to_binary("image_b64", F.lit("base64"))))
    df = figures.status_ladder(figs.withColumns({"n_bytes": seen, "category": figures.category(F.col("category"))}))
    ref = ids.first_filled(F.col("figure_ref"), F.get(text.figure_refs(F.when(F.coalesce("caption", F.lit("")) != "", F.col("caption")).otherwise(F.col("context_text"))), F.lit(0)))
    labels = F.when(F.coalesce("ocr_text", F.lit("")) != "", F.concat_ws("\n", F.nullif("description", F.lit("")), F.concat(F.lit("Labels: "), "ocr_text"))).otherwise(F.coalesce("description", F.lit("")))
    df = df.withColumns({"figure_ref": F.coalesce(ref, F.lit("")), "has_diagram": figures.has_diagram(F.col("useful"), F.col("category"), F.col("description")), "diagram_category": F.when(F.col("processing_status") == "skipped_tiny", "decorative").otherwise(F.col("category")), "diagram_description": labels, "image_hash": ids.image_hash(F.col("image_b64")), "image_phash": F.lit(""), "physical_pdf_page": F.col("page")})
    df = df.withColumns({"chunk_id": ids.diagram_chunk_id(F.col("parent_id"), F.col("image_hash")), "chunk": F.col("diagram_description"), "surrounding_context": F.col("context_text"), "physical_pdf_page_end": F.col("page"), "physical_pdf_pages": F.array("page"), "figures_referenced_normalized": F.array(text.figure_key(F.col("figure_ref")))})
    return provenance(semantic_diagram(df), "diagram", version, now)


def summary_records(sections: DataFrame, summarise, version: str, now: Column) -> DataFrame:
    """A summary record for each document of sections (parent_id, source_file, position, title, content). ``summarise`` takes rows with a
    prompt and adds ``summary``; documents without content don't get to it."""
    ordered = F.array_sort(F.collect_list(F.struct("position", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("content", F.lit("")).alias("content"))))
    docs = sections.groupBy("parent_id", "source_file").agg(ordered.alias("s"))
    titles = F.slice(F.filter(F.transform("s", lambda x: x["title"]), lambda t: t != ""), 1, 40)
    body = F.substring(F.array_join(F.filter(F.transform("s", lambda x: x["content"]), lambda t: t != ""), "\n"), 1, 20_000)
    docs = docs.select("parent_id", "source_file", F.concat_ws("\n", F.array_join(F.transform(titles, lambda t: F.concat(F.lit("- "), t)), "\n"), body).alias("prompt"), (body != "").alias("some"))
    done = summarise(docs.where("some")).withColumn("processing_status", F.lit("ok")).unionByName(docs.where("NOT some").withColumns({"summary": F.lit(""), "processing_status": F.lit("no_content")}))
    done = done.select("parent_id", "source_file", F.col("summary").alias("chunk"), F.col("summary").alias("chunk_for_semantic"), "processing_status", F.lit("document_summary").alias("page_resolution_method"), ids.summary_chunk_id(F.col("parent_id")).alias("chunk_id"))
    return provenance(done, "summary", version, now)


def project(*kinds: DataFrame) -> DataFrame:
    """The records of all kinds in the index's schema; fields that a kind lacks are null."""
    out = None
    for df in kinds:
        row = df.select(*[(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in RECORD.fields])
        out = row if out is None else out.unionByName(row)
    return out

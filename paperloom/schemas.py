"""Schemas: the layout of a document, and the wide record of the index."""

from __future__ import annotations

from pyspark.sql import types as T

_REGIONS = "array<struct<pageNumber:int,polygon:array<double>>>"
LAYOUT_DDL = (
    "pages array<struct<pageNumber:int,width:double,height:double,unit:string,words:array<struct<confidence:double>>>>, "
    f"paragraphs array<struct<role:string,content:string,boundingRegions:{_REGIONS}>>, "
    "sections array<struct<elements:array<string>>>, "
    f"figures array<struct<id:string,caption:struct<content:string>,boundingRegions:{_REGIONS}>>, "
    f"tables array<struct<rowCount:int,columnCount:int,caption:struct<content:string>,boundingRegions:{_REGIONS},"
    "cells:array<struct<rowIndex:int,columnIndex:int,rowSpan:int,columnSpan:int,kind:string,content:string>>>>"
)

RECORD_TYPES = {"text": "text_parent_id", "diagram": "dgm_parent_id", "table": "tbl_parent_id", "table_row": "tbl_row_parent_id", "summary": "sum_parent_id"}

_S, _I, _B, _D = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
_STRINGS, _INTS = T.ArrayType(_S), T.ArrayType(_I)
#: Fields by what they can do: f filter, t facet, s search, o order.
_FIELDS: tuple[tuple[str, T.DataType, str], ...] = (
    ("id", _S, "f"),
    ("chunk_id", _S, "f"),
    ("parent_id", _S, "ft"),
    *((p, _S, "f") for p in RECORD_TYPES.values()),
    ("record_type", _S, "ft"),
    ("record_subtype", _S, "ft"),
    ("chunk", _S, "s"),
    ("chunk_for_semantic", _S, "s"),
    ("highlight_text", _S, "s"),
    ("pdf_total_pages", _I, "f"),
    ("document_revision", _S, "ft"),
    ("effective_date", _S, "fo"),
    ("document_number", _S, "ft"),
    ("language", _S, "ft"),
    ("ocr_min_confidence", _D, "fo"),
    ("equipment_ids", _STRINGS, "ft"),
    ("callouts", _STRINGS, "ft"),
    ("safety_callout", _B, "ft"),
    ("embedding", T.ArrayType(T.FloatType()), ""),
    ("physical_pdf_page", _I, "fo"),
    ("physical_pdf_page_end", _I, "fo"),
    ("physical_pdf_pages", _INTS, "f"),
    ("printed_page_label", _S, "f"),
    ("printed_page_label_end", _S, "f"),
    ("printed_page_label_is_synthetic", _B, "f"),
    ("page_resolution_method", _S, "ft"),
    ("layout_ordinal", _I, "fo"),
    ("header_1", _S, "fts"),
    ("header_2", _S, "fts"),
    ("header_3", _S, "fts"),
    ("figure_ref", _S, "fs"),
    ("table_ref", _S, "fs"),
    ("figures_referenced", _STRINGS, "f"),
    ("figures_referenced_normalized", _STRINGS, "f"),
    ("tables_referenced", _STRINGS, "f"),
    ("sections_referenced", _STRINGS, "f"),
    ("pages_referenced", _STRINGS, "f"),
    ("footnotes", _STRINGS, "s"),
    ("figure_id", _S, "f"),
    ("figure_bbox", _S, ""),
    ("text_bbox", _S, ""),
    ("table_bbox", _S, ""),
    ("image_hash", _S, "f"),
    ("image_phash", _S, "f"),
    ("diagram_description", _S, "s"),
    ("diagram_category", _S, "ft"),
    ("has_diagram", _B, "ft"),
    ("table_index", _S, "f"),
    ("table_caption", _S, "s"),
    ("table_row_count", _I, "f"),
    ("table_col_count", _I, "f"),
    ("table_parent_chunk_id", _S, "f"),
    ("table_row_index", _I, "fo"),
    ("source_file", _S, "ft"),
    ("source_path", _S, "f"),
    ("surrounding_context", _S, "s"),
    ("processing_status", _S, "ft"),
    ("skill_version", _S, "ft"),
    ("embedding_version", _S, "ft"),
    ("last_indexed_at", T.TimestampType(), "fo"),
    ("chunk_token_count", _I, "f"),
    ("chunk_quality_score", _D, "fo"),
    ("chunk_content_hash", _S, "f"),
    ("operationalarea", _S, "ft"),
    ("functionalarea", _S, "ft"),
    ("doctype", _S, "ft"),
)
_CAN = {"f": "filterable", "t": "facetable", "s": "searchable", "o": "sortable"}
RECORD = T.StructType([T.StructField(n, t, True, {v: k in c for k, v in _CAN.items()}) for n, t, c in _FIELDS])


def fields_that_can(what: str) -> list[str]:
    """Fields that are filterable, facetable, searchable or sortable."""
    return [f.name for f in RECORD.fields if f.metadata[what]]


def unknown_fields(names: list[str], schema: T.StructType = RECORD) -> set[str]:
    return set(names) - set(schema.fieldNames())

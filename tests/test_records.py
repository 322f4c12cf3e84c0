"""Records of all five kinds, from small inputs to the wide schema and to search."""

import base64

from pyspark.sql import functions as F

from paperloom.operators import adapters, records, search, tables, upkeep
from paperloom.schemas import RECORD, RECORD_TYPES

NOW = "2024-05-06 07:08:09"


def _all(spark):
    now = F.lit(NOW).cast("timestamp")
    chunk = "WARNING: live parts. See Figure 4-2 and Table 18-3 in Section 4.2 of the manual for GE-THQL-1120-2. " * 3
    rows = [
        ("p1", "m.pdf", "m.pdf", 0, chunk, f"before <!-- PageBreak -->{chunk}", "Safety", "", "", 5, None, None, None, None, [], [], "5-7", None, 9),
        ("p1", "m.pdf", "m.pdf", 1, "plain words", None, "Glossary", "", "", None, None, None, 4, 6, [4, 6], [(4, 0.0, 0.0, 1.0, 1.0)], None, None, 9),
        ("p1", "m.pdf", "m.pdf", 2, "nothing is known", "", "", "", "", None, None, None, None, None, [], [], None, None, 9),
    ]
    schema = "parent_id string, source_file string, source_path string, layout_ordinal int, chunk string, section_content string, header_1 string, header_2 string, header_3 string, di_page int, header_page int, fuzzy_page int, bbox_primary int, bbox_last int, bbox_pages array<int>, boxes array<struct<page:int,x_in:double,y_in:double,w_in:double,h_in:double>>, first_furniture string, last_furniture string, pdf_total_pages int"
    texts = records.text_records(spark.createDataFrame(rows, schema), "1.0.0", now)
    grid = [["Volt", "Amp"], *[[str(i), str(i * 2)] for i in range(6)]]
    merged = tables.merge_continuations(spark.createDataFrame([("p1", 1, 2, 2, 2, "Ratings", grid, 1)], "doc string, pos int, first_page int, last_page int, cols int, caption string, grid array<array<string>>, header_rows int"))
    tabs, trows = records.table_records(merged, "1.0.0", now)
    big, small = base64.b64encode(b"x" * 12_000).decode(), base64.b64encode(b"x").decode()
    figs = [
        ("p1", "m.pdf", "f1", big, 5, "Figure 4-2 — Bar", "around", False, False, False, None, True, "schematic", "", "A bar.", "R1 | C2"),
        ("p1", "m.pdf", "f2", small, 5, "", "see Fig. 7", False, False, False, None, None, None, None, None, None),
        ("p1", "m.pdf", "f3", None, 6, "", "", False, False, False, None, None, None, None, None, None),
    ]
    diagrams = records.diagram_records(spark.createDataFrame(figs, "parent_id string, source_file string, figure_id string, image_b64 string, page int, caption string, context_text string, precomputed boolean, hash_hit boolean, phash_hit boolean, error string, useful boolean, category string, figure_ref string, description string, ocr_text string"), "1.0.0", now)
    secs = spark.createDataFrame([("p1", "m.pdf", 1, "One", "First. Second."), ("p1", "m.pdf", 0, "Zero", None), ("p2", "n.pdf", 0, "Empty", "")], "parent_id string, source_file string, position int, title string, content string")
    sums = records.summary_records(secs, lambda d: adapters.apply(d, lambda: adapters.stub_summary, "prompt", "summary", "string"), "1.0.0", now)
    return records.project(texts, tabs, trows, diagrams, sums)


def test_records_of_all_kinds(spark):
    df = _all(spark).cache()
    assert df.schema.fieldNames() == RECORD.fieldNames()
    got = df.collect()
    by = {k: sorted((r for r in got if r["record_type"] == k), key=lambda r: r["chunk_id"]) for k in RECORD_TYPES}
    assert {k: len(v) for k, v in by.items()} == {"text": 3, "table": 1, "table_row": 6, "diagram": 3, "summary": 2}
    for r in got:
        assert [k for k, c in RECORD_TYPES.items() if r[c] is not None] == [r["record_type"]]
        assert r["chunk_id"].startswith({"text": "txt_", "table": "tbl_", "table_row": "trow_", "diagram": "dgm_", "summary": "sum_"}[r["record_type"]])
    t = {r["layout_ordinal"]: r for r in by["text"]}
    assert (t[0]["page_resolution_method"], t[0]["physical_pdf_page"], t[0]["physical_pdf_pages"]) == ("di_input", 6, [6]) and t[0]["printed_page_label"] == "5-7" and not t[0]["printed_page_label_is_synthetic"]
    assert t[0]["callouts"] == ["WARNING"] and t[0]["figures_referenced_normalized"] == ["42"] and t[0]["equipment_ids"] == ["GE-THQL-1120-2"] and t[0]["chunk_quality_score"] == 0.9
    assert t[0]["chunk_for_semantic"].startswith("Source: m.pdf\nSection: Safety\nPage: 5-7\nReferences: Figure 4-2 | Table 18-3 | Section 4.2\nCallouts: WARNING: live parts.")
    assert (t[1]["page_resolution_method"], t[1]["physical_pdf_page"], t[1]["physical_pdf_page_end"], t[1]["record_subtype"]) == ("paragraph_bbox", 4, 6, "glossary") and t[1]["text_bbox"].startswith('[{"page":4')
    assert t[1]["printed_page_label"] == "4" and t[1]["printed_page_label_is_synthetic"] and t[2]["page_resolution_method"] == "missing" and t[2]["physical_pdf_page"] is None
    assert by["table"][0]["table_row_count"] == 6 and {r["table_parent_chunk_id"] for r in by["table_row"]} == {by["table"][0]["chunk_id"]} and by["table_row"][2]["chunk"] == "Volt: 2; Amp: 4"
    d = {r["processing_status"]: r for r in by["diagram"]}
    assert set(d) == {"ok", "skipped_tiny", "no_image"} and d["ok"]["has_diagram"] and d["ok"]["figure_ref"] == "Figure 4-2" and d["ok"]["diagram_description"] == "A bar.\nLabels: R1 | C2" and d["skipped_tiny"]["figure_ref"] == "Fig. 7" and d["skipped_tiny"]["diagram_category"] == "decorative"
    assert {r["parent_id"]: r["processing_status"] for r in by["summary"]} == {"p1": "ok", "p2": "no_content"}
    breaks = upkeep.contract_breaks(df.where("record_type = 'text'"), ["chunk_id", "chunk"], ["physical_pdf_pages"], ["text_bbox"])
    assert all(not r["breaks"] for r in breaks.collect())
    hits, facets = search.search(df, search.SearchRequest(search="live parts", filter="record_type eq 'text' and callouts/any(c: c eq 'WARNING')", facets=["record_type"], select=["chunk_id"]))
    assert [r["chunk_id"] for r in hits.collect()] == [t[0]["chunk_id"]] and [tuple(r) for r in facets["record_type"].collect()] == [("text", 1)]

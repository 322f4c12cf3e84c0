"""Operators on small inputs, with the ties and gaps that the tables of the queries may lack."""

import json

import pytest
from pyspark.sql import functions as F

from paperloom import schemas
from paperloom.operators import adapters, chunks, figures, pages, search, sections, tables, upkeep
from paperloom.sources import files
from paperloom.streaming import incremental


def test_chunks(spark):
    df = spark.createDataFrame([(1, "x" * 1200), (2, "y" * 1201), (3, ""), (4, None), (5, "z" * 3000)], "id int, text string")
    got = {}
    for r in chunks.chunk(df).collect():
        got.setdefault(r["id"], []).append(len(r["chunk"]))
    assert got == {1: [1200], 2: [1200, 201], 5: [1200, 1200, 1000]}


def _p(text, page, role="", polygon=()):
    region = {"polygon": list(polygon), "pageNumber": page}
    return {"role": role, "content": text, "boundingRegions": [region]}


def _tree(*sections):
    kinds = {"p": "/paragraphs/", "s": "/sections/"}
    return [{"elements": [kinds.get(e[0], "") + e[1:] for e in s.split()]} for s in sections]


def test_section_index():
    ps = [_p("Manual", 1, "title"), _p("MANUAL.", 1, "sectionHeading"), _p("1.2 Meters", 81, "sectionHeading"), _p("drift", 75), _p("body", 82), _p("Footer of the page, long enough to count", 3, "pageFooter"), _p("An orphan paragraph that is long enough", 3), _p("short", 3), _p("Deep", 90, "sectionHeading")]
    ss = _tree("p0 p1 s1", "p3 p2 p4 s2 s1 bad", "p8")
    out = sections.section_index(ps, ss)
    assert [(s["header_1"], s["header_2"], s["header_3"], s["page_start"], s["page_end"]) for s in out] == [("Manual", "", "", 1, 1), ("Manual", "1.2 Meters", "", 81, 82), ("Manual", "1.2 Meters", "Deep", 90, 90), ("(orphan paragraphs)", "", "", 3, 3)]
    assert out[3]["section_idx"] == 100_003 and out[3]["content"] == "An orphan paragraph that is long enough"
    assert sections.section_index(None, None) == []


def test_section_indexes_in_parallel(spark):
    rows = [(f"d{i}", [_p("Part", i + 1, "title"), _p("body", i + 2)], _tree("p0 p1")) for i in range(5)]
    df = spark.createDataFrame(rows, "doc string, paragraphs array<struct<role:string,content:string,boundingRegions:array<struct<pageNumber:int,polygon:array<double>>>>>, sections array<struct<elements:array<string>>>")
    assert sorted((r["doc"], r["page_start"], r["page_end"]) for r in sections.section_indexes(df).collect()) == [(f"d{i}", i + 1, i + 2) for i in range(5)]


def test_sections_of_ranges(spark):
    ss = spark.createDataFrame([(0, 1, 1, 3, False), (0, 2, 4, 6, False), (1, 3, 1, 10, False), (1, 4, 4, 6, False), (2, 5, 1, 2, True), (2, 6, 2, 9, False), (3, 7, 1, 2, False), (3, 8, 3, 4, False)], "doc int, section_idx int, page_start int, page_end int, is_orphan boolean")
    es = spark.createDataFrame([(1, 0, 3, 5), (2, 1, 4, 6), (3, 2, 1, 2), (4, 3, 2, 3), (5, 0, 9, 9), (6, 2, 2, None)], "key int, doc int, page int, page_to int")
    assert {r["key"]: r["section_idx"] for r in pages.section_for_range(es, ss, "key").collect()} == {1: 2, 2: 4, 3: 5, 4: 7, 5: None, 6: 6}


def test_boxes_and_fuzzy_pages(spark):
    one = "the quick brown fox jumps over the lazy dog again and again"
    ps = spark.createDataFrame([(0, one, len(one), 2, 1.0, 1.0, 2.0, 1.0), (0, one, len(one), 2, 0.5, 2.0, 1.0, 1.0), (0, "too short", 9, 2, 0.0, 0.0, 9.0, 9.0), (0, "q" * 250, 250, 3, 0.0, 0.0, 1.0, 1.0)], "doc int, normal string, raw_length int, page int, x_in double, y_in double, w_in double, h_in double")
    cs = spark.createDataFrame([(7, 0, f"before {one} after too short {'q' * 99}")], "key int, doc int, normal string")
    boxes = pages.chunk_boxes(cs, ps)
    assert [tuple(r) for r in pages.union_boxes(boxes, ["key"]).collect()] == [(7, 2, 0.5, 1.0, 2.5, 2.0)]
    ss = spark.createDataFrame([(0, 1, 4, "abc"), (0, 2, 5, "x" + one), (0, 3, 6, one + one)], "doc int, section_idx int, page_start int, normal string")
    assert pages.fuzzy_pages(spark.createDataFrame([(1, 0, one)], "key int, doc int, normal string"), ss).first()["fuzzy_page"] == 5
    poly = spark.createDataFrame([([1.0, 2.0, 3.0, 2.0, 3.0, 5.0, 1.0, 5.0],), ([1.0],)], "p array<double>").select(pages.box_of(F.col("p")).alias("b")).collect()
    assert tuple(poly[0]["b"]) == (1.0, 2.0, 2.0, 3.0) and poly[1]["b"] is None


def test_merged_tables(spark):
    head = ["Voltage", "Amps"]
    body = lambda n: [[f"{n}{i}", str(i)] for i in range(3)]
    rows = [(0, 1, 1, 1, 2, "", [["Ratings", "Ratings"], head, *body("a")], 2), (0, 2, 2, 2, 2, "", [["Ratings", "Ratings"], head, *body("b")], 1), (0, 3, 3, 3, 2, "", body("c"), 1), (0, 4, 4, 4, 2, "Other", [head, *body("d")], 1)]
    t = spark.createDataFrame(rows, "doc int, pos int, first_page int, last_page int, cols int, caption string, grid array<array<string>>, header_rows int")
    merged = tables.merge_continuations(t)
    got = {r["cluster"]: r for r in merged.collect()}
    assert got[0]["heads"] == ["Ratings — Voltage", "Ratings — Amps"] and [(b["page"], b["values"][0]) for b in got[0]["body"]] == [(1, "a0"), (1, "a1"), (1, "a2"), (2, "b0"), (2, "b1"), (2, "b2"), (3, "c0"), (3, "c1"), (3, "c2")]
    assert (got[0]["page_start"], got[0]["page_end"], got[1]["caption"]) == (1, 3, "Other")
    records = {(r["cluster"], r["split"]): r for r in tables.table_records(merged).collect()}
    assert records[0, 0]["table_index"] == "0_0" and records[0, 0]["row_count"] == 9 and records[0, 0]["markdown"].startswith("| Ratings — Voltage | Ratings — Amps |\n| --- | --- |\n| a0 | 0 |")
    rr = sorted((r["row_index"], r["page"], r["row_text"]) for r in tables.row_records(merged).collect())
    assert len(rr) == 9 and rr[3] == (3, 2, "Ratings — Voltage: b0; Ratings — Amps: 0"), "tables of fewer than five rows have no row records"


def test_header_rows_and_grids(spark):
    cells = [(1, 0, 0, 0, None, 2, "Top | x", "columnHeader", 2, 2), (1, 1, 1, 0, 1, 1, "a\nb", "columnHeader", 2, 2), (1, 2, 5, 5, 1, 1, "outside", "", 2, 2), (2, 0, 0, 0, 1, 1, "x", "", 9000, 2)]
    df = spark.createDataFrame(cells, "table_id int, pos int, r int, c int, rs int, cs int, text string, kind string, rows int, cols int")
    assert {r["table_id"]: r["grid"] for r in tables.grids(df).collect()} == {1: [["Top \\| x", "Top \\| x"], ["a b", ""]]}
    assert {r["table_id"]: r["header_rows"] for r in tables.header_rows(df.where("table_id = 1 AND r < 5").union(df.where("table_id = 2"))).collect()} == {1: 2, 2: 1}


def test_filters(spark):
    df = spark.createDataFrame([(1, "o'malley", ["a", "b"], None), (2, "x", [], 5)], "id int, name string, tags array<string>, n int")
    ids = lambda f: [r["id"] for r in df.where(search.parse_filter(f, df.columns)).orderBy("id").collect()]
    assert ids("name eq 'o''malley'") == [1] and ids("tags/any(t: t eq 'b')") == [1] and ids("not tags/any()") == [2] and ids("n ne null and (n gt 4 or id eq 1)") == [2]
    for bad in ("name eq", "nope eq 1", "name eq 'x' name", "name ~ 1"):
        with pytest.raises(ValueError):
            search.parse_filter(bad, df.columns)
    assert search.escape_literal("o'malley") == "o''malley" and search.safe_token("a b") == search.safe_token("o'm") == "" and search.safe_token("a-B_1") == "a-B_1"


def test_search(spark):
    docs = spark.createDataFrame([(1, "fuse ratings of the meter. A fuse blows.", [1.0, 0.0], "a"), (2, "the meter", [0.0, 1.0], "b"), (3, None, [1.0, 1.0], "b")], "id int, chunk string, embedding array<float>, kind string")
    hits, facets = search.search(docs, search.SearchRequest(search="fuse", facets=["kind"], select=["id"]))
    assert [r["id"] for r in hits.collect()] == [1] and [tuple(r) for r in facets["kind"].collect()] == [("b", 2), ("a", 1)]
    hits, _ = search.search(docs, search.SearchRequest(search="meter", vector=[0.0, 1.0], filter="kind eq 'b'"))
    assert [r["id"] for r in hits.collect()] == [2, 3]
    assert docs.where("id = 1").select(search.caption(F.col("chunk"), "a fuse").alias("c")).first()["c"] == "A fuse blows."
    ranked = search.rerank(docs.withColumn("score", F.lit(1.0)), "fuse meter", {"chunk": 1.0})
    assert [r["id"] for r in ranked.collect()] == [1, 2, 3]


def test_upkeep(spark):
    plan = spark.createDataFrame([("a", "DELETED"), ("b", "EDITED"), ("c", "ADDED")], "name string, change string")
    assert upkeep.purges(plan, 2).count() == 2
    with pytest.raises(ValueError):
        upkeep.purges(plan, 1)
    names = spark.createDataFrame([("a.PDF",), ("_dicache/a.pdf",), ("b.docx",), ("c.txt",)], "n string")
    assert [r["n"] for r in names.where(upkeep.is_document(F.col("n"))).collect()] == ["a.PDF", "b.docx"]
    assert [r["n"] for r in names.where(upkeep.needs_conversion(F.col("n"))).collect()] == ["b.docx"]
    runs = upkeep.run_records(spark.createDataFrame([("x", None, None, "2024-01-02")], "run_type string, id string, ended_at timestamp, s string").withColumn("started_at", F.col("s").cast("timestamp")), F.lit("2024-02-01").cast("timestamp")).first()
    assert runs["id"] == "x-20240102T000000" and runs["partitionKey"] == "2024-01-02" and str(runs["ended_at"]) == "2024-02-01 00:00:00"


def test_figures(spark):
    crops = spark.createDataFrame([(1, "h", 2), (1, "h", 1), (2, "h", 3)], "doc int, sha string, pos int")
    assert sorted((r["doc"], r["pos"]) for r in figures.dedup_crops(crops).collect()) == [(1, 1), (2, 3)]
    loss = spark.createDataFrame([(4, 4), (40, 9), (40, 10), (8, 5), (0, 0)], "n int, d int").select(figures.loss_status(F.col("n"), F.col("d")).alias("s")).collect()
    assert [r["s"] for r in loss] == ["all_figures_dropped", "ok", "partial_figure_loss", "partial_figure_loss", "ok"]
    tries = spark.createDataFrame([(None, False), (2, False), (3, False), (0, True)], "n int, p boolean").select(figures.retry(F.col("n"), F.col("p")).alias("a")).collect()
    assert [r["a"] for r in tries] == [1, 3, 3, 3]
    ps = spark.createDataFrame([(1, 1), (1, 2)], "doc int, page int")
    assert [r["page"] for r in figures.supplement(ps, ps.where("page = 1")).collect()] == [2]


def test_adapters(spark):
    calls = []

    def flaky(x):
        calls.append(x)
        if x == "bad":
            raise adapters.PermanentError
        if x == "slow" and calls.count("slow") < 3:
            raise TimeoutError
        return {"is_useful": True, "description": "long enough a description"}

    out = adapters.with_retries(flaky)(["ok", "bad", "slow"])
    assert [(o["error"], o["attempts"]) for o in out] == [(None, 1), ("PermanentError", 3), (None, 3)]
    df = spark.createDataFrame([("a", "done"), ("b", None)], "image string, status string")
    got = adapters.residual(df, "status IS NOT NULL", lambda d: adapters.apply(d, lambda: adapters.with_retries(adapters.stub_vision), "image", "vision", adapters.VISION))
    assert {r["image"]: r["vision"] is not None for r in got.collect()} == {"a": False, "b": True}
    assert adapters.extract_json('```json\n{"a": 1}\n```') == {"a": 1} and adapters.extract_json('so: {"a": 2}.') == {"a": 2} and adapters.extract_json("none") is None
    assert adapters.difference_hash([[9, 8, 7, 6, 5, 4, 3, 2, 1]] * 8) == "f" * 16 and adapters.luminance_class([5] + [0] * 200 + [95] + [0] * 54) == "line_art"
    assert len(adapters.stub_embedding(["a b", None])[0]) == 64 and adapters.stub_summary(["One. Two. Three. Four."]) == ["One. Two. Three."]


def test_layout_files(spark, tmp_path):
    layout = {"pages": [{"pageNumber": 1, "width": 8.5}], "paragraphs": [_p("x", 1)]}
    (tmp_path / "a.json").write_text(json.dumps({"analyzeResult": layout}))
    (tmp_path / "b.json").write_text(json.dumps(layout))
    (tmp_path / "c.json").write_text("{broken")
    (tmp_path / "d e.pdf").write_text("pdf")
    good, bad = files.layouts(spark, str(tmp_path))
    assert sorted((r["doc"], r["paragraphs"][0]["content"]) for r in good.collect()) == [("a.json", "x"), ("b.json", "x")] and [tuple(r) for r in bad.collect()] == [("c.json", "unreadable")]
    _, bad = files.layouts(spark, str(tmp_path), limit=10)
    assert sorted(r["name"] for r in bad.where("reason = 'too large'").collect()) == ["a.json", "b.json"]
    assert [r["length"] for r in files.documents(spark, str(tmp_path)).collect()] == [3]
    urls = spark.createDataFrame([("https://h.example.com/c/f/a%20b.pdf?sig=1",)], "u string")
    assert tuple(urls.select(files.split_url(F.col("u")).alias("s")).first()["s"]) == ("h.example.com", "c", "f/a b.pdf")
    assert urls.select(files.cache_url(F.col("u"), "crop.json", F.lit("fig_1")).alias("c")).first()["c"] == "https://h.example.com/c/_dicache/f/a%20b.pdf.fig_1.crop.json"
    xml = spark.createDataFrame([("<Blobs><Blob><Name>a.pdf</Name><Last-Modified>Tue, 02 Jan 2024 03:04:05 GMT</Last-Modified><Content-Length>7</Content-Length></Blob></Blobs>",)], "value string")
    assert [(r["name"], str(r["last_modified"]), r["length"]) for r in files.listing_from_xml(xml).collect()] == [("a.pdf", "2024-01-02 03:04:05", 7)]


def test_records(spark, tmp_path):
    rows = [("1", "text", "c1", 1), ("1", "text", "c2", 2), ("2", "table", "c3", 1)]
    df = spark.createDataFrame(rows, "id string, record_type string, chunk_id string, last_indexed_at int")
    files.write_records(df, str(tmp_path / "index"))
    files.delete_records(spark, str(tmp_path / "index"), spark.createDataFrame([("2",)], "id string"), str(tmp_path / "next"))
    assert [(r["id"], r["chunk_id"]) for r in spark.read.parquet(str(tmp_path / "next")).collect()] == [("1", "c2")]
    assert "record_type" in schemas.fields_that_can("facetable") and schemas.unknown_fields(["id", "nope"]) == {"nope"}
    assert set(schemas.RECORD_TYPES.values()) <= set(schemas.RECORD.fieldNames())


def test_incremental_state(spark, tmp_path):
    source, state = str(tmp_path / "in"), incremental.StateTable(spark, str(tmp_path / "state"), "name", ["at"])
    put = lambda rows: spark.createDataFrame(rows, "name string, at int, status string").coalesce(1).write.mode("append").parquet(source)
    schema = spark.createDataFrame([], "name string, at int, status string").schema
    put([("a", 1, "new"), ("b", 1, "new")])
    incremental.run(incremental.read_new(spark, source, schema), str(tmp_path / "cp"), state).awaitTermination()
    put([("a", 2, "done"), ("c", 1, "new")])
    incremental.run(incremental.read_new(spark, source, schema), str(tmp_path / "cp"), state).awaitTermination()
    want = [("a", "done"), ("b", "new"), ("c", "new")]
    assert sorted((r["name"], r["status"]) for r in state.read().collect()) == want
    state(spark.createDataFrame([("a", 2, "done"), ("c", 1, "new")], "name string, at int, status string"), 1)
    assert sorted((r["name"], r["status"]) for r in state.read().collect()) == want, "a batch that runs again does no harm"
    blobs = spark.createDataFrame([("a", 1), ("b", 5)], "name string, last_modified int")
    assert [r["name"] for r in incremental.changed_since(blobs, spark.createDataFrame([(1,)], "high int")).collect()] == ["b"]
    assert [r["name"] for r in incremental.deleted(blobs, blobs.where("name = 'b'")).collect()] == ["a"]
    assert sorted(r["name"] for r in incremental.todo(blobs, blobs.where("name = 'b'"), blobs.where("name = 'b'")).collect()) == ["a", "b"]
    events = spark.readStream.schema("ts timestamp, k string").parquet(source)
    assert incremental.windowed_counts(events, "ts", "k", "5 minutes", "1 minute").isStreaming


def test_every_query_is_registered():
    import __spark_entry__

    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 60


def test_layout(spark):
    from paperloom.operators import layout
    from paperloom.schemas import LAYOUT_DDL

    poly = [1.0, 1.0, 3.0, 1.0, 3.0, 2.0, 1.0, 2.0]
    data = {
        "doc": "d",
        "pages": [{"pageNumber": 1, "width": 816.0, "height": 1056.0, "unit": "pixel", "words": [{"confidence": 0.95}, {"confidence": 0.62}]}, {"pageNumber": 2, "words": None}],
        "paragraphs": [_p("Rev 5.02", 1, "", poly), _p("Document No. MX-1", 2), _p("March 26, 2024", 2), _p("Rev 9", 50), _p("- 5-7 -", 2, "pageFooter"), _p("refers", 2, "pageNumber"), {"content": "nowhere"}],
        "figures": [{"id": None, "caption": {"content": " Cap "}, "boundingRegions": [{"pageNumber": 1}, {"pageNumber": 2, "polygon": poly}]}, {"id": "x", "boundingRegions": [{"pageNumber": 1, "polygon": [1.0]}]}],
    }
    df = spark.createDataFrame([data], f"doc string, {LAYOUT_DDL}")
    assert [tuple(r)[:4] + (r["caption"],) for r in layout.figures(df).collect()] == [("d", 0, "fig_0", 2, "Cap")]
    ps = layout.paragraphs(df)
    assert [r["x_in"] for r in ps.orderBy("pos").collect()][:2] == [1.0, None]
    assert tuple(layout.cover_metadata(ps).first()) == ("d", "5.02", "MX-1", "2024-03-26")
    assert [tuple(r) for r in layout.furniture_labels(ps).collect()] == [("d", 2, "5-7")]
    assert [tuple(r) for r in layout.page_sizes(df).collect()] == [("d", 1, 8.5, 11.0), ("d", 2, 8.5, 11.0)]
    assert [tuple(r) for r in layout.least_confidence(df).collect()] == [("d", 1, 0.62), ("d", 2, None)] and layout.total_pages(df).first()[1] == 2
    box = df.select(layout.whole_page_box(F.lit(3), F.lit(None).cast("double"), F.lit(11.0)).alias("b")).first()["b"]
    assert [tuple(b) for b in box] == [(3, 0.0, 0.0, 8.5, 11.0)]
    hints = dict.fromkeys(("schematic_wiring", "nameplate", "block_flow", "parts_exploded", "default"), "look") | {"nameplate": "read the plate"}
    prompt = df.select(layout.vision_prompt(F.lit("m.pdf"), F.lit(""), F.lit(4), F.lit("Rating plate"), F.lit('see Figure 4-2 "x"'), hints).alias("p")).first()["p"]
    assert "Section: (none)" in prompt and "Mentioned as: Figure 4-2" in prompt and "Hint: read the plate" in prompt and "'x'" in prompt


def test_healing(spark):
    left = [3, 1, 1]
    runs = []
    n = upkeep.heal(lambda: spark.range(left[min(len(runs), 2)]), lambda df: runs.append(df.count()), 5)
    assert n == 1 and runs == [3, 1]

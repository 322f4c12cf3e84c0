"""Boxes against brute force, crops, lookups across documents, counters, and an index that records are put into."""

from pyspark.sql import functions as F

from paperloom.operators import figures, layout, pages, records, search, upkeep
from paperloom.sources import files


def test_chunk_boxes_against_brute_force(spark):
    words = "alpha beta gamma delta the of relay bus".split()
    texts = [" ".join(words[(i * k + k) % 8] for k in range(1, 4 + i % 40)) for i in range(60)] + ["x" * 50, "y" * 130 + " end", "a" * 45 + " b c", ""]
    paras = [(i % 2, t, len(t), 1 + i % 3, float(i), 0.0, 1.0, 1.0) for i, t in enumerate(texts)]
    chunks = [(n, n % 2, f"s{texts[n]} {texts[(n * 7 + 2) % 60]} {'x' * 60}z {'a' * 45} b cd") for n in range(40)] + [(100, 0, ""), (101, 1, "two words")]
    ps = spark.createDataFrame(paras, "doc int, normal string, raw_length int, page int, x_in double, y_in double, w_in double, h_in double")
    cs = spark.createDataFrame(chunks, "key int, doc int, normal string")
    want = sorted((k, p[3], p[4]) for k, d, c in chunks for p in paras if p[0] == d and p[2] >= 40 and p[1][:120] in c and (len(p[1]) < 200 or p[1][100:200] in c))
    assert sorted((r["key"], r["page"], r["x_in"]) for r in pages.chunk_boxes(cs, ps).collect()) == want and len(want) > 50


def test_crops_and_late_pictures(spark):
    df = spark.createDataFrame([([1.0, 1.0, 3.0, 1.0, 3.0, 2.0, 1.0, 2.0],), ([8.0, 10.5, 9.0, 10.5, 9.0, 12.0],), ([9.0, 1.0, 9.5, 2.0],), (None,)], "p array<double>")
    got = [r["b"] and tuple(r["b"]) for r in df.select(layout.crop_box(F.col("p"), F.lit(8.5), F.lit(11.0)).alias("b")).collect()]
    assert got == [(0.95, 0.95, 2.1, 1.1), (7.95, 10.45, 0.55, 0.55), None, None]


def test_lookups_and_counters(spark):
    figs = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, None), (4, "")], "pos int, image_phash string")
    old = spark.createDataFrame([("p1", "diagram", "ok", 1, "a", "schematic"), ("p1", "diagram", "ok", 2, "b", "schematic"), ("p2", "diagram", "failed", 1, "c", "x"), ("", "diagram", "ok", 1, "d", "x")], "image_phash string, record_type string, status string, seen int, description string, category string")
    hits = lambda across: {r["pos"]: r["description"] for r in figures.phash_lookup(figs, old, across).collect() if r["phash_hit"]}
    assert hits(False) == {} and hits(True) == {1: "b"}
    missed = spark.createDataFrame([("d", p, 2) for p in range(1, 61)] + [("d", 60, 1)], "doc string, page int, image_count int")
    r = figures.missed_images(missed).first()
    assert (r["missed_image_pages"], r["missed_image_count"], r["missed_pages"]) == (60, 121, list(range(1, 51)))
    out = spark.createDataFrame([(1, "ok a"), (1, "OK but FAIL"), (1, "skip"), (1, None)], "run int, result string")
    assert tuple(upkeep.run_counters(out, ["run"]).first()) == (1, 1, 1, 1)
    names = spark.createDataFrame([("a",), ("a",), ("b",)], "name string")
    assert sorted(map(tuple, upkeep.requested(names.where("name = 'a'"), names).collect())) == [("a", True), ("b", False)]
    assert records.mapped_fields(spark.createDataFrame([("x", "y")], "metadata_doctype string, id string")).columns == ["doctype", "id"]


def test_upsert_and_quality_of_equal_hits(spark, tmp_path):
    put = lambda rows: spark.createDataFrame(rows, "id string, record_type string, chunk_id string, last_indexed_at int")
    files.write_records(put([("1", "text", "c1", 1), ("2", "table", "c2", 1)]), str(tmp_path / "a"))
    fresh = put([("1", "text", "c9", 2), ("3", "text", "c3", 2)])
    files.upsert_records(spark, str(tmp_path / "a"), fresh, str(tmp_path / "b"))
    files.upsert_records(spark, str(tmp_path / "b"), fresh, str(tmp_path / "c"))
    for step in "bc":
        assert sorted((r["id"], r["chunk_id"]) for r in spark.read.parquet(str(tmp_path / step)).collect()) == [("1", "c9"), ("2", "c2"), ("3", "c3")]
    docs = spark.createDataFrame([(1, "a fuse", 0.2), (2, "a fuse", 0.9), (3, "none", 1.0)], "id int, chunk string, chunk_quality_score double")
    hits, _ = search.search(docs, search.SearchRequest(search="fuse"))
    assert [r["id"] for r in hits.collect()] == [2, 1] and search.count(search.matching(docs, "id gt 1")).first()["count"] == 2

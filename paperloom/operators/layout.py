"""What is read from layouts: figures, paragraphs by page, page sizes, cover metadata, page furniture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text
from paperloom.operators.figures import first_sound_region
from paperloom.operators.pages import box_of
from paperloom.operators.sections import FURNITURE, ORPHAN_LENGTH

SUPPLEMENT = 1_000_000


def figures(layouts: DataFrame, supplement: DataFrame | None = None) -> DataFrame:
    """(doc, pos, figure_id, page, polygon, caption): a row for each figure of layouts (doc, figures) that has a page and a polygon in
    one region; pictures found besides (doc, figure_id, page, polygon, caption) come after them, by page and id."""
    each = layouts.select("doc", F.posexplode("figures").alias("pos", "f"))
    region = first_sound_region(F.col("f.boundingRegions"))
    out = each.select("doc", "pos", F.coalesce(F.nullif("f.id", F.lit("")), F.concat(F.lit("fig_"), F.col("pos").cast("string"))).alias("figure_id"), region["pageNumber"].alias("page"), region["polygon"].alias("polygon"), text.strip(F.coalesce("f.caption.content", F.lit(""))).alias("caption")).where("page IS NOT NULL")
    if supplement is not None:
        out = out.unionByName(supplement.withColumn("pos", F.lit(SUPPLEMENT - 1) + F.row_number().over(Window.partitionBy("doc").orderBy("page", "figure_id"))))
    return out


def paragraphs(layouts: DataFrame) -> DataFrame:
    """(doc, pos, role, content, page, x_in, y_in, w_in, h_in, normal, raw_length): paragraphs on the first page that they name."""
    each = layouts.select("doc", F.posexplode("paragraphs").alias("pos", "p"))
    region = F.get(F.filter("p.boundingRegions", lambda r: r["pageNumber"] > 0), F.lit(0))
    rows = each.select("doc", "pos", F.lower(F.coalesce("p.role", F.lit(""))).alias("role"), text.strip(F.coalesce("p.content", F.lit(""))).alias("content"), region["pageNumber"].alias("page"), box_of(region["polygon"]).alias("box"))
    return rows.select("doc", "pos", "role", "content", "page", "box.*", text.normalize_text(F.col("content")).alias("normal"), F.length("content").alias("raw_length"))


def page_sizes(layouts: DataFrame) -> DataFrame:
    """(doc, page, w_in, h_in): sizes in inches; 8.5 by 11 where they lack."""
    each = layouts.select("doc", F.posexplode("pages").alias("pos", "p"))
    unit = F.lower(F.coalesce("p.unit", F.lit("inch")))
    per_inch = F.when(unit.isin("pixel", "pixels"), 96.0).when(unit.isin("centimeter", "cm"), 2.54).otherwise(1.0)
    known = F.col("p.width").isNotNull() & F.col("p.height").isNotNull()
    return each.select("doc", (F.col("pos") + 1).alias("page"), F.when(known, F.col("p.width") / per_inch).otherwise(8.5).alias("w_in"), F.when(known, F.col("p.height") / per_inch).otherwise(11.0).alias("h_in"))


def whole_page_box(page: Column, w_in: Column, h_in: Column) -> Column:
    """A list with one box that covers a page, for a chunk that no paragraph was found for; empty without a page."""
    box = F.struct(page.cast("int").alias("page"), F.lit(0.0).alias("x_in"), F.lit(0.0).alias("y_in"), F.round(F.coalesce(w_in, F.lit(8.5)), 3).alias("w_in"), F.round(F.coalesce(h_in, F.lit(11.0)), 3).alias("h_in"))
    return F.when(page.isNotNull(), F.array(box)).otherwise(F.array().cast("array<struct<page:int,x_in:double,y_in:double,w_in:double,h_in:double>>"))


def crop_box(polygon: Column, w_in: Column, h_in: Column, pad: float = 0.05) -> Column:
    """struct<x_in, y_in, w_in, h_in>: what is cut out for a figure, with a margin and within the page, to 4 digits; null where nothing is left."""
    b = box_of(polygon)
    x0, y0 = F.greatest(b["x_in"] - pad, F.lit(0.0)), F.greatest(b["y_in"] - pad, F.lit(0.0))
    x1, y1 = F.least(b["x_in"] + b["w_in"] + pad, w_in), F.least(b["y_in"] + b["h_in"] + pad, h_in)
    return F.when(b.isNotNull() & (x1 > x0) & (y1 > y0), F.struct(F.round(x0, 4).alias("x_in"), F.round(y0, 4).alias("y_in"), F.round(x1 - x0, 4).alias("w_in"), F.round(y1 - y0, 4).alias("h_in")))


def _each_page(spans: DataFrame) -> DataFrame:
    return spans.select("key", "doc", F.explode(F.sequence("first_page", "last_page")).alias("page"))


def span_confidence(spans: DataFrame, words: DataFrame) -> DataFrame:
    """(key, ocr_min_confidence): the least confidence of words (doc, page, confidence) on the pages of spans (key, doc, first_page, last_page)."""
    least = words.groupBy("doc", "page").agg(F.min("confidence").alias("c"))
    return _each_page(spans).join(least, ["doc", "page"], "left").groupBy("key").agg(F.round(F.min("c"), 4).alias("ocr_min_confidence"))


def footnotes(spans: DataFrame, paras: DataFrame) -> DataFrame:
    """(key, footnotes): what stands in footnotes (doc, page, pos, role, content) on the pages of spans, by page and position, up to
    500 characters of each."""
    notes = paras.where("lower(role) = 'footnote' AND content <> ''").select("doc", "page", F.struct("page", "pos", F.substring("content", 1, 500).alias("content")).alias("n"))
    return _each_page(spans).join(notes, ["doc", "page"], "left").groupBy("key").agg(F.transform(F.array_sort(F.collect_list("n")), lambda n: n["content"]).alias("footnotes"))


def orphan_paragraphs(paras: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc, page, content, paragraphs): by page, the paragraphs (doc, page, pos, referenced, role, content) that no section refers to,
    that are no furniture, long enough, and on a page that no section (doc, page_start, page_end) covers."""
    covered = sections.select("doc", F.explode(F.sequence("page_start", "page_end")).alias("page"))
    stray = paras.where(~F.col("referenced") & ~F.lower(F.coalesce("role", F.lit(""))).isin(*sorted(FURNITURE)) & (F.length("content") >= ORPHAN_LENGTH)).join(covered, ["doc", "page"], "left_anti")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda x: x["content"])
    return stray.groupBy("doc", "page").agg(F.array_join(ordered, "\n").alias("content"), F.count(F.lit(1)).alias("paragraphs"))


def total_pages(layouts: DataFrame) -> DataFrame:
    return layouts.select("doc", F.nullif(F.size("pages"), F.lit(0)).alias("pdf_total_pages"))


def least_confidence(layouts: DataFrame) -> DataFrame:
    """(doc, page, confidence): the least of a page's words, rounded to 4 digits; null without words."""
    each = layouts.select("doc", F.explode("pages").alias("p"))
    return each.select("doc", F.col("p.pageNumber").alias("page"), F.round(F.array_min(F.transform("p.words", lambda w: w["confidence"])), 4).alias("confidence"))


def cover_metadata(paras: DataFrame) -> DataFrame:
    """(doc, document_revision, document_number, effective_date): the first of each on pages 1 to 3, by position; '' for none."""
    c = F.col("content")
    found = paras.where("page BETWEEN 1 AND 3").select("doc", "pos", text.revision(c).alias("r"), text.document_number(c).alias("n"), text.parse_date(c).alias("d"))
    value = lambda name: F.coalesce(F.min_by(F.nullif(name, F.lit("")), F.when(F.col(name) != "", F.col("pos"))), F.lit(""))
    return found.groupBy("doc").agg(value("r").alias("document_revision"), value("n").alias("document_number"), value("d").alias("effective_date"))


def furniture_labels(paras: DataFrame) -> DataFrame:
    """(doc, page, label): a page's printed label from paragraphs that hold page numbers, or else headers and footers."""
    number = F.when((F.col("role") == "pagenumber") & text.is_valid_label(F.col("content")), F.col("content"))
    other = F.when(F.col("role").isin("pagefooter", "pageheader"), text.printed_label(F.col("content")))
    rows = paras.where("page > 0 AND role IN ('pagenumber', 'pagefooter', 'pageheader')").select("doc", "page", "pos", number.alias("number"), other.alias("other"))
    pick = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("pos")))
    return rows.groupBy("doc", "page").agg(F.coalesce(pick("number"), pick("other")).alias("label")).where("label IS NOT NULL")


def vision_prompt(source: Column, headers: Column, page: Column, caption: Column, around: Column, hints: dict[str, str]) -> Column:
    """What a model is told of a figure: where it stands, what refers to it, and a hint by the category that its words suggest."""
    hint = F.element_at(F.create_map(*[F.lit(x) for kv in hints.items() for x in kv]), text.guess_category(caption, around))
    or_none = lambda c: F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("(none)"))
    parts = (("Manual", source), ("Section", headers), ("Page", page), ("Caption", caption), ("Mentioned as", F.array_join(text.figure_refs(around), ", ")), ("Around it", F.replace(F.substring(around, 1, 1500), F.lit('"'), F.lit("'"))), ("Hint", hint))
    return F.concat_ws("\n", *[F.concat(F.lit(f"{name}: "), or_none(c)) for name, c in parts])

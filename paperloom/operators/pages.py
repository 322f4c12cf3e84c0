"""Pages of sections and chunks: interval lookups, as-of lookups, bounding boxes, the ladder that settles a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BOX = [f"{side}_in" for side in "xywh"]
#: Words that chunks and paragraphs are joined on.
GRAM = 3
#: Paragraphs of a document up to which each of its chunks is compared with all of them.
FEW = 64


def _spread(sections: DataFrame) -> DataFrame:
    """A row for each page of each section: an interval join becomes one on equal keys."""
    rank = F.struct(F.coalesce("is_orphan", F.lit(False)).cast("int").alias("orphan"), (F.col("page_end") - F.col("page_start")).alias("span"), (-F.col("section_idx")).alias("turned"))
    return sections.where("page_start <= page_end").select("doc", "section_idx", "page_start", "page_end", rank.alias("rank"), F.explode(F.sequence("page_start", "page_end")).alias("page"))


def section_for_page(entities: DataFrame, sections: DataFrame) -> DataFrame:
    """Entities (doc, page, ...) with the tightest section over their page; real ones before orphans, then the larger index."""
    best = _spread(sections).groupBy("doc", "page").agg(F.min_by("section_idx", "rank").alias("section_idx"))
    return entities.join(best, ["doc", "page"], "left")


def section_for_range(entities: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """Entities (key, doc, page, page_to) with the section that holds their range: the tightest that holds all of it, else the
    real one with most of its pages, the smaller index where equal. Ranges of one page go by their page. Rows of one key share what is best for any of them.

    Ranges that occur often are settled once, and of sections with the same pages only the least and the largest index can win.
    A range and a section that meet do so where the later of them begins, so each pair is met once, and folded where it is met."""
    to = F.greatest(F.coalesce("page_to", "page"), F.col("page"))
    spans = entities.select("doc", "page", to.alias("__to")).where("doc IS NOT NULL AND page IS NOT NULL").distinct()
    kinds = sections.where("page_start <= page_end").groupBy("doc", "page_start", "page_end", F.coalesce("is_orphan", F.lit(False)).cast("int").alias("orphan")).agg(F.min("section_idx").alias("least"), F.max("section_idx").alias("most"))
    over = spans.join(kinds.select("*", F.explode(F.sequence("page_start", "page_end")).alias("page")), ["doc", "page"])
    later = spans.where("page < __to").select("*", F.explode(F.sequence(F.col("page") + 1, F.col("__to"))).alias("page_start")).join(kinds, ["doc", "page_start"])
    met = F.least("page_end", "__to") - F.greatest("page", "page_start") + 1
    rank = lambda tier, b, c, index: F.struct(F.lit(tier).alias("tier"), F.col("orphan").alias("a"), b.cast("bigint").alias("b"), c.cast("bigint").alias("c"), F.col(index).alias("section_idx"))
    tight = rank(0, F.col("page_end") - F.col("page_start"), -F.col("most"), "most")
    best = over.unionByName(later).groupBy("doc", "page", "__to").agg(F.min(F.when(met == F.col("__to") - F.col("page") + 1, tight).otherwise(rank(1, -met, F.col("least"), "least"))).alias("__best"))
    found = entities.withColumn("__to", to).join(best, ["doc", "page", "__to"], "left")
    return found.select(*[F.col(f"`{c}`") for c in entities.columns], F.when(F.col(key).isNotNull(), F.min("__best").over(Window.partitionBy(key))["section_idx"]).alias("section_idx"))


def as_of(probes: DataFrame, events: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Probes with the value of the last event at or before them, per key: one sort of both, and no join."""
    both = events.select(*keys, order, value, F.lit(0).alias("__probe")).unionByName(probes.select(*keys, order, F.lit(1).alias("__probe"), F.struct(*probes.columns).alias("__row")), allowMissingColumns=True)
    upto = Window.partitionBy(*keys).orderBy(order, "__probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("__last", F.last(value, ignorenulls=True).over(upto)).where("__probe = 1").select("__row.*", F.col("__last").alias(value))


def box_of(polygon: Column) -> Column:
    """The box round a polygon of x and y in turn; null for fewer than four numbers."""
    at = lambda odd: F.filter(polygon, lambda _, i: i % 2 == odd)
    x, y = at(0), at(1)
    return F.when(F.size(polygon) >= 4, F.struct(F.array_min(x).alias("x_in"), F.array_min(y).alias("y_in"), (F.array_max(x) - F.array_min(x)).alias("w_in"), (F.array_max(y) - F.array_min(y)).alias("h_in")))


def union_boxes(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """The box round all boxes (x_in, y_in, w_in, h_in) of a page, per key and page, rounded to 3 digits."""
    r = lambda c: F.round(c, 3)
    edge = boxes.groupBy(*keys, "page").agg(F.min("x_in").alias("x0"), F.min("y_in").alias("y0"), F.max(F.col("x_in") + F.col("w_in")).alias("x1"), F.max(F.col("y_in") + F.col("h_in")).alias("y1"))
    return edge.select(*keys, "page", r(F.col("x0")).alias("x_in"), r(F.col("y0")).alias("y_in"), r(F.col("x1") - F.col("x0")).alias("w_in"), r(F.col("y1") - F.col("y0")).alias("h_in"))


def primary_page(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: the page with the largest area, the lower one of equals, the last page and all pages."""
    area = boxes.groupBy(*keys, "page").agg(F.sum(F.col("w_in") * F.col("h_in")).alias("area"))
    return area.groupBy(*keys).agg(F.max_by("page", F.struct("area", -F.col("page"))).alias("primary_page"), F.max("page").alias("last_page"), F.array_sort(F.collect_set("page")).alias("pages"))


def resolve_pages(df: DataFrame) -> DataFrame:
    """Adds first_page, last_page, pages and page_resolution_method to rows of: di_page, header_page, fuzzy_page, bbox_primary,
    bbox_last, bbox_pages, marker_page, and span (first, last, pages) computed from the page settled first."""
    known = F.coalesce("di_page", "header_page", "fuzzy_page")
    has_box = F.size("bbox_pages") > 0
    method = (
        F.when(known.isNotNull() & has_box & ~F.array_contains("bbox_pages", F.col("span.first")), "bbox_corrected")
        .when(F.col("di_page").isNotNull(), "di_input")
        .when(F.col("header_page").isNotNull(), "header_match")
        .when(F.col("fuzzy_page").isNotNull(), "fuzzy_match")
        .when(has_box, "paragraph_bbox")
        .when(F.col("marker_page").isNotNull(), "marker_inline")
        .otherwise("missing")
    )
    pick = lambda span, box, fixed, inline: F.when(F.col("m") == "bbox_corrected", fixed).when(F.col("m") == "paragraph_bbox", box).when(F.col("m") == "marker_inline", inline).when(F.col("m") != "missing", span)
    rows = df.withColumn("m", method)
    primary, marker = F.col("bbox_primary"), F.col("marker_page")
    return rows.select(
        *df.columns,
        pick(F.col("span.first"), primary, primary, marker).alias("first_page"),
        pick(F.col("span.last"), F.col("bbox_last"), primary, marker).alias("last_page"),
        F.coalesce(pick(F.col("span.pages"), F.col("bbox_pages"), F.array(primary), F.array(marker)), F.array().cast("array<int>")).alias("pages"),
        F.col("m").alias("page_resolution_method"),
    )


def header_pages(chunks: DataFrame, sections: DataFrame) -> DataFrame:
    """Adds header_page to chunks (doc, header_1..3): the first page, in document order, of a section whose three headers
    match, else two, else one. Compared after blanks are brought together; each tier is aggregated before its join."""
    norm = lambda c: F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "(?U)\\s+", " "))
    heads = ["header_1", "header_2", "header_3"]
    out = chunks.select("*", *[norm(h).alias(f"__{h}") for h in heads])
    base = sections.where("page_start IS NOT NULL").select("doc", "section_idx", "page_start", *[norm(h).alias(f"__{h}") for h in heads])
    for n in (3, 2, 1):
        on = ["doc", *[f"__{h}" for h in heads[:n]]]
        tier = base.groupBy(*on).agg(F.min_by("page_start", "section_idx").alias(f"__t{n}"))
        out = out.join(tier, on, "left")
    some = F.col("__header_1") != ""
    return out.select(*chunks.columns, F.when(some, F.coalesce("__t3", "__t2", "__t1")).alias("header_page"))


def fuzzy_pages(chunks: DataFrame, sections: DataFrame, cap: int = 100) -> DataFrame:
    """Adds fuzzy_page to chunks (key, doc, normal: a normalised section content's first 400 characters): of a document's
    first ``cap`` sections, the first that holds the first 200 characters ends the search; before it, those whose own first
    200 characters the chunk holds count, the longest overlap winning, the earlier of equals."""
    order = Window.partitionBy("doc").orderBy("section_idx")
    near = sections.withColumn("__pos", F.row_number().over(order)).where((F.col("__pos") <= cap) & F.col("page_start").isNotNull())
    pairs = chunks.select("key", "doc", "normal").where("normal <> ''").join(near.select("doc", "__pos", "page_start", F.col("normal").alias("other")).where("other <> ''"), "doc")
    ends = F.contains("other", F.substring("normal", 1, 200))
    held = F.contains("normal", F.substring("other", 1, 200))
    pairs = pairs.select("key", "__pos", "page_start", ends.alias("ends"), F.least(F.length("other"), F.length("normal")).alias("n")).where(ends | held)
    stop = pairs.withColumn("__stop", F.min(F.when(F.col("ends"), F.col("__pos"))).over(Window.partitionBy("key"))).where(F.col("__stop").isNull() | (F.col("__pos") <= F.col("__stop")))
    best = stop.groupBy("key").agg(F.max_by("page_start", F.struct("n", -F.col("__pos"))).alias("fuzzy_page"))
    return chunks.join(best, "key", "left")


def chunk_boxes(chunks: DataFrame, paragraphs: DataFrame, few: int = FEW) -> DataFrame:
    """Boxes (key, page, x_in, y_in, w_in, h_in) of the paragraphs (doc, normal, raw_length, page, box) that chunks (key, doc, normal; a
    key once) hold: of 40 characters or more, by their first 120, and from 200 characters on by those from 101 to 200, too.

    Documents of up to ``few`` paragraphs are joined as they are, so a chunk meets no more than these. In others, what holds a
    paragraph's beginning holds its words from the second on as whole words: the first ``GRAM`` of them are what both are joined on. Only
    beginnings of fewer words are compared with all chunks of their document. Texts may be far larger than the planner takes them
    to be, so nothing is broadcast."""
    p = paragraphs.where("doc IS NOT NULL AND raw_length >= 40 AND length(normal) >= 40 AND page > 0 AND x_in IS NOT NULL").select("doc", F.substring("normal", 1, 200).alias("head"), "page", *BOX)
    p = p.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("doc")))
    c = chunks.where("doc IS NOT NULL").select("key", "doc", F.col("normal").alias("chunk"))
    light, heavy = p.where(F.col("__n") <= few).drop("__n"), p.where(F.col("__n") > few).drop("__n")
    near = c.join(light.hint("merge"), "doc")
    rest = c.join(heavy.select("doc").distinct().hint("merge"), "doc", "left_semi")
    heavy = heavy.withColumn("__w", F.split(F.substring("head", 1, 120), " ")).withColumn("gram", F.when(F.size("__w") >= GRAM + 2, F.xxhash64(F.array_join(F.slice("__w", F.lit(2), F.lit(GRAM)), " ")))).drop("__w")
    words = rest.select("key", "doc", F.split("chunk", " ").alias("w")).where(F.size("w") >= GRAM)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (GRAM - 1)), lambda i: F.xxhash64(F.array_join(F.slice("w", i, F.lit(GRAM)), " ")))
    met = words.select("key", "doc", F.explode(F.array_distinct(grams)).alias("gram")).join(heavy.where("gram IS NOT NULL").hint("merge"), ["doc", "gram"]).drop("gram").join(rest.hint("merge"), ["key", "doc"])
    short = rest.join(heavy.where("gram IS NULL").drop("gram").hint("merge"), "doc")
    hit = F.contains("chunk", F.substring("head", 1, 120)) & ((F.length("head") < 200) | F.contains("chunk", F.substring("head", 101, 100)))
    return near.unionByName(met).unionByName(short).where(hit).select("key", "page", *BOX)

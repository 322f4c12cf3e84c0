"""Figures: triage, duplicates, the ladder of a figure's status, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

USEFUL = ("block_diagram", "circuit_diagram", "control_logic", "equipment_photo", "exploded_view", "flow_diagram", "line_diagram", "nameplate", "parts_list_diagram", "pid_diagram", "schematic", "wiring_diagram")
CATEGORIES = (*USEFUL, "decorative", "table_image", "unknown")
MIN_INCHES, MAX_ASPECT, MIN_BYTES = 1.0, 8.0, 10_000


def triage(w_in: Column, h_in: Column, n_bytes: Column) -> Column:
    """Why a figure is left out: 'tiny', 'aspect' or 'small'; null where it passes. An unknown size in bytes passes."""
    long, short = F.greatest(w_in, h_in), F.least(w_in, h_in)
    return F.when(short < MIN_INCHES, "tiny").when(long > short * MAX_ASPECT, "aspect").when(n_bytes < MIN_BYTES, "small")


def first_sound_region(regions: Column) -> Column:
    """Of array<struct<pageNumber, polygon>>: the first with both a page and a polygon."""
    return F.get(F.filter(regions, lambda r: r["pageNumber"].isNotNull() & (F.size(r["polygon"]) >= 4)), F.lit(0))


def category(value: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin(*CATEGORIES), v).otherwise("unknown")


def has_diagram(useful: Column, cat: Column, description: Column) -> Column:
    return F.coalesce(useful, F.lit(False)) & cat.isin(*USEFUL) & (F.coalesce(description, F.lit("")) != "")


def status_ladder(df: DataFrame) -> DataFrame:
    """Adds processing_status to figures with n_bytes (null: no image), precomputed, hash_hit, phash_hit, error, useful, category,
    description. What comes first settles it; only rows of status null need the model."""
    useful = F.coalesce("useful", F.lit(False)) & F.col("category").isin(*USEFUL)
    described = F.coalesce("description", F.lit("")) != ""
    done = F.when(useful & described, "ok").when(useful, "vision_empty").when(F.col("category").isNotNull(), "skipped_decorative")
    status = (
        F.when(F.col("n_bytes").isNull(), "no_image")
        .when(F.col("n_bytes") < MIN_BYTES, "skipped_tiny")
        .when(F.col("precomputed"), "precomputed")
        .when(F.col("hash_hit"), "cache_hit")
        .when(F.col("phash_hit"), "cache_hit_phash")
        .when(F.col("error").isNotNull(), F.concat(F.lit("vision_error:"), "error"))
        .otherwise(done)
    )
    return df.withColumn("processing_status", status)


def dedup_crops(crops: DataFrame) -> DataFrame:
    """Of equal pictures (doc, sha) of a document, the first by pos."""
    order = Window.partitionBy("doc", "sha").orderBy("pos")
    return crops.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def cache_lookup(figures: DataFrame, history: DataFrame, on: list[str], statuses: tuple[str, ...] = ("ok",)) -> DataFrame:
    """Figures with the description of an earlier record of the same picture: the latest of those with one of the statuses."""
    known = history.where(F.col("status").isin(*statuses)).groupBy(*on).agg(F.max_by(F.struct("description", "category"), F.struct("seen", "description")).alias("hit"))
    return figures.join(known, on, "left").select(*figures.columns, F.col("hit").isNotNull().alias("hash_hit"), "hit.description", "hit.category")


def phash_lookup(figures: DataFrame, history: DataFrame, across: bool = False) -> DataFrame:
    """Figures (image_phash, ...) with phash_hit and the description of an earlier diagram of any document that looks the same. Off by
    default: the description comes from another document, where the picture may mean something else."""
    known = history.where(F.lit(across) & (F.col("record_type") == "diagram") & F.col("image_phash").rlike("^[A-Za-z0-9_-]+$"))
    return cache_lookup(figures, known, ["image_phash"]).withColumnRenamed("hash_hit", "phash_hit")


def missed_images(pages: DataFrame, most: int = 50) -> DataFrame:
    """(doc, missed_image_pages, missed_image_count, missed_pages) of pages with pictures that the layout has missed (doc, page,
    image_count): counts of all, and a list of the first ``most`` pages."""
    each = pages.groupBy("doc", "page").agg(F.sum("image_count").alias("n"))
    return each.groupBy("doc").agg(F.count(F.lit(1)).alias("missed_image_pages"), F.sum("n").alias("missed_image_count"), F.slice(F.array_sort(F.collect_list("page")), 1, most).alias("missed_pages"))


def vision_coverage(figures: DataFrame) -> DataFrame:
    """Per document: counts of figures, descriptions missing and failed; above 10 % missing the document fails."""
    n = figures.groupBy("doc").agg(F.count(F.lit(1)).alias("total"), F.count_if("missing").alias("missing"), F.count_if("errored").alias("errored"))
    gate = F.when(F.col("missing") * 10 > F.col("total"), "failed").when((F.col("missing") > 0) | (F.col("errored") > 0), "partial_vision").otherwise("ok")
    return n.withColumn("status", gate)


def loss_status(total: Column, dropped: Column) -> Column:
    return F.when((total > 0) & (dropped == total), "all_figures_dropped").when(dropped >= F.greatest(F.lit(5), F.call_function("div", total, F.lit(4))), "partial_figure_loss").otherwise("ok")


def retry(attempts: Column, permanent: Column, most: int = 3) -> Column:
    """Attempts after one more failure; a permanent one uses them up."""
    return F.when(permanent, F.lit(most)).otherwise(F.least(F.coalesce(attempts, F.lit(0)) + 1, F.lit(most)))


def supplement(pages: DataFrame, figures: DataFrame) -> DataFrame:
    """Pages (doc, page) on which the layout found no figure: where an extractor of pictures looks."""
    return pages.join(figures.select("doc", "page").distinct(), ["doc", "page"], "left_anti")


def centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """(label, centroid): the mean of each class, by dimension."""
    means = vectors.select(label, F.posexplode(vector).alias("i", "x")).groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def nearest_class(vectors: DataFrame, means: DataFrame, key: str, label: str = "label", vector: str = "embedding") -> DataFrame:
    """(key, label, confidence): the class of the nearest centroid; half, and 2.5 times its lead over the next, up to 1.
    There are as many centroids as classes, whatever the number of vectors, so they are broadcast as one row."""
    all_means = means.agg(F.collect_list(F.struct(F.col(label).alias("label"), "centroid")).alias("ms"))
    scored = vectors.select(key, vector).crossJoin(F.broadcast(all_means)).select(key, F.reverse(F.array_sort(F.transform("ms", lambda m: F.struct(cosine(F.col(vector), m["centroid"]).alias("s"), m["label"].alias("label"))))).alias("r"))
    lead = F.col("r")[0]["s"] - F.coalesce(F.get("r", F.lit(1))["s"], F.lit(0.0))
    return scored.select(key, F.col("r")[0]["label"].alias("label"), F.least(F.greatest(0.5 + lead * 2.5, F.lit(0.0)), F.lit(1.0)).alias("confidence"))

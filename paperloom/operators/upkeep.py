"""Upkeep of an index: reconciling, coverage, stuck and stale documents, state and run history, contracts of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXTENSIONS = ("pdf", "docx", "pptx", "xlsx")
CACHE = "_dicache/"


def is_document(name: Column) -> Column:
    return F.lower(name).rlike(f"\\.(?:{'|'.join(EXTENSIONS)})$") & ~name.startswith(CACHE)


def needs_conversion(name: Column) -> Column:
    return F.lower(name).rlike(f"\\.(?:{'|'.join(e for e in EXTENSIONS if e != 'pdf')})$")


def cached_document(blob: Column) -> Column:
    """The document that a cache blob belongs to: its name without folder and the last parts."""
    return F.regexp_extract(blob, f"^{CACHE}(.+?\\.(?:{'|'.join(EXTENSIONS)}))\\..+$", 1)


def reconcile(blobs: DataFrame, index: DataFrame, state: DataFrame) -> DataFrame:
    """(name, change): documents (name, last_modified) against an index (name, records) and state (name, last_indexed_at)."""
    both = blobs.join(index.where("records > 0"), "name", "full_outer").join(state, "name", "left")
    here, there = F.col("last_modified").isNotNull(), F.col("records").isNotNull()
    change = F.when(here & ~there, "ADDED").when(~here, "DELETED").when(F.col("last_modified") > F.col("last_indexed_at"), "EDITED").otherwise("STABLE")
    return both.select("name", change.alias("change"))


def purges(plan: DataFrame, most: int) -> DataFrame:
    """What a plan deletes: documents deleted or edited. Raises where there are more than ``most``."""
    targets = plan.where("change IN ('DELETED', 'EDITED')")
    if (n := targets.count()) > most:
        raise ValueError(f"{n} documents would be purged; at most {most} may")
    return targets


def plan_with(kept: DataFrame, targets: DataFrame, key: str = "name") -> DataFrame:
    """(key, change): what a purge takes, and what it leaves."""
    gone = targets.select(key).distinct()
    return gone.select(key, F.lit("purge").alias("change")).unionByName(purge(kept.select(key).distinct(), gone, key).select(key, F.lit("keep").alias("change")))


def requested(blobs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, found): each document that is asked for, and whether it is there."""
    return wanted.select("name").distinct().join(blobs.select("name", F.lit(True).alias("b")).distinct(), "name", "left").select("name", F.coalesce("b", F.lit(False)).alias("found"))


def run_counters(results: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, processed, skipped, failed): how many of a run's results say so."""
    low, fail = F.lower("result"), F.contains("result", F.lit("FAIL"))
    return results.groupBy(*keys).agg(F.count_if(F.contains(low, F.lit("ok")) & ~fail).alias("processed"), F.count_if(F.contains(low, F.lit("skip"))).alias("skipped"), F.count_if(fail).alias("failed"))


def purge(records: DataFrame, targets: DataFrame, key: str = "name") -> DataFrame:
    return records.join(targets.select(key), key, "left_anti")


def coverage(blobs: DataFrame, started: DataFrame, done: DataFrame) -> DataFrame:
    """(name, state): done, in_progress, not_started; orphan where only the index has it."""
    t = blobs.select("name", F.lit(True).alias("b")).join(started.select("name", F.lit(True).alias("s")), "name", "full_outer").join(done.select("name", F.lit(True).alias("d")), "name", "left")
    state = F.when(F.col("b").isNull(), "orphan").when(F.col("d"), "done").when(F.col("s"), "in_progress").otherwise("not_started")
    return t.select("name", state.alias("state"))


def stuck(blobs: DataFrame, done: DataFrame, now: Column, minutes: int = 60, most: int | None = None) -> DataFrame:
    """Documents that aren't done and older than the threshold (at least five minutes), by name."""
    old = blobs.where(F.col("last_modified") < now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(max(5, minutes))))
    out = old.join(done.select("name"), "name", "left_anti")
    return out.orderBy("name").limit(most) if most is not None else out


def stale(records: DataFrame, version: str, now: Column, keep_days: int) -> DataFrame:
    return records.where((F.col("skill_version") != version) & (F.col("last_indexed_at") < now - F.make_dt_interval(F.lit(keep_days))))


def orphaned_cache(cache: DataFrame, blobs: DataFrame) -> DataFrame:
    named = cache.withColumn("name", cached_document(F.col("blob"))).where("name <> ''")
    return named.join(blobs.select("name"), "name", "left_anti")


def cache_counts(cache: DataFrame) -> DataFrame:
    """(name, crop, vision, output): the cache's blobs of each document by kind."""
    kind = F.regexp_extract("blob", "\\.(crop|vision|output)\\b", 1)
    named = cache.select(cached_document(F.col("blob")).alias("name"), kind.alias("kind")).where("name <> ''")
    return named.groupBy("name").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("crop", "vision", "output")])


def is_done(status: Column, has_output: Column, figures: Column, layout_figures: Column) -> Column:
    """A document is done where its output is there, and its status says so, or it has figures, or its layout has none or is gone."""
    good = status.isin("ok", "di_missed_images", "partial_vision")
    return F.coalesce(has_output, F.lit(False)) & (F.coalesce(good, F.lit(False)) | (F.coalesce(figures, F.lit(0)) > 0) | (F.coalesce(layout_figures, F.lit(0)) == 0))


def document_status(docs: DataFrame) -> DataFrame:
    """Adds state to documents with has_layout, figures, crops, visions, has_output: where each stands on its way."""
    state = (
        F.when(F.col("has_output"), "done").when(~F.col("has_layout"), "needs_layout").when((F.col("figures") > 0) & (F.col("crops") == 0), "needs_crops").when(F.col("visions") < F.col("crops"), "needs_vision").otherwise("needs_output")
    )
    return docs.withColumn("state", state)


def latest(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(key).orderBy(*[F.col(o).desc() for o in order])
    return changes.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert(state: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    return latest(state.unionByName(changes, allowMissingColumns=True), key, order)


def run_records(runs: DataFrame, now: Column) -> DataFrame:
    """Runs with what they may lack: their end, an id, and the partition, which is the day of their start."""
    end = F.coalesce("ended_at", now)
    return runs.withColumns({"ended_at": end, "id": F.coalesce("id", F.concat_ws("-", "run_type", F.date_format("started_at", "yyyyMMdd'T'HHmmss"))), "partitionKey": F.date_format("started_at", "yyyy-MM-dd")})


def run_health(runs: DataFrame, now: Column, last: int = 5, hours: int = 24) -> DataFrame:
    """Per indexer (name, started_at, status): whether its last runs all failed, and whether its latest has run too long."""
    w = Window.partitionBy("name").orderBy(F.col("started_at").desc(), "run")
    recent = runs.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= last)
    late = (F.col("__n") == 1) & (F.col("status") == "inProgress") & (F.col("started_at") < now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return recent.groupBy("name").agg(((F.count(F.lit(1)) >= last) & F.bool_and(F.col("status") == "failed")).alias("all_failed"), F.bool_or(late).alias("hangs"))


def contract_breaks(df: DataFrame, filled: list[str], lists: list[str] = (), json_lists: list[str] = ()) -> DataFrame:
    """Adds ``breaks``: what each record lacks of the contract: filled fields, lists, JSON lists, and first and last page in pages."""
    checks = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"{c} is empty")) for c in filled]
    checks += [F.when(F.col(c).isNull(), F.lit(f"{c} is no list")) for c in lists]
    checks += [F.when((F.coalesce(F.col(c), F.lit("")) != "") & ~F.col(c).rlike("^\\s*\\["), F.lit(f"{c} is no JSON list")) for c in json_lists]
    if {"physical_pdf_page", "physical_pdf_page_end", "physical_pdf_pages"} <= set(df.columns):
        checks += [F.when(F.col(c).isNotNull() & ~F.array_contains("physical_pdf_pages", F.col(c)), F.lit(f"{c} isn't among the pages")) for c in ("physical_pdf_page", "physical_pdf_page_end")]
    return df.withColumn("breaks", F.array_compact(F.array(*checks)))


def envelope(df: DataFrame, make, record_id: str = "recordId") -> DataFrame:
    """(recordId, data, errors): a row for each row; ``make`` gives a column and the reason why it is null, if so."""
    data, reason = make(df)
    return df.select(record_id, data.alias("data"), F.when(data.isNull(), F.array(F.struct(F.coalesce(reason, F.lit("no result")).alias("message")))).otherwise(F.array().cast("array<struct<message:string>>")).alias("errors"))


def heal(incomplete, run, most: int = 3) -> int:
    """Run again what is incomplete, up to ``most`` times or until nothing is or a pass changes nothing; the number that is left.
    ``incomplete()`` gives a DataFrame, ``run`` takes one."""
    left = None
    for _ in range(most):
        todo = incomplete()
        n = todo.count()
        if n == 0 or n == left:
            return n
        left = n
        run(todo)
    return incomplete().count()

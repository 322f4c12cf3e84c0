"""Files: listings, layouts as JSON, tables of stages, and stores of records and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.upkeep import is_document, latest, run_records
from paperloom.schemas import LAYOUT_DDL

LAYOUT_LIMIT = 50_000_000


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, last_modified, length) of all files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = folder.split("://", 1)[-1].removeprefix("file:").rstrip("/")
    return files.select(F.regexp_replace("path", f"^[a-z0-9]*:?/*{root.lstrip('/')}/", "").alias("name"), "path", F.col("modificationTime").alias("last_modified"), "length")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return listing(spark, folder).where(is_document(F.col("name")))


def listing_from_xml(df: DataFrame, column: str = "value") -> DataFrame:
    """(name, last_modified, length) from listings as XML."""
    blobs = df.select(F.explode(F.regexp_extract_all(column, F.lit("(?s)<Blob>(.*?)</Blob>"), F.lit(1))).alias("b"))
    get = lambda tag: F.regexp_extract("b", f"<{tag}>([^<]*)</{tag}>", 1)
    when = F.try_to_timestamp(F.regexp_replace(get("Last-Modified"), "^\\w+, ", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    return blobs.select(get("Name").alias("name"), when.alias("last_modified"), F.nullif(get("Content-Length"), F.lit("")).try_cast("bigint").alias("length"))


def split_url(url: Column) -> Column:
    """struct<host, container, blob> of a blob's URL; the blob's name is decoded."""
    path = F.regexp_extract(url, "^[a-z]+://[^/]+/([^?#]*)", 1)
    return F.struct(F.regexp_extract(url, "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract(path, "^([^/]*)", 1).alias("container"), F.try_url_decode(F.replace(F.regexp_extract(path, "^[^/]*/(.*)$", 1), F.lit("+"), F.lit("%2B"))).alias("blob"))


def cache_url(url: Column, suffix: str, item: Column | None = None) -> Column:
    """Where the cache of a blob lies: in _dicache beside it, with the item's id, if any, between name and suffix."""
    base = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^([a-z]+://[^/]+/[^/]+)/", "$1/_dicache/")
    return F.concat_ws(".", base, *( [item] if item is not None else []), F.lit(suffix))


def parse_layouts(raw: DataFrame, value: str = "value") -> DataFrame:
    """Adds the columns of a layout to raw JSON texts, with or without the wrapper ``analyzeResult``; what can't be read is null."""
    parsed = F.from_json(F.col(value), f"analyzeResult struct<{_inner()}>, {LAYOUT_DDL}", {"mode": "PERMISSIVE"})
    rows = raw.withColumn("__p", parsed)
    names = [c.split()[0] for c in LAYOUT_DDL.replace(", ", "\n").split("\n") if " array<" in c]
    return rows.select(*raw.columns, *[F.coalesce(F.col(f"__p.analyzeResult.{n}"), F.col(f"__p.{n}")).alias(n) for n in names])


def _inner() -> str:
    return ", ".join(f"{c.split(' ', 1)[0]}:{c.split(' ', 1)[1]}" for c in LAYOUT_DDL.replace(">, ", ">\n").split("\n"))


def layouts(spark: SparkSession, folder: str, limit: int = LAYOUT_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Layouts of a folder's JSON files: those read, and those too large or unreadable (name, reason)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    small = files.where(F.col("length") <= limit).select(name.alias("doc"), F.col("content").cast("string").alias("value"))
    parsed = parse_layouts(small)
    sound = F.lit(False)
    for part in ("pages", "paragraphs", "sections", "figures", "tables"):
        sound = sound | F.col(part).isNotNull()
    bad = files.where(F.col("length") > limit).select(name.alias("name"), F.lit("too large").alias("reason")).unionByName(parsed.where(~sound).select(F.col("doc").alias("name"), F.lit("unreadable").alias("reason")))
    return parsed.where(sound).drop("value"), bad


def with_sidecar(df: DataFrame, sidecar: DataFrame, on: list[str]) -> DataFrame:
    """Rows with what a stage left for them; what is missing is null."""
    return df.join(sidecar, on, "left")


def write_records(records: DataFrame, path: str) -> None:
    """Records by type; of equal ids the latest."""
    latest(records, "id", ["last_indexed_at", "chunk_id"]).write.mode("overwrite").partitionBy("record_type").parquet(path)


def upsert_records(spark: SparkSession, path: str, records: DataFrame, to: str) -> None:
    """What is indexed with the records put in, of equal ids the latest, written to another place: run again, it gives the same."""
    latest(spark.read.parquet(path).unionByName(records, allowMissingColumns=True), "id", ["last_indexed_at", "chunk_id"]).write.mode("overwrite").partitionBy("record_type").parquet(to)


def delete_records(spark: SparkSession, path: str, keys: DataFrame, to: str, key: str = "id") -> None:
    """The records without those keys, written to another place, as a Parquet folder can't lose rows where it stands."""
    spark.read.parquet(path).join(keys.select(key), key, "left_anti").write.mode("overwrite").partitionBy("record_type").parquet(to)


def append_runs(runs: DataFrame, path: str) -> None:
    run_records(runs, F.current_timestamp()).write.mode("append").partitionBy("partitionKey").parquet(path)

"""Exact dedup as a stateful stream.

Documents are read as a stream of files and keyed by the SHA-256 digest of their text. The keyed state, in RocksDB on
disk and without expiry, retains for each digest the identifier and the content locator (file and row) of the document
that was first; texts stay out of it and out of its shuffle. Digests share a state entry with others of the same hash
bucket, some dozens at the size that the corpus has when the stream starts, so that Python is called for each bucket and
not for each document. A document whose digest is known is a hit. In each batch, the texts of hits and of those retained
are read by their locators, row group by row group, and compared in full; only equal ones are duplicates. Texts that differ
under one digest go to an overflow table beside the state, where they are told apart by their full texts.

First is the earlier batch, and in a batch the smaller id (null ids last), then the locator. Defined results: null texts
are no duplicates and all kept; empty texts are equal to each other. Of repeated rows one stays. An empty folder gives
an empty result. Other columns pass through.
"""

from __future__ import annotations

import io
import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.common import attach, located, new_path, unpacked

LAST = (1 << 63) - 1
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a batch reads, so that one of a large backlog fits.
BATCH = 256 << 30
#: Bytes of the source for each bucket of the state, about: some dozens of documents.
BUCKET_BYTES = 128 << 10
#: Rows of a file that one task reads texts of.
STRETCH = 200_000
HIT = "digest binary, doc_id bigint, path string, row bigint, keep_id bigint, keep_path string, keep_row bigint"


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))


Place = tuple[int, str, int]


def packed_state(known: dict[bytes, Place]) -> bytes:
    """A bucket's digests with their places; files by number, as few files fill a bucket."""
    files = {p: n for n, p in enumerate(dict.fromkeys(v[1] for v in known.values()))}
    digests = list(known)
    out = io.BytesIO()
    head = json.dumps({"n": len(known), "width": len(digests[0]) if digests else 0, "files": list(files)}).encode()
    out.write(len(head).to_bytes(4, "little") + head + b"".join(digests))
    out.write(np.array([(v[0], files[v[1]], v[2]) for v in known.values()], "<i8").tobytes())
    return out.getvalue()


def unpacked_state(data: bytes) -> dict[bytes, Place]:
    n = int.from_bytes(data[:4], "little")
    head, data = json.loads(data[4 : 4 + n]), data[4 + n :]
    w, files = head["width"], head["files"]
    places = np.frombuffer(data, "<i8", 3 * head["n"], w * head["n"]).reshape(-1, 3).tolist()
    return {data[w * i : w * i + w]: (p[0], files[p[1]], p[2]) for i, p in enumerate(places)}


def hits(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Of one bucket: each document but those retained. Where the retained one is of this batch it isn't known until the
    end, so hits go out without it and a row with it alone follows; only the least document of each digest is held."""
    known = unpacked_state(bytes(state.get[0])) if state.exists else {}
    new: dict[bytes, Place] = {}
    twice: set[bytes] = set()
    nothing = (None, None, None)
    for part in parts:
        out = []
        for d, *mine in zip(*(part[c].tolist() for c in ("digest", "doc_id", "path", "row")), strict=True):
            d, mine = bytes(d), tuple(mine)
            if old := known.get(d):
                out.append((d, *mine, *old))
            elif best := new.get(d):
                twice.add(d)
                new[d] = min(best, mine)
                out.append((d, *max(best, mine), *nothing))
            else:
                new[d] = mine
        if out:
            yield _frame(out)
    if new:
        state.update((packed_state(known | new),))
    if twice:
        yield _frame([(d, *nothing, *new[d]) for d in sorted(twice)])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["digest", "doc_id", "path", "row", "keep_id", "keep_path", "keep_row"]).astype({"doc_id": "Int64", "row": "Int64", "keep_id": "Int64", "keep_row": "Int64"})


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, row, text) of locators that come sorted; reads the row groups that hold them, and of these the texts alone."""

    def read(path: str, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(at) as f:
            file, start = pq.ParquetFile(f), 0
            for g in range(file.num_row_groups):
                end = start + file.metadata.row_group(g).num_rows
                own = rows[np.searchsorted(rows, start) : np.searchsorted(rows, end)]
                if len(own):
                    texts = file.read_row_group(g, columns=["text"]).column("text")
                    for k in range(0, len(own), 1000):
                        some = own[k : k + 1000]
                        text = texts.take(pa.array(some - start)).combine_chunks().cast(pa.string())
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(some)), pa.array(some), text], ["path", "row", "text"])
                start = end

    path, held = None, []
    for batch in batches:
        for p, rows in pd.Series(batch.column("row").to_numpy()).groupby(batch.column("path").to_pandas().to_numpy(), sort=False):
            if p != path and held:
                yield from read(path, np.concatenate(held))
                held = []
            path = p
            held.append(rows.to_numpy())
    if held:
        yield from read(path, np.concatenate(held))


class _Batches:
    """Checks the hits of each batch against full texts and writes duplicates; written again if the batch is run again."""

    def __init__(self, out: str):
        self.out = out

    def texts(self, at: DataFrame) -> DataFrame:
        """(path, row, text) of the rows that the locators (path, row) name. A task has a stretch of a file's rows."""
        stretch = F.call_function("div", F.col("row"), F.lit(STRETCH).cast("bigint"))
        spread = at.select("path", "row").distinct().repartition("path", stretch).sortWithinPartitions("path", "row")
        return spread.mapInArrow(_fetch, "path string, row bigint, text string")

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # written before all else: the state's function runs once a batch
        batch.write.mode("overwrite").parquet(f"{self.out}/raw/batch={number}")
        batch = spark.read.schema(HIT).parquet(f"{self.out}/raw/batch={number}")
        keepers = batch.where("doc_id is null").select("digest", F.struct("keep_id", "keep_path", "keep_row").alias("k"))
        found = batch.where("doc_id is not null").join(keepers, "digest", "left")
        own = F.col("keep_id").isNotNull()
        found = found.select("digest", "doc_id", "path", "row", *[F.when(own, F.col(c)).otherwise(F.col(f"k.{c}")).alias(c) for c in ("keep_id", "keep_path", "keep_row")])
        if found.isEmpty():
            return
        mine = self.texts(found)
        kept = self.texts(found.select(F.col("keep_path").alias("path"), F.col("keep_row").alias("row"))).select(F.col("path").alias("keep_path"), F.col("row").alias("keep_row"), F.col("text").alias("keep_text"))
        # the planner takes the texts for as small as their locators
        both = found.join(mine.hint("merge"), ["path", "row"]).join(kept.hint("merge"), ["keep_path", "keep_row"])
        both.select("doc_id", "path", "row", "keep_id", "digest", (F.col("text") == F.col("keep_text")).alias("equal")).write.mode("overwrite").parquet(f"{self.out}/compared/batch={number}")
        compared = spark.read.parquet(f"{self.out}/compared/batch={number}")
        compared.where("equal").select("doc_id", "path", "row", "keep_id").write.mode("overwrite").parquet(f"{self.out}/duplicates/batch={number}")
        other = compared.where("not equal").select("digest", "doc_id", "path", "row")
        if not other.isEmpty():
            self.overflow(other, number)

    def overflow(self, other: DataFrame, number: int) -> None:
        spark = other.sparkSession
        now = other.join(self.texts(other.select("path", "row")).hint("merge"), ["path", "row"])
        keys = ["digest", "text"]
        fresh = now
        try:
            before = spark.read.parquet(f"{self.out}/overflow").where(F.col("batch") < number)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
        else:
            before = before.join(self.texts(before.select("path", "row")).hint("merge"), ["path", "row"]).select(*keys, F.col("doc_id").alias("keep_id"))
            known = now.join(before, keys)
            known.select("doc_id", "path", "row", "keep_id").write.mode("overwrite").parquet(f"{self.out}/duplicates/batch={number}o")
            fresh = now.join(before, keys, "left_anti")
        place = F.struct("doc_id", "path", "row")
        first = fresh.groupBy(*keys).agg(F.min(place).alias("k"))
        first.select("digest", "k.doc_id", "k.path", "k.row").write.mode("overwrite").parquet(f"{self.out}/overflow/batch={number}")
        again = fresh.join(first, keys).where(F.col("k") != place)
        again.select("doc_id", "path", "row", F.col("k.doc_id").alias("keep_id")).write.mode("overwrite").parquet(f"{self.out}/duplicates/batch={number}f")


def _buckets(spark: SparkSession, source: str, out: str) -> int:
    """The number of buckets of the state at ``out``: set once, by the size of the source when its stream starts."""
    path = f"{out}/buckets"
    try:
        return spark.read.parquet(path).first()[0]
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(source)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    n = 1 << max(6, math.ceil(math.log2(max(size, 1) / BUCKET_BYTES)))
    spark.createDataFrame([(n,)], "n bigint").coalesce(1).write.parquet(path)
    return n


def run_stream(spark: SparkSession, source: str, out: str, hashed=digest, batch: int = BATCH, files: int | None = None) -> None:
    """Take in all files of ``source`` that the state at ``out`` hasn't seen yet. ``out`` holds the stream's checkpoint and
    its results; running again with it goes on with its state."""
    schema = spark.read.parquet(source).schema
    buckets = _buckets(spark, source, out)
    stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch) if files is None else spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    # as a pattern, the source may be one file as well as a folder
    docs = stream.parquet(f"{source[:-1]}[{source[-1]}]").select("doc_id", "text", "_metadata").where("text is not null")
    rows = _located(docs).select(hashed(F.col("text")).alias("digest"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc_id"), F.col("__path").alias("path"), F.col("__row").alias("row"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets).cast("bigint")))
    found = rows.groupBy("bucket").applyInPandasWithState(hits, HIT, "entries binary", "append", "NoTimeout")
    settings = {"spark.sql.streaming.stateStore.providerClass": STORE, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = found.writeStream.foreachBatch(_Batches(out)).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    query.awaitTermination()


def duplicates(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, path, row, keep_id) of the duplicates that the stream at ``out`` has found."""
    schema = "doc_id bigint, path string, row bigint, keep_id bigint"
    try:
        return spark.read.schema(schema).parquet(f"{out}/duplicates").select("doc_id", "path", "row", "keep_id")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def dedup(spark: SparkSession, source: str, out: str | None = None, **options) -> DataFrame:
    """The documents of ``source`` that are kept, with all their columns."""
    out = out or new_path(spark, "stream-dedup")
    run_stream(spark, source, out, **options)
    docs = spark.read.parquet(source)
    gone = duplicates(spark, out).select(F.xxhash64("path").alias("file"), F.col("row").alias("at"), F.lit(True).alias("value"))
    return unpacked(attach(located(docs), gone, "__gone").where("__gone IS NULL"), docs.columns)


def sql() -> str:
    return "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) AS n FROM documents) WHERE n = 1 OR text IS NULL"

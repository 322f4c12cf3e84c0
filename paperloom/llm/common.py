"""Helpers shared by the corpus operators: shared folder, materialising, places of rows, size-checked joins."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: A token is a maximal run of characters other than blank, tab, line feed and carriage return.
TOKEN = "[^ \\t\\n\\r]+"
#: A side of a join is broadcast up to this many bytes, measured as JSON.
BROADCAST_BYTES = 32 << 20
#: Bytes of rows that Spark hands to Python at once. Spark's own bound is 64 MB, of which a task holds several copies, in both
#: processes and for each Python step in a row.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
ROW = "__row"
#: The place of a row: a hash of its file's path, and its number in that file.
FILE, AT = "__file", "__at"
LAST = (1 << 63) - 1


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``. Where it is unset, one of this machine's is set here, if it is
    the only one that runs (tests); on a cluster that is an error. Where the session sets no bound of Arrow batches in bytes, ours is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    # with its scheme: other readers than Spark have another file system where there is none
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives the loss of executors, and gives real sizes to the planner."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """The whole input row as one struct beside the named columns, so that no column of the input can clash with ours."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *[c.alias(k) for k, c in named.items()])


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in columns])


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("bigint")


def join_sized(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = 64) -> DataFrame:
    """Join with a table that is small as a rule. Its bytes are measured (``small`` should be materialised): up to
    ``BROADCAST_BYTES`` it is broadcast; beyond, it is replicated under ``salts`` salts and shuffled, so that a heavy
    key of ``big`` is spread over many tasks. The result is the same."""
    size = small.agg(F.sum(F.octet_length(F.to_json(F.struct(*small.columns))))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    salted = small.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")).join(salted, [*on, "__salt"], how).drop("__salt")


def _give_back() -> None:
    """Memory that this process holds and doesn't use, to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which keeps its own house
        pass


def lean(step):
    """The step over batches, giving memory back at its end: a worker that waits for its next task would keep it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            _give_back()

    return run


# -- places --


def _is_scan(df: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, at most filtered and projected, so that each has a place of its own."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if node.nodeName() != "LogicalRelation" or "HadoopFsRelation" not in node.relation().getClass().getName():
        return False
    return "parquet" in node.relation().fileFormat().toString().lower()


def located(df: DataFrame) -> DataFrame:
    """(__row, __file, __at): every row as a struct, and its place, which is its own even where rows are equal. Other frames
    than scans of Parquet files are written to the shared folder first."""
    if not _is_scan(df):
        df = materialise(df, "rows")
    place = df.metadataColumn("_metadata")
    return packed(df, **{FILE: F.xxhash64(place["file_path"]), AT: place["row_index"]})


def _place_writer(path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(file: int, parts: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(parts).select(["at", "value"]).combine_chunks()
            fs, to = pafs.FileSystem.from_uri(f"{path}/{file & (1 << 64) - 1:016x}")
            # a task that runs again writes the same; a move puts it in place at once
            with fs.open_output_stream(tmp := f"{to}.{uuid.uuid4().hex}") as f, pa.ipc.new_file(f, table.schema) as w:
                w.write_table(table)
            fs.move(tmp, to)

        held: list[pa.RecordBatch] = []
        last, n = None, 0
        for batch in batches:
            files = batch.column("file").to_numpy()
            cuts = [0, *(np.nonzero(np.diff(files))[0] + 1).tolist(), len(files)]
            n += len(files)
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if files[s] != last and held:
                    put(last, held)
                    held = []
                last = int(files[s])
                held.append(batch.slice(s, e - s))
        if held:
            put(last, held)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return write


def _finder(path: str, kind: pa.DataType):
    held: OrderedDict[int, tuple | None] = OrderedDict()

    def load(file: int) -> tuple | None:
        if file not in held:
            fs, at = pafs.FileSystem.from_uri(f"{path}/{file & (1 << 64) - 1:016x}")
            held[file] = None
            if fs.get_file_info(at).type == pafs.FileType.File:
                with fs.open_input_file(at) as f:
                    table = pa.ipc.open_file(f).read_all()
                held[file] = (table.column("at").to_numpy(), table.column("value").combine_chunks().cast(kind))
            if len(held) > 4:
                held.popitem(last=False)
        return held[file]

    def find(file: pa.Array, at: pa.Array) -> pa.Array:
        files, ats = file.to_numpy(zero_copy_only=False), at.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.nonzero(np.diff(files))[0] + 1).tolist(), len(files)]
        out = []
        for s, e in zip(cuts, cuts[1:], strict=False):
            if s == e:
                continue
            if (found := load(int(files[s]))) is None:
                out.append(pa.nulls(e - s, kind))
                continue
            keys, values = found
            k = np.minimum(np.searchsorted(keys, ats[s:e]), len(keys) - 1)
            out.append(values.take(pa.array(k, mask=keys[k] != ats[s:e])))
        return pa.concat_arrays(out) if out else pa.nulls(0, kind)

    return find


def finder(found: DataFrame):
    """A function of Arrow arrays (__file, __at) that gives the value that ``found`` (file, at, value; a place once) has for each place, null
    for none. ``found`` is shuffled to one file for each file of rows, in which the tasks that read it look rows up. Such a file has no
    more entries than the one it belongs to has rows."""
    path = new_path(found.sparkSession, "places")
    fs, at = pafs.FileSystem.from_uri(path)
    fs.create_dir(at, recursive=True)
    found.select("file", "at", "value").repartition("file").sortWithinPartitions("file", "at").mapInArrow(lean(_place_writer(path)), "n bigint").agg(F.sum("n")).collect()
    return _finder(path, to_arrow_type(found.schema["value"].dataType))


def attach(rows: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """Rows (__file, __at, ...) with the value that ``found`` (file, at, value; a place once) has for their place, null for none.
    A join that doesn't move the rows (``finder``)."""
    # a filter on the value would be a second look-up, in a Python process of its own, if Spark might repeat it
    look = F.arrow_udf(finder(found), found.schema["value"].dataType).asNondeterministic()
    return rows.withColumn(name, look(FILE, AT))

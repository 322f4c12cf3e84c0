"""WARC files: a splittable reader of gzipped ones, and a writer.

A WARC file is a row of gzip members, one a record. The reader cuts files into byte ranges and gives each to a task. A
task looks for the gzip magic in its range; a candidate is a member where its header and its first bytes decode to the
start of a record and all of it decodes with the right checksum. A task owns the records whose member starts in its
range, and reads past the end of it to finish the last one. After a member, the next one is expected at its end; where
none is, the search goes on. The first candidate of a range must also be followed by a member or the end of the file,
as compressed bytes may hold a magic by chance.

Defined results: damaged members are skipped, up to the next sound one. Fields that a record lacks are null. Empty files
and folders give no records. A record with an empty body has an empty content. The writer leaves out no row: a null
id, URL or text is not written as a field, and read as null again; an empty one is empty again. Repeated rows are
repeated records. Columns other than those named are not written.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.common import new_path

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 20
#: Bytes of a split, as of a block of a distributed file system.
SPLIT = 32 << 20
SCHEMA = "path string, offset bigint, type string, record_id string, target_uri string, date string, headers map<string,string>, content binary"


class Window:
    """Random access to a file through a buffer."""

    def __init__(self, f, size: int):
        self.f, self.size, self.at, self.held = f, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not (self.at <= at and at + n <= self.at + len(self.held)):
            self.f.seek(at)
            self.at, self.held = at, self.f.read(min(max(n, BLOCK), self.size - at)) if at < self.size else b""
        return self.held[at - self.at : at - self.at + n]

    def find(self, at: int, end: int) -> int:
        """Where in [at, end) the next magic starts, or -1."""
        while at < end:
            block = self.read(at, min(BLOCK, end - at) + len(MAGIC) - 1)
            k = block.find(MAGIC)
            while 0 <= k and at + k < end:
                if k + 3 >= len(block) or block[k + 3] < 32:  # the upper flags are reserved
                    return at + k
                k = block.find(MAGIC, k + 1)
            at += min(BLOCK, end - at)
        return -1


def member(w: Window, at: int, chained: bool) -> tuple[bytes, int] | None:
    """The record data of the member that starts here, and where it ends; None if there is no sound one."""
    d = zlib.decompressobj(31)
    parts: list[bytes] = []
    pos = at
    try:
        first = d.decompress(w.read(at, 512), 512)
        pos = at + min(512, w.size - at)
        head, parts = first, [first]
        step = 1 << 16
        while not d.eof:
            more = d.unconsumed_tail
            if not more:
                more = w.read(pos, step)
                if not more:
                    return None
                pos += len(more)
            data = d.decompress(more)
            if len(head) < 5:
                head += data
            if len(head) >= 5 and not head.startswith(b"WARC/"):
                return None
            parts.append(data)
    except zlib.error:
        return None
    end = pos - len(d.unused_data)
    if not head.startswith(b"WARC/") or not (chained or end == w.size or w.read(end, 3) == MAGIC):
        return None
    return b"".join(parts), end


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record of a member."""
    at = 0
    while data.startswith(b"WARC/", at):
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        fields: dict[str, str] = {}
        last = ""
        for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            if line[:1] in " \t" and last:
                fields[last] += " " + line.strip()
            elif ":" in line:
                last, _, value = line.partition(":")
                last = last.strip()
                fields[last] = value.strip()
        lower = {k.lower(): v for k, v in fields.items()}
        n = int(lower["content-length"]) if lower.get("content-length", "").isdigit() else len(data) - end - 4
        yield lower, data[end + 4 : end + 4 + n]
        at = end + 4 + n
        while data.startswith(b"\r\n", at):
            at += 2


def read_range(w: Window, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of the members that start in the range."""
    at, chained = start, start == 0
    while (at := w.find(at, end)) >= 0:
        if found := member(w, at, chained):
            yield at, found[0]
            at, chained = found[1], True
        else:
            at, chained = at + 1, False


def _reader(limit: int = 8 << 20):
    names = ["path", "offset", "type", "record_id", "target_uri", "date", "headers", "content"]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in b.to_pylist():
                fs, at = pafs.FileSystem.from_uri(s["path"])
                rows, held = [], 0
                with fs.open_input_file(at) as f:
                    for offset, data in read_range(Window(f, s["size"]), s["start"], s["end"]):
                        for h, content in records(data):
                            rows.append((s["path"], offset, h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-date"), list(h.items()), content))
                            held += len(content)
                        if held > limit:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return read


def read_warc(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The records of a file, or of the ``.warc.gz`` files of a folder: path, offset of the member, type, record_id, target_uri, date,
    headers (names in lower case) and content."""
    fs, at = pafs.FileSystem.from_uri(path)
    scheme = path[: len(path) - len(at)] if path.endswith(at) else ""
    info = fs.get_file_info(at)
    files = [info] if info.type == pafs.FileType.File else [i for i in fs.get_file_info(pafs.FileSelector(at, recursive=True)) if i.type == pafs.FileType.File and i.path.endswith(".warc.gz")]
    splits = [(scheme + i.path, i.size, s, min(s + split, i.size)) for i in sorted(files, key=lambda i: i.path) for s in range(0, i.size, split)]
    rows = spark.createDataFrame(splits, "path string, size bigint, start bigint, end bigint")
    # one task a split, up to a number of tasks at which each has several
    return rows.repartition(max(1, min(len(splits), 20_000))).mapInArrow(_reader(), SCHEMA)


def _field(name: str, value: str | None) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def record(page_id: int | None, url: str | None, html: str | None, level: int) -> bytes:
    """A gzip member with a page. The URL is escaped where it holds blanks, controls or percent signs, so that it comes back as it was."""
    body = (html or "").encode()
    head = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n" + _field("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>")
    head += _field("WARC-Target-URI", None if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~")) + _field("X-Page-Id", None if page_id is None else str(page_id)) + ("X-No-Content: true\r\n" if html is None else "")
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(f"{head}Content-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n") + z.flush()


def _writer(path: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(path)
        name = f"{at}/part-{TaskContext.get().partitionId():06d}"
        n = 0
        with fs.open_output_stream(tmp := f"{name}.{uuid.uuid4().hex}.tmp", compression=None) as f:
            for b in batches:
                for p, u, h in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                    f.write(record(p, u, h, level))
                    n += 1
        fs.move(tmp, f"{name}.warc.gz")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return write


def write_warc(pages: DataFrame, path: str, level: int = 6) -> int:
    """Write pages as one ``.warc.gz`` file a partition; the number of records. A task that runs again replaces its file."""
    fs, at = pafs.FileSystem.from_uri(path)
    fs.create_dir(at, recursive=True)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(_writer(path, level), "n bigint")
    return rows.agg(F.sum("n")).first()[0] or 0


def pages_through_warc(pages: DataFrame, split: int = SPLIT, level: int = 6) -> DataFrame:
    """(page_id, url, html): the pages, written as WARC files to the shared folder and read back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_warc(pages, path, level)
    got = read_warc(spark, path, split)
    return got.select(
        F.try_element_at("headers", F.lit("x-page-id")).cast("bigint").alias("page_id"),
        F.url_decode(F.replace("target_uri", F.lit("+"), F.lit("%2B"))).alias("url"),
        F.when(F.try_element_at("headers", F.lit("x-no-content")).isNull(), F.col("content").cast("string")).alias("html"),
    )


def sql() -> str:
    return "SELECT page_id, url, html FROM pages"


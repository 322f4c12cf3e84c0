"""URL filters on sorted digest arrays.

A blocklist of URLs and domains is kept as shards by the leading bits of the 64-bit xxHash of each entry: a sorted array
of keys, the offsets of the entries, and the entries themselves, in one file each in the shared folder. A task maps its
shard's keys into memory, probes a whole batch of keys with one vectorised binary search, and compares the stored entry
of every hit with the URL, so that a collision blocks nothing. Pages are sent to shards with their ids and URLs alone.

A page is blocked where its canonical URL is an entry, or its host, or a domain above it. Canonical: host and path in
lower case without scheme, user, port, ``www.``, fragment, ``utm_`` parameters and closing slash. Defined results: a null or
empty URL is not blocked, nor is one without a host unless it is an entry as it stands. Null and empty entries are left out, equal
ones kept once. Repeated rows are judged alike, each on its own. An empty list blocks nothing; an empty table gives an
empty result. Columns other than the id and the URL are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import new_path

#: Entries of a shard, about: keys and entries of a task take some 200 MB then.
SHARD = 2_000_000


def canonical(url: Column) -> Column:
    for pattern, to in (("^[a-z][a-z0-9+.-]*://", ""), ("#.*$", ""), ("^[^/?]*@", ""), ("^www\\.", ""), ("^([^/?:]*):[0-9]+", "$1"), ("([?&])utm_[^&]*", "$1"), ("&&+", "&"), ("\\?&+", "?"), ("[?&]+$", ""), ("/$", "")):
        url = F.regexp_replace(F.lower(F.trim(url)) if pattern.startswith("^[a-z]") else url, pattern, to)
    return url


def probes(canon: Column) -> Column:
    """The canonical URL, its host, and each domain above the host that has a dot."""
    host = F.regexp_extract(canon, "^([^/?]*)", 1)
    parts = F.split(host, "\\.")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.filter(F.array_distinct(F.concat(F.array(canon), above)), lambda p: p != "")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _shard_writer(path: str):
    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        keys = table.column("key").combine_chunks().to_numpy().view(np.uint64)
        entries = [e.encode() for e in table.column("entry").to_pylist()]
        order = np.argsort(keys, kind="stable")
        offsets = np.concatenate([[0], np.cumsum([len(entries[i]) for i in order])]).astype("<i8")
        fs, at = _open(f"{path}/{shard:06d}")
        # a task that runs again writes the same bytes; a move puts them in place at once
        with fs.open_output_stream(tmp := f"{at}.{np.random.default_rng().integers(1 << 62)}") as f:
            f.write(np.array([len(order)], "<i8").tobytes())
            f.write(keys[order].astype("<u8").tobytes())
            f.write(offsets.tobytes())
            f.write(b"".join(entries[i] for i in order))
        fs.move(tmp, at)
        return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(order)], pa.int64())})

    return write


class Shard:
    """A shard's arrays, mapped into memory where the shared folder is mounted, or else read."""

    def __init__(self, path: str):
        fs, at = _open(path)
        self.found = fs.get_file_info(at).type == pafs.FileType.File
        if not self.found:
            return
        with (pa.memory_map(at) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(at)) as f:
            self.data = f.read_buffer() if isinstance(fs, pafs.LocalFileSystem) else pa.py_buffer(f.read())
        n = int(np.frombuffer(self.data, "<i8", 1)[0])
        self.keys = np.frombuffer(self.data, "<u8", n, 8)
        self.offsets = np.frombuffer(self.data, "<i8", n + 1, 8 + 8 * n)
        self.entries = memoryview(self.data)[8 + 8 * n + 8 * (n + 1) :]

    def probe(self, keys: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Which of the texts, whose keys these are, are entries."""
        hit = np.zeros(len(keys), dtype=bool)
        if not self.found or not len(self.keys):
            return hit
        low = np.searchsorted(self.keys, keys)
        for i in np.nonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == keys)[0]:
            text, at = texts[i].as_py().encode(), low[i]
            while at < len(self.keys) and self.keys[at] == keys[i]:  # all entries of that key
                if self.entries[self.offsets[at] : self.offsets[at + 1]] == text:
                    hit[i] = True
                    break
                at += 1
        return hit


def _prober(path: str):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Shard] = {}
        for batch in batches:
            shards, keys = batch.column("shard").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
            blocked = np.zeros(len(keys), dtype=bool)
            for shard in np.unique(shards).tolist():
                if shard not in held:
                    held = {**({} if len(held) > 3 else held), shard: Shard(f"{path}/{shard:06d}")}
                own = np.nonzero(shards == shard)[0]
                blocked[own] = held[shard].probe(keys[own], batch.column("probe").take(pa.array(own)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).filter(pa.array(blocked)) for c in ("page", "probe"))], ["page", "probe"])

    return probe


def build(entries: DataFrame, hashed=F.xxhash64, shard: int = SHARD) -> tuple[str, int]:
    """Write the list (its first column) to the shared folder; the folder, and the number of leading bits that name a shard."""
    clean = entries.select(F.col(entries.columns[0]).cast("string").alias("entry")).where("length(entry) > 0").distinct()
    bits = max(0, (clean.count() // shard).bit_length())
    path = new_path(entries.sparkSession, "url-list")
    fs, at = _open(path)
    fs.create_dir(at, recursive=True)
    keyed = clean.select("entry", hashed("entry").alias("key")).select("entry", "key", _shard_of(F.col("key"), bits).alias("shard"))
    keyed.groupBy("shard").applyInArrow(_shard_writer(path), "shard int, n bigint").agg(F.sum("n")).collect()
    return path, bits


def _shard_of(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def blocked_urls(pages: DataFrame, path: str, bits: int, hashed=F.xxhash64) -> DataFrame:
    """(url, entry): each distinct URL that is blocked, and the longest entry that blocks it."""
    urls = pages.where("length(url) > 0").select(F.col("url").alias("page")).distinct()
    rows = urls.select("page", F.explode(probes(canonical(F.col("page")))).alias("probe"))
    rows = rows.select("page", "probe", hashed("probe").alias("key")).select("page", "probe", "key", _shard_of(F.col("key"), bits).alias("shard"))
    if bits:  # each task then needs few shards
        rows = rows.repartition("shard")
    hits = rows.mapInArrow(_prober(path), "page string, probe string")
    return hits.groupBy(F.col("page").alias("url")).agg(F.max_by("probe", F.struct(F.length("probe"), "probe")).alias("entry"))


def filter_urls(pages: DataFrame, entries: DataFrame, hashed=F.xxhash64, shard: int = SHARD) -> DataFrame:
    """(page_id, url, blocked, entry) of every page."""
    hits = blocked_urls(pages, *build(entries, hashed, shard), hashed)
    rows = pages.select("page_id", "url").join(hits, "url", "left")
    return rows.select("page_id", "url", F.col("entry").isNotNull().alias("blocked"), "entry")


def with_traps(pages: DataFrame, domains: tuple[str, ...]) -> DataFrame:
    """(entry): the domains, and canonical URLs that two or more pages answer to: traps for crawlers."""
    traps = pages.where("length(url) > 0").groupBy(canonical(F.col("url")).alias("entry")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("entry")
    return pages.sparkSession.createDataFrame([(d,) for d in domains], "entry string").unionByName(traps)


_CANON = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '', 'g'), '^[^/?]*@', ''), '^www\.', ''), '^([^/?:]*):[0-9]+', '\1'), '([?&])utm_[^&]*', '\1', 'g'), '&&+', '&', 'g'), '\?&+', '?', 'g'), '[?&]+$', ''), '/$', '')"""


def sql(domains: tuple[str, ...]) -> str:
    """The filter with that list in DuckDB SQL."""
    return f"""WITH c AS (SELECT page_id, url, {_CANON} AS canon FROM pages),
    e AS (SELECT unnest([{", ".join(f"'{d}'" for d in domains)}]) AS entry UNION SELECT canon FROM c WHERE length(url) > 0 GROUP BY canon HAVING count(*) > 1),
    h AS (SELECT DISTINCT url, canon, string_split(regexp_extract(canon, '^([^/?]*)', 1), '.') AS parts FROM c WHERE length(url) > 0),
    p AS (SELECT url, canon AS probe FROM h UNION SELECT url, array_to_string(list_slice(parts, i, len(parts)), '.') FROM (SELECT url, parts, unnest(range(1, greatest(len(parts), 2))) AS i FROM h)),
    b AS (SELECT url, arg_max(probe, (length(probe), probe)) AS entry FROM p JOIN e ON e.entry = p.probe WHERE probe <> '' GROUP BY url)
    SELECT page_id, c.url, b.entry IS NOT NULL AS blocked, b.entry FROM c LEFT JOIN b ON b.url = c.url"""

import gzip
import io

import pytest

from paperloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, offset string"
ROWS = [
    (1, "https://a.example.com/x y?q=%20é", "<p>één\r\n\r\n</p>"),
    (None, "https://a.example.com/", "b"),
    (2, None, "c"),
    (3, "https://b.example.com/a+b", None),
    (4, "https://b.example.com/", ""),
    (4, "https://b.example.com/", ""),
    (5, "x\r\nWARC-Type: forged", "WARC/1.1\r\n\r\n\x1f"),
    (6, "https://c.example.com/long", "long " * 100_000),
]


def _members(data, split):
    w = warc.Window(io.BytesIO(data), len(data))
    return [m for s in range(0, len(data), split) for m in warc.read_range(w, s, min(s + split, len(data)))]


@pytest.mark.parametrize("split", [7, 1000, 1 << 20])
def test_round_trip(spark, split):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS * (1 if split == 7 else 40)], SCHEMA).repartition(3)
    if split == 7:
        pages = pages.where("page_id IS NULL OR page_id < 6")
    got = warc.pages_through_warc(pages, split)
    assert sorted(map(str, got.collect())) == sorted(map(str, pages.select("page_id", "url", "html").collect()))


@pytest.mark.parametrize("split", [1, 13, 100, 10_000])
def test_every_member_is_read_once(split):
    records = [warc.record(i, f"https://a.example.com/{i}", "text " * (i * 7 % 50), 6) for i in range(25)]
    data = b"".join(records)
    starts = [sum(map(len, records[:i])) for i in range(25)]
    assert [m[0] for m in _members(data, split)] == starts


def test_magic_within_a_record_and_damage():
    inner = warc.record(9, "https://in.example.com/", "inside", 0)
    stored = warc.record(1, "https://a.example.com/", "x" + warc.MAGIC.decode("latin1"), 0)
    other = gzip.compress(b"not a record")
    damaged = bytearray(warc.record(2, "https://b.example.com/", "to be damaged " * 20, 6))
    damaged[len(damaged) // 2] ^= 0xFF
    last = warc.record(3, "https://c.example.com/", "whole", 6)
    data = stored + other + bytes(damaged) + last
    for split in (5, 64, 1 << 20):
        found = _members(data, split)
        assert [m[0] for m in found] == [0, len(stored) + len(other) + len(damaged)]
    # a record that holds another's bytes, stored as they are, is one record
    z = io.BytesIO()
    with gzip.GzipFile(fileobj=z, mode="wb", compresslevel=0) as g:
        g.write(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n")
    data = z.getvalue() + last
    assert [m[0] for m in _members(data, 20)] == [0, len(z.getvalue())]


def test_empty_folder_and_table(spark, tmp_path):
    assert warc.read_warc(spark, f"file://{tmp_path}").count() == 0
    assert warc.pages_through_warc(spark.createDataFrame([], SCHEMA)).count() == 0


def test_several_records_and_folded_fields():
    data = b"WARC/1.0\r\nA: b\r\n c\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    got = list(warc.records(data))
    assert got[0] == ({"a": "b c", "content-length": "3"}, b"xyz") and got[1][1] == b"" and len(got) == 2

from pyspark.sql import functions as F

from paperloom.llm import url_filter

SCHEMA = "page_id bigint, url string, html string, entry string, key string, blocked string"
URLS = [
    (1, "https://WWW.Bad.example.com/a?utm_source=x#top"),
    (2, "http://sub.bad.example.com:8080/"),
    (3, "https://good.example.com/x/"),
    (4, "https://good.example.com/x?utm_a=1&b=2&utm_c=3"),
    (5, None),
    (6, ""),
    (7, "no scheme here"),
    (8, "https://notbad.example.com/"),
    (3, "https://good.example.com/x/"),
    (None, "https://user@good.example.com/y"),
    (9, "https://long.example.com/" + "x" * 100_000),
]
LIST = ["bad.example.com", "good.example.com/x?b=2", "", None, "bad.example.com", "good.example.com/y", "long.example.com/" + "x" * 100_000]
WANT = {1: "bad.example.com", 2: "bad.example.com", 3: None, 4: "good.example.com/x?b=2", 5: None, 6: None, 7: None, 8: None, None: "good.example.com/y", 9: LIST[-1]}


def _run(spark, **options):
    pages = spark.createDataFrame([(i, u, "h", "e", "k", "b") for i, u in URLS], SCHEMA)
    entries = spark.createDataFrame([(e,) for e in LIST], "entry string")
    return url_filter.filter_urls(pages, entries, **options).collect()


def test_urls_hosts_and_domains(spark):
    out = _run(spark)
    assert len(out) == len(URLS)
    assert all(r["entry"] == WANT[r["page_id"]] and r["blocked"] == (WANT[r["page_id"]] is not None) for r in out)


def test_shards(spark):
    assert sorted(map(str, _run(spark, shard=1))) == sorted(map(str, _run(spark)))


def test_collisions_block_nothing(spark):
    def weak(c):
        return F.length(F.lit("")) + F.xxhash64(c) % 2

    assert sorted(map(str, _run(spark, hashed=weak))) == sorted(map(str, _run(spark)))


def test_empty_list_and_empty_table(spark):
    none = spark.createDataFrame([], "entry string")
    pages = spark.createDataFrame([(1, "https://a.example.com", "", "", "", "")], SCHEMA)
    assert [r["blocked"] for r in url_filter.filter_urls(pages, none).collect()] == [False]
    assert url_filter.filter_urls(spark.createDataFrame([], SCHEMA), spark.createDataFrame([("x",)], "entry string")).count() == 0


def test_matches_a_plain_set(spark):
    urls = [(i, f"https://h{i % 40}.example.com/{i % 90}") for i in range(2000)]
    pages = spark.createDataFrame([(i, u, "", "", "", "") for i, u in urls], SCHEMA)
    entries = [f"h{i}.example.com/{i * 7 % 90}" for i in range(40)] + ["h3.example.com"]
    got = {r["page_id"]: r["blocked"] for r in url_filter.filter_urls(pages, spark.createDataFrame([(e,) for e in entries], "e string"), shard=4).collect()}
    assert got == {i: u[8:] in entries or u[8:].split("/")[0] in entries for i, u in urls}

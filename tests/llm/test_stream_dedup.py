import pytest
from pyspark.sql import functions as F

from paperloom.llm import stream_dedup
from tests.llm.util import CLASH, CLASHING, DOCS, ODD, docs


def _write(df, folder, name):
    import glob
    import shutil

    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/.{name}")
    (part,) = glob.glob(f"{folder}/.{name}/*.parquet")
    shutil.move(part, f"{folder}/{name}.parquet")
    shutil.rmtree(f"{folder}/.{name}")


ROWS = [(i, f"text {i % 7} " + "x" * (i % 7), "en", "a") for i in range(40)]


@pytest.mark.parametrize("weak", [False, True])
def test_batches_share_their_state(spark, tmp_path, weak):
    """A weak digest makes texts collide; full texts tell them apart, within a batch and across batches."""
    source, out = str(tmp_path / "in dir"), f"file://{tmp_path}/out"
    (tmp_path / "in dir").mkdir()
    hashed = (lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 2), 8, "0"))) if weak else stream_dedup.digest
    _write(docs(spark, ROWS[10:25]), source, "a")
    stream_dedup.run_stream(spark, source, out, hashed=hashed)
    _write(docs(spark, [*ROWS[:10], *ROWS[25:]]), source, "b")
    got = stream_dedup.dedup(spark, source, out, hashed=hashed)
    # the first batch comes first, and in it the smaller id
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(range(10, 17))
    keep = {r["doc_id"]: r["keep_id"] for r in stream_dedup.duplicates(spark, out).collect()}
    assert len(keep) == 33 and all(k % 7 == i % 7 and 10 <= k < 17 for i, k in keep.items())


def test_files_in_several_batches_of_one_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(4):
        _write(docs(spark, ROWS[n * 10 : n * 10 + 10]), str(tmp_path / "in"), f"p{n}")
    got = stream_dedup.dedup(spark, str(tmp_path / "in"), f"file://{tmp_path}/out", files=1).collect()
    assert sorted(r["text"] for r in got) == sorted({t[1] for t in ROWS})


def test_odd_rows_and_empty_table(spark, tmp_path):
    docs(spark, [(*r, *CLASHING) for r in [*ODD, (7, "", "en", "a")]], CLASH).write.parquet(str(tmp_path / "odd"))
    source = spark.read.parquet(str(tmp_path / "odd"))
    got = stream_dedup.dedup(spark, str(tmp_path / "odd"))
    assert got.columns == source.columns
    texts = [r["text"] for r in got.collect()]
    assert texts.count(None) == 2 and texts.count("") == 1
    assert sorted(map(str, texts)) == sorted(["None", "None", *{r["text"] for r in source.collect() if r["text"] is not None}])
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "none"))
    assert stream_dedup.dedup(spark, str(tmp_path / "none")).count() == 0


def test_a_single_file(spark, tmp_path):
    _write(docs(spark, ROWS), str(tmp_path), "one")
    assert sorted(r["doc_id"] for r in stream_dedup.dedup(spark, f"{tmp_path}/one.parquet").collect()) == list(range(7))

"""Python steps: a process each, for every task."""

import re

from pyspark.sql import functions as F

from paperloom.llm import common, packing, simhash
from tests.llm.util import docs

TABLE = [(i, f"words of document {i} " * (1 + i % 3) + f"and {i * i}\nline {i}", "en", "a") for i in range(40)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_value_is_looked_up_once(spark):
    rows = common.located(common.materialise(docs(spark, TABLE), "rows"))
    found = rows.where(f"{common.ROW}.doc_id % 4 = 1").select(F.col(common.FILE).alias("file"), F.col(common.AT).alias("at"), F.col(f"{common.ROW}.doc_id").alias("value"))
    some = common.attach(rows, found, "value").where("value IS NOT NULL").select(f"{common.ROW}.doc_id", "value", F.col("value").alias("again"))
    assert len(re.findall("ArrowEvalPython", _plan(some))) == 1
    assert sorted(map(tuple, some.collect())) == [(i, i, i) for i in range(40) if i % 4 == 1]


def test_earlier_texts_are_signed_where_they_are_looked_up(spark, monkeypatch):
    before = common.materialise(docs(spark, TABLE), "before")
    now = common.materialise(docs(spark, [(i, t if i % 5 else t.split("\n")[1], *o) for i, t, *o in TABLE]), "now")
    plans = []
    kept = simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, name: plans.append((name, _plan(df))) or kept(df, name))
    got = simhash.signed(now, before=before)
    assert [(p.count("MapInArrow"), p.count("ArrowEvalPython")) for name, p in plans if name == "simhash"] == [(2, 0)]
    # both states of a document that changed, under the place and the hash of its text that it has now
    want = {r["id"]: (r["h"], r[common.FILE], r[common.AT]) for r in simhash._texts(now).collect()}
    rows = [(r["id"], (r["h"], r[common.FILE], r[common.AT])) for r in got.collect()]
    assert sorted(i for i, _ in rows) == sorted([*range(40), *range(0, 40, 5)]) and all(want[i] == own for i, own in rows)
    sizes = sorted((r["id"], r["n"]) for r in got.collect() if r["id"] % 5 == 0)
    assert sizes == sorted((i, len(set(t.split()))) for i, full, *_ in TABLE if i % 5 == 0 for t in (full, full.split("\n")[1]))


def test_packing_makes_no_table_from_a_python_list(spark):
    assert "ExistingRDD" not in _plan(packing.pack(common.materialise(docs(spark, TABLE), "rows"), 64))

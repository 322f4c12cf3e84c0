import hashlib
import math
from collections import Counter

from paperloom.llm import mixing
from tests.llm.util import DOCS, docs, odd, rows


def _rows(n=300):
    return [(i, "w " * (1 + i % 50), "en", "abcd"[min(i % 7, 3)]) for i in range(n)]


def brute(table, weights=None, default=1.0, total=None, seed=mixing.SEED):
    tokens = Counter()
    for _, text, _, source in table:
        tokens[source] += len((text or "").split())
    w = {s: math.sqrt(t) * math.sqrt(math.sqrt(t)) if weights is None else weights.get(s, default) for s, t in tokens.items()}
    some = [s for s, t in tokens.items() if t > 0 and w[s] > 0]
    factor = max((tokens[s] / w[s] for s in some), default=0) if total is None else total / sum(w[s] for s in some)
    out = []
    for i, _, _, source in table:
        rate = w[source] * factor / tokens[source] if tokens[source] else 1.0
        u = int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:12], 16)
        out += [i] * (math.floor(rate) + (u < (rate - math.floor(rate)) * 2**48))
    return out


def test_against_brute_force(spark):
    table = _rows()
    for options in ({}, {"weights": {"a": 3.0, "b": 1.0}, "default_weight": 0.5, "total": 20_000}):
        got = sorted(r[0] for r in mixing.mix(docs(spark, table), **options).select("doc_id").collect())
        assert got == sorted(brute(table, options.get("weights"), options.get("default_weight", 1.0), options.get("total")))


def test_tokens_come_to_the_targets(spark):
    table = _rows(6000)
    out = mixing.mix(docs(spark, table), weights={"a": 2.0, "b": 1.0, "c": 1.0, "d": 4.0}, total=400_000).collect()
    got = Counter()
    for r in out:
        got[r["source"]] += len(r["text"].split())
    for s, w in {"a": 2, "b": 1, "c": 1, "d": 4}.items():
        assert abs(got[s] - 400_000 * w / 8) < 400_000 * w / 8 * 0.05


def test_nothing_is_lost_at_the_default_total(spark):
    table = _rows()
    assert {r[0] for r in mixing.mix(docs(spark, table)).select("doc_id").collect()} == {t[0] for t in table}


def test_odd_rows(spark):
    table = odd(spark)
    out = mixing.mix(table)
    assert out.columns == table.columns
    assert {r["text"] for r in out.collect()} == {r["text"] for r in table.collect()}
    assert sum(r["text"] == "the same row twice, and more words in it" for r in out.collect()) % 2 == 0


def test_empty_table_and_no_tokens(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert rows(mixing.mix(docs(spark, [(1, None, "en", "x"), (2, "", "en", "x")])), "doc_id") == [(1,), (2,)]

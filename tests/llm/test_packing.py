import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import packing
from tests.llm.util import DOCS, docs, odd


def _check(out, table, capacity):
    by_bin, by_row = defaultdict(list), defaultdict(list)
    for r in out:
        assert len(r["text"].split()) == r["n_tokens"] <= capacity
        by_bin[r["bin"]].append((r["start"], r["n_tokens"]))
        by_row[r["doc_id"]].append((r["piece"], r["text"]))
    for places in by_bin.values():
        places.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and places[-1][0] + places[-1][1] <= capacity
    whole = defaultdict(list)
    for i, text in table:
        if text and text.split():
            whole[i].append(text)
    assert set(whole) == set(by_row)
    for i, texts in whole.items():
        assert sum(len(t) for t in texts) == sum(len(t) for _, t in by_row[i])
        if len(texts) == 1:
            assert "".join(t for _, t in sorted(by_row[i])) == texts[0]
    return len(by_bin)


def test_every_token_has_one_place(spark):
    r = random.Random(3)
    table = [(i, (" \n" if i % 3 else "") + "".join(f"w{k}{r.choice([' ', chr(10), '  '])}" for k in range(int(r.expovariate(1 / 60)))), "en", "a") for i in range(800)]
    out = packing.pack(docs(spark, table), 64, 2).collect()
    n = _check(out, [t[:2] for t in table], 64)
    tokens = sum(len(t[1].split()) for t in table)
    assert n <= tokens / 64 * 1.06 + 2


def test_odd_rows_and_empty_table(spark):
    table = odd(spark)
    out = packing.pack(table, 128, 4).collect()
    _check(out, [(r["doc_id"], r["text"]) for r in table.collect()], 128)
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), min_size=1), st.integers(1, 24))
def test_knapsack_against_brute_force(counts, capacity):
    import numpy as np

    values = np.zeros(24)
    for k, n in counts.items():
        values[k - 1] = n
    got = packing.knapsack(values, capacity)
    best = [0.0] * (capacity + 1)
    for c in range(1, capacity + 1):
        best[c] = max([best[c - 1], *(best[c - k] + values[k - 1] for k in range(1, min(c, 24) + 1))])
    assert sum(k * a for k, a in got.items()) <= capacity
    assert abs(sum(values[k - 1] * a for k, a in got.items()) - best[capacity]) < 1e-9


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 300), min_size=1, max_size=12))
def test_a_plan_holds_the_counts(counts):
    used = packing.plan(counts, 32)
    got = defaultdict(int)
    for config, n in used:
        assert sum(k * a for k, a in config) <= 32
        for k, a in config:
            got[k] += a * n
    assert dict(got) == counts
    places = packing.places(used, 32)
    for k, n in counts.items():
        spans = sorted((a, b) for u, a, b, *_ in places if u == k)
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_near_the_lower_bound_at_any_size():
    r = random.Random(1)
    counts = defaultdict(int)
    for _ in range(50_000):
        counts[min(64, int(r.lognormvariate(2.3, 0.9)) + 1)] += 1
    for scale in (1, 10**6):
        scaled = {k: n * scale for k, n in counts.items()}
        x, bound = packing.solve({k: n for k, n in scaled.items() if k < 64}, 64)
        assert sum(x.values()) >= bound * 0.999
        used = packing.plan(scaled, 64)
        assert sum(n for _, n in used) <= sum(k * n for k, n in scaled.items()) / 64 * 1.003 + 1


def _fewest(lengths, capacity):
    """The least number of bins, by trying all ways."""
    best = [len(lengths)]

    def place(left, rooms):
        if len(rooms) >= best[0]:
            return
        if not left:
            best[0] = len(rooms)
            return
        for k in sorted({r: i for i, r in enumerate(rooms) if r >= left[0]}.values()):
            place(left[1:], [r - left[0] * (i == k) for i, r in enumerate(rooms)])
        place(left[1:], [*rooms, capacity - left[0]])

    place(sorted(lengths, reverse=True), [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=9))
def test_few_pieces_against_all_ways(lengths):
    counts = {k: lengths.count(k) for k in lengths}
    bins = sum(n for _, n in packing.plan(counts, 16))
    assert _fewest(lengths, 16) <= bins <= _fewest(lengths, 16) + 1


def test_the_query_against_all_ways(spark):
    r = random.Random(9)
    lengths = [r.randint(1, 40) for _ in range(9)]
    table = [(i, " ".join(["w"] * n), "en", "a") for i, n in enumerate(lengths)]
    out = packing.pack(docs(spark, table), 32, 1).collect()
    cut = [m for n in lengths for m in ([32, n - 32] if n > 32 else [n])]
    assert _fewest(cut, 32) <= _check(out, [t[:2] for t in table], 32) <= _fewest(cut, 32) + 1


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 16), st.integers(1, 500), min_size=1))
def test_best_fit_holds_the_counts(counts):
    got = defaultdict(int)
    for config, n in packing.best_fit(counts, 16):
        assert n > 0 and sum(k * a for k, a in config) <= 16
        for k, a in config:
            got[k] += a * n
    assert dict(got) == counts


def test_a_large_capacity(spark):
    table = [(i, "w " * (37 * i % 4000 + 1), "en", "a") for i in range(60)]
    _check(packing.pack(docs(spark, table), 1 << 16, 16).collect(), [t[:2] for t in table], 1 << 16)

"""That operators' work grows no faster than their input: plans, counts of expressions, and results by other ways."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.functions import markers, text
from paperloom.operators import pages, semantic, tables
from paperloom.plans import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [0, 10, 64])
def test_chunk_boxes_of_large_and_small_documents(spark, few):
    words = "alpha beta gamma delta the of relay bus".split()
    texts = [" ".join(words[(i * k + k) % 8] for k in range(1, 4 + i % 40)) for i in range(60)] + ["x" * 50, "y" * 130 + " end", ""]
    paras = [(None if i % 9 == 8 else i % 5 // 3, t, len(t), 1 + i % 3, float(i), 0.0, 1.0, 1.0) for i, t in enumerate(texts)]
    held = [(n, None if n % 9 == 8 else n % 2, f"s{texts[n]} {texts[(n * 7 + 2) % 60]} {'x' * 60}z") for n in range(40)] + [(100, 0, ""), (101, 1, None)]
    ps = spark.createDataFrame(paras, "doc int, normal string, raw_length int, page int, x_in double, y_in double, w_in double, h_in double")
    cs = spark.createDataFrame(held, "key int, doc int, normal string")
    want = sorted((k, p[3], p[4]) for k, d, c in held for p in paras if d is not None and p[0] == d and c and p[2] >= 40 and p[1][:120] in c and (len(p[1]) < 200 or p[1][100:200] in c))
    assert sorted((r["key"], r["page"], r["x_in"]) for r in pages.chunk_boxes(cs, ps, few).collect()) == want and len(want) > 20


def test_chunk_boxes_broadcasts_no_texts(spark):
    assert "BroadcastExchange" not in plan(QUERIES["chunk_boxes"](spark, SMALL))


def best_section(doc, lo, hi, sections):
    hi = max(lo if hi is None else hi, lo)
    ranks = []
    for d, idx, a, b, orphan in sections:
        if d == doc and a <= hi and b >= lo:
            n = min(b, hi) - max(a, lo) + 1
            ranks.append((0, bool(orphan), b - a, -idx, idx) if n == hi - lo + 1 else (1, bool(orphan), -n, idx, idx))
    return min(ranks, default=None)


def test_sections_of_repeated_ranges_against_brute_force(spark):
    r = random.Random(2)
    secs = [(r.randrange(3), i, (a := r.randrange(1, 20)), a + r.randrange(-1, 8), r.choice([None, True, False])) for i in range(150)]
    ents = [(i // 2 if i > 180 else i, r.choice([None, 0, 1, 2, 3]), (a := r.randrange(1, 24)), r.choice([None, a + r.randrange(-2, 9)])) for i in range(200)]
    kinds = [s for s in secs if s[2] <= s[3]]
    best = {}
    for k, d, a, b in ents:
        if (x := best_section(d, a, b, kinds)) is not None:
            best[k] = min(x, best.get(k, x))
    ents += [(None, 1, 3, 5), (500, 1, None, 4)]
    es, ss = spark.createDataFrame(ents, "key int, doc int, page int, page_to int"), spark.createDataFrame(secs, "doc int, section_idx int, page_start int, page_end int, is_orphan boolean")
    got = pages.section_for_range(es, ss, "key")
    assert got.columns == [*es.columns, "section_idx"]
    want = [(k, d, a, b, best[k][4] if k in best else None) for k, d, a, b in ents]
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, got.collect())) == order(want)


def test_sections_of_ranges_shuffle_no_pairs(spark):
    """Every pair of a range and a section lies behind one grouping of its range, none behind one of its entity and section."""
    es, ss = spark.createDataFrame([(1, 0, 3, 5)], "key int, doc int, page int, page_to int"), spark.createDataFrame([(0, 1, 1, 3, False)], "doc int, section_idx int, page_start int, page_end int, is_orphan boolean")
    keyed = [x for x in pages.section_for_range(es, ss, "key")._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate [" in x and "key#" in x.split("],")[0]]
    assert keyed == []


def test_strip_is_that_of_the_pattern(spark):
    chars = spark.range(1, 0x10000).where("id NOT BETWEEN 55296 AND 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c")).select(F.concat("c", "c", F.lit("x \n"), "c", F.lit("y"), "c", F.lit("\n")).alias("t"))
    by_pattern = F.regexp_replace("t", "(?dU)^\\s+|\\s+$", "")
    assert chars.where(text.strip(F.col("t")) != by_pattern).count() == 0 and chars.where(text.strip(F.col("t")) != F.col("t")).count() == 65536 - 2048 - 1


def test_patterns_find_the_same_behind_their_heads(spark):
    said = "See ſection 4.1, SECTION 5-2, §6 and xSec. 7; FIGURE 3 fig. 4-2 Fig7 refig 3 éfig 3; Table A-1 tbl 4 stable 3; EQ. 1.2 eq 3; Pages 3, p. A-1 PP. 9; GE-THQL-1 aGE-TX1 ÉGE-T1; WARNING: hot caution – wet xNote: no note: yes\nDANGER: x\nNotice - y"
    df = spark.createDataFrame([(said + "\n" + said[::-1],)], "t string")
    for p in text.HEADS:
        for g in (0, 1):
            if g <= re.compile(p).groups:
                a, b = df.select(F.regexp_extract_all("t", text.pattern(p), F.lit(g)), F.regexp_extract_all("t", F.lit(text.U + p), F.lit(g))).first()
                assert a == b and a, p


@pytest.mark.parametrize(
    ("most", "make"),
    [
        (60, lambda t: markers.page_span(t, F.concat(t, t), F.lit(3))),
        (12, text.strip_running),
        (40, text.printed_label),
        (12, text.is_toc_like),
        (25, None),
    ],
)
def test_expressions_are_computed_once(spark, most, make):
    """How often the plan has the patterns of an operator: named again, an expression runs again, and within its own, that often more."""
    df = spark.createDataFrame([("x",)], "chunk string")
    blank = [F.lit("").alias(c) for c in ("source_file", "header_1", "header_2", "header_3", "printed_page_label", "figure_ref", "table_ref")]
    out = semantic.semantic_text(df.select("chunk", *blank)) if most == 25 else df.select(make(F.col("chunk")).alias("x"))
    assert len(re.findall(r"\(\?dU\)", out._jdf.queryExecution().optimizedPlan().toJSON())) <= most


def test_lines_end_where_the_pattern_says(spark):
    ends = ["\r\n", *"\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"]
    df = spark.createDataFrame([("".join(f" w{i}{a}v{i} {b}" for i, a in enumerate(ends) for b in ends) + "x\r\r\n\n\ry\u2027z",), ("",), (None,)], "t string")
    by_pattern = F.filter(F.transform(F.split("t", "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"), text.strip), lambda x: x != "")
    assert [r[0] for r in df.select(text.lines(F.col("t"))).collect()] == [r[0] for r in df.select(by_pattern).collect()]


def test_grids_against_brute_force(spark):
    r = random.Random(9)
    cells = [(r.choice([None, *range(12)]), r.choice([None, *range(30)]), r.choice([None, *range(-1, 6)]), r.randrange(-1, 5), r.choice([None, 0, 1, 3]), r.choice([None, 1, 2, 9]), r.choice([None, "", f"v{i}", "a|b\nc"]), *((9000, 4) if i % 40 == 0 else (5, 4))) for i in range(200)]
    cells = [c for c in cells if c[0] is None or c[0] % 6 or c[7] == 5]  # a table of 9000 rows beside those of 5 only by itself
    cells = [(*c[:7], 9000, 4) if c[0] == 6 else (*c[:7], 5, 4) for c in cells] + [(50, 1, 9, 9, 1, 1, "outside", 5, 4)]
    at, low = {}, lambda x: (x is not None, x)
    for t, pos, row, col, rs, cs, text_, rows, cols in cells:
        if t is not None and row is not None and rows <= tables.MAX_ROWS:
            for y in range(row, row + max(1 if rs is None else rs, 1)):
                for x in range(col, col + max(1 if cs is None else cs, 1)):
                    if 0 <= y < rows and 0 <= x < cols:
                        now = (low(pos), low(text_))
                        at.setdefault(t, {})[y, x] = max(now, at.get(t, {}).get((y, x), now))
    show = lambda v: " ".join((v[1][1] or "").split("\n")).replace("|", "\\|") if v else ""
    want = {t: [[show(g.get((y, x))) for x in range(4)] for y in range(5)] for t, g in at.items()}
    df = spark.createDataFrame(cells, "table_id int, pos int, r int, c int, rs int, cs int, text string, rows int, cols int")
    assert {x["table_id"]: x["grid"] for x in tables.grids(df).collect()} == want and len(want) > 8
    assert plan(tables.grids(df)).count("Exchange hashpartitioning") == 1


def test_no_sketch_for_each_user(spark):
    """The estimate's buffers stand in aggregates by type alone."""
    out = QUERIES["ext_approx_distinct"](spark, SMALL)
    by_user = [x for x in plan(out).split("\n") if "Aggregate(keys=[" in x and "user_id" in x.split("]")[0]]
    assert by_user and not any("approx_count_distinct" in x for x in by_user)

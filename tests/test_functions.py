"""Golden cases of the column functions, Unicode ones among them, which the SQL that checks queries can't cover."""

import pytest
from pyspark.sql import functions as F

from paperloom.functions import ids, markers, text


@pytest.fixture(scope="module")
def call(spark):
    def run(f, *args):
        row = spark.createDataFrame([tuple(args)], ", ".join(f"a{i} {'int' if isinstance(a, int) and not isinstance(a, bool) else 'string'}" for i, a in enumerate(args)))
        return row.select(f(*[F.col(f"a{i}") for i in range(len(args))]).alias("x")).first()["x"]

    return run


def test_figure_keys(call):
    for ref, key in {"Figure 18.117": "18117", "Fig 18-117": "18117", "Figure 18—117": "18117", "FIG. 4.2": "42", "Figure A-1": "a1", "": "", "  ": ""}.items():
        assert call(text.figure_key, ref) == key
    assert call(text.figure_key, None) == ""


def test_dates(call):
    for t, d in {"March 26, 2024": "2024-03-26", "Issue date: March 2024": "2024-03", "2024/3/7": "2024-03-07", "Sept 5 2023": "2023-09-05", "May 2020": "2020-05", "none": "", "": ""}.items():
        assert call(text.parse_date, t) == d
    assert call(text.revision, "Revision: 5.02.") == "5.02" and call(text.document_number, "Document No. MX-IRES-001") == "MX-IRES-001"


def test_references(call):
    t = "See Figure 4-2. and fig 7, FIGURE A-1; Figures none. Table 18-3, Tbl. 4 Section 18.4, § 19.3 and Intersection 4. pages 18-25, p. A-7. Eq. 18.3"
    assert call(text.figure_refs, t) == ["Fig 7", "Figure 4-2", "Figure A-1"]
    assert call(text.table_refs, t) == ["Table 18-3", "Table 4"]
    assert call(text.section_refs, t) == ["18.4", "19.3", "4"]
    assert call(text.page_refs, t) == ["18-25", "A-7"]
    assert call(text.equation_refs, t) == ["Equation 18.3"]
    assert call(text.equipment_ids, "GE-THQL-1120-2, ABB-VD4-1250 and GE-THQL-1120-2, NEMA-style") == ["ABB-VD4-1250", "GE-THQL-1120-2"]
    assert call(text.figure_refs, None) == []


def test_callouts(call):
    t = "WARNING: hot\nDanger - high voltage\ncaution: wet\nNOTICE – read\nNote: x\nWARNING: hot\nCAUTION:  \n"
    assert call(text.callouts, t)[:5] == ["WARNING: hot", "DANGER: high voltage", "CAUTION: wet", "NOTICE: read", "NOTE: x"]
    assert call(text.callout_kinds, t) == ["CAUTION", "DANGER", "NOTE", "NOTICE", "WARNING"]
    assert call(text.callouts, "none") == []


def test_highlight(call):
    t = '# Head\n- item **bold** and *it*  <!-- PageNumber="3" -->hyphen-\nated “q”… é­​ x 2 * 3'
    out = call(text.highlight_text, t)
    assert out == 'Head item bold and it hyphenated "q"... é x 2 * 3'
    assert call(text.highlight_text, out) == out
    assert call(text.highlight_text, None) == "" and len(call(text.highlight_text, "x" * 5000)) == 2000


def test_headers_and_captions(call):
    assert call(text.norm_header, "CHAPTER 5  —  Meters.") == call(text.norm_header, "Chapter 5 - Meters")
    section = "Intro of the part. Figure 4-2 - Bar Type CT shows it. More text."
    out = call(lambda s, a: text.surrounding_text(s, a, 10), section, "Figure 4-2 — Bar Type CT")
    assert "[...]" in out and out.startswith("the part.") and out.endswith("shows it.")
    assert call(lambda s, a: text.surrounding_text(s, a, 5), "abcdefghijklmnop", "") == "abcdefghij"


def test_running_lines(call):
    t = "Page 215\nbody\n1\nGE-THQL-1120-2\nMarch 2024 in the middle\nmore\nlast\nMarch 2024"
    out = call(text.strip_running, t).split("\n")
    assert "Page 215" not in out and "March 2024" not in out and "1" in out and "GE-THQL-1120-2" in out


def test_classes(call):
    toc = "\n".join(f"Part {i} ........ 18-{i}" for i in range(6))
    tabbed = "\n".join(f"Chapter title {i}\t\t{i}" for i in range(6))
    index = "\n".join(f"Breaker, kind {i} . 18-3, 18-{i}" for i in range(6))
    assert call(text.is_toc_like, toc) and call(text.is_toc_like, tabbed) and call(text.is_toc_like, index)
    assert not call(text.is_toc_like, "\n".join(f"This line speaks of figure {i} in prose." for i in range(9))) and not call(text.is_toc_like, None)
    assert call(lambda t, h: text.is_glossary(t, h), "x", "Glossary") and call(lambda t, h: text.is_glossary(t, h), "Bus: a bar\nCT: a coil\nPT: another", "")
    assert not call(lambda t, h: text.is_glossary(t, h), "Bus: a bar", None)
    assert call(text.detect_language, "This is the text of a manual and it is for all") == "en"
    assert call(text.detect_language, "En el manual de las partes que son para los motores") == "es"
    assert call(text.detect_language, "short") == "" and call(text.detect_language, None) == ""


def test_labels(call):
    for t, label in {"Page 12": "12", "this page refers to that": None, "body\n3-4": "3-4", "body\niv": "iv", '<!-- PageNumber="9" -->\nPage A-7': "A-7", "TOC 3": "TOC-3", "see A-12 there": "A-12", "": None}.items():
        assert call(text.printed_label, t) == label
    assert call(text.is_valid_label, "18.33") and not call(text.is_valid_label, "Cover")


def test_ids(call):
    assert call(ids.safe_int, "12") == 12 and call(ids.safe_int, "") is None and call(ids.safe_int, "x") is None and call(ids.safe_str, None) == ""
    assert call(ids.parent_id, "a%20b.pdf", "") == call(ids.parent_id, "a b.pdf", "") and len(call(ids.parent_id, None, None)) == 16
    same = lambda t: call(lambda p, o, x: ids.text_chunk_id(p, o, x), "p", 1, t)
    assert same("one") != same("two") and same("one") == same("one")
    for a, b, n in (("0" * 16, "0" * 16, 0), ("0" * 16, "0" * 15 + "1", 1), ("f" * 16, "0" * 16, 64), ("", "0" * 16, 64), ("xyz", "0" * 16, 64), (None, "0" * 16, 64)):
        assert call(ids.phash_distance, a, b) == n
    assert call(ids.image_hash, "") == "noimage" and len(call(ids.image_hash, "not base64!")) == 64


BREAK = "<!-- PageBreak -->"
SECTION = f"first page text {BREAK} second page text {BREAK} third"


def test_page_spans(call):
    span = lambda c, s, p: tuple(call(markers.page_span, c, s, p))
    assert span("text " + BREAK + " second", SECTION, 5) == (5, 6, [5, 6])
    assert span(SECTION, SECTION, 5) == (5, 7, [5, 6, 7])
    assert span("first page text " + BREAK, SECTION, 5) == (5, 5, [5])
    assert span('x <!-- PageNumber="8" -->', "", 6) == (6, 8, [6, 7, 8])
    assert span("x " + BREAK, "", 6) == (6, 7, [6, 7]) and span("x", "", 6) == (6, 6, [6]) and span("", SECTION, 6) == (6, 6, [6])
    assert span('elsewhere <!-- PageNumber="3" --> and <!-- PageNumber="4" -->', SECTION, 5) == (3, 4, [3, 4])
    assert call(lambda c, s: markers.page_span(c, s, F.lit(None).cast("int")), "x", "x").first is None
    assert [tuple(e) for e in call(lambda t, p: markers.timeline(t, p), f'é {BREAK}<!-- PageNumber="iv" --><!-- PageNumber="9" -->', 2)] == [(0, 2), (20, 3), (67, 9)]
    assert call(markers.last_page_part, f"a{BREAK}b") == "b" and call(markers.last_page_part, "abcd") == "cd"

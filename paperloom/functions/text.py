"""Text functions: normalising, references, callouts, labels, classes of chunks, dates. Columns in, columns out.

Patterns keep to what both Java's and RE2's syntax have, so that the SQL that checks them can use the same; ``U`` adds
what Java needs to treat letters and blanks as Unicode does, and a line feed as the only end of a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

U = "(?dU)"
#: What ``\\s`` is with ``U``.
WHITE = "\t\n\x0b\x0c\r \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: The ends of lines beside the line feed.
ENDS = ("\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")

#: The identifier of a figure, table or equation: some letters, then a digit and what clings to it.
REF_ID = "([A-Z]{0,3}[-.]?\\d[\\w.-]{0,8})"
FIGURE = f"(?i)\\b(Fig(?:ure|\\.)?)\\s*[-:]?\\s*{REF_ID}"
TABLE = f"(?i)\\b(T(?:able|bl\\.?))\\s*[-:]?\\s*{REF_ID}"
EQUATION = f"(?i)\\b(Eq(?:uation|\\.)?)\\s*[-:]?\\s*{REF_ID}"
SECTION = "(?i)(?:Sec(?:tion|\\.)?|§)\\s*(\\d+(?:[-.]\\d+){0,3})\\b"
PAGE = f"(?i)\\b(?:pages?|pp?\\.?)\\s+{REF_ID}"
CALLOUT = "(?i)\\b(DANGER|WARNING|CAUTION|NOTICE|NOTE)\\b[\\s:–—-]+([^\\n]{1,200})"
_ALNUM = "[0-9A-Z]"
#: Letters, then groups after hyphens, the last of which has a digit; bounded, so that matching stays linear.
EQUIPMENT = f"\\b[A-Z]{{2,5}}-(?:{_ALNUM}{{1,8}}-){{0,3}}{_ALNUM}{{0,8}}\\d[0-9A-Z-]{{0,8}}\\b"
NUMBER_MARKER = '(?i)<!--\\s*PageNumber\\s*=\\s*"([^"]*)"\\s*-->'
BREAK_MARKER = "(?i)<!--\\s*PageBreak\\s*-->"
MARKER = '(?i)<!--\\s*Page(?:Number\\s*=\\s*"[^"]*"|Break)\\s*-->'


#: The characters that a match begins with. Word boundaries of Unicode are dear, so they are only looked for before these.
HEADS = {FIGURE: "fF", TABLE: "tT", EQUATION: "eE", SECTION: "sSſ§", PAGE: "pP", CALLOUT: "dDwWcCnN", EQUIPMENT: "A-Z"}


def pattern(p: str) -> Column:
    return F.lit(U + (f"(?=[{HEADS[p]}])" if p in HEADS else "") + p)


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.btrim(text, F.lit(WHITE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body of a value that is computed once. An expression that is named several times, or in a function of the elements of an array, is
    computed as often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines(text: Column) -> Column:
    """The lines that aren't blank, stripped. Plain replacements and a plain split are faster than a pattern."""
    for end in ENDS:
        text = F.replace(text, F.lit(end), F.lit("\n"))
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def clean_ref(ref: Column) -> Column:
    return F.regexp_replace(ref, "[.,;:-]+$", "")


def _refs(text: Column, p: str, group: int, make=lambda c: c) -> Column:
    found = F.transform(F.regexp_extract_all(text, pattern(p), F.lit(group)), clean_ref)
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(F.filter(found, lambda x: x != ""), make))), F.array().cast("array<string>"))


def figure_refs(text: Column) -> Column:
    """Labels like 'Figure 4-2' and 'Fig. 3', sorted, each once."""
    kinds = F.regexp_extract_all(text, pattern(FIGURE), F.lit(1))
    found = F.zip_with(kinds, F.regexp_extract_all(text, pattern(FIGURE), F.lit(2)), lambda k, r: F.concat(F.initcap(k), F.lit(" "), clean_ref(r)))
    return F.coalesce(F.array_sort(F.array_distinct(found)), F.array().cast("array<string>"))


def table_refs(text: Column) -> Column:
    return _refs(text, TABLE, 2, lambda r: F.concat(F.lit("Table "), r))


def equation_refs(text: Column) -> Column:
    return _refs(text, EQUATION, 2, lambda r: F.concat(F.lit("Equation "), r))


def section_refs(text: Column) -> Column:
    return _refs(text, SECTION, 1)


def page_refs(text: Column) -> Column:
    return _refs(text, PAGE, 1)


def equipment_ids(text: Column) -> Column:
    return _refs(text, EQUIPMENT, 0)


NOT_ALNUM = "[^0-9A-Za-z]+"


def figure_key(ref: Column) -> Column:
    """What figure references are joined on: the identifier without its separators, in lower case."""
    bare = F.regexp_replace(F.coalesce(ref, F.lit("")), "(?i)\\bfig(?:ure)?\\.?\\s*[-:]?\\s*", "")
    return F.lower(F.regexp_replace(bare, NOT_ALNUM, ""))


def callouts(text: Column) -> Column:
    """'KEYWORD: what follows on the line', in the order of the text, each once."""
    kinds = F.regexp_extract_all(text, pattern(CALLOUT), F.lit(1))
    tails = F.regexp_extract_all(text, pattern(CALLOUT), F.lit(2))
    both = F.zip_with(kinds, tails, lambda k, t: F.when(strip(t) != "", F.concat(F.upper(k), F.lit(": "), strip(t))))
    return F.coalesce(F.array_distinct(F.array_compact(both)), F.array().cast("array<string>"))


def callout_kinds(text: Column) -> Column:
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, pattern(CALLOUT), F.lit(1)), F.upper))), F.array().cast("array<string>"))


def without_markers(text: Column) -> Column:
    return F.regexp_replace(text, U + MARKER, "")


# -- normalising --

_QUOTES = dict.fromkeys("‘’‚‛′", "'") | dict.fromkeys("“”„‟″", '"')
_DASHES = dict.fromkeys("–—−", "-")
_BLANKS = dict.fromkeys("\u00a0\u202f", " ")
_DROPPED = "\u200b\u200c\u200d\ufeff\u00ad"


def _translate(text: Column, table: dict[str, str], dropped: str = "") -> Column:
    return F.translate(text, "".join(table) + dropped, "".join(table.values()))


def plain(text: Column) -> Column:
    """The characters of typography as those of a keyboard; invisible ones dropped."""
    return F.replace(_translate(text, _QUOTES | _DASHES | _BLANKS, _DROPPED), F.lit("…"), F.lit("..."))


@F.pandas_udf(T.StringType())
def nfc(text):  # type: ignore[no-untyped-def]
    """Canonical composition, which no built-in function does."""
    import unicodedata

    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def highlight_text(text: Column, limit: int = 2000, compose: bool = True) -> Column:
    """Text that a viewer's search finds: no markers, markup, line-end hyphens or runs of blanks; at most ``limit``
    characters. Doing it twice changes nothing more. Null gives ''."""
    t = without_markers(F.coalesce(text, F.lit("")))
    t = plain(nfc(t) if compose else t)
    t = F.regexp_replace(t, f"{U}(\\w+)-\\s*\\n\\s*([a-z])", "$1$2")
    t = F.regexp_replace(t, f"{U}(?m)^\\s*#{{1,6}}\\s*", "")
    t = F.regexp_replace(t, f"{U}(?m)^\\s*[*+-]\\s+", "")
    t = F.regexp_replace(t, "\\*\\*([^*\\n]{1,500}?)\\*\\*", "$1")
    t = F.regexp_replace(t, "(?<!\\*)\\*(?!\\*)([^*\\n]{1,500}?)(?<!\\*)\\*(?!\\*)", "$1")
    t = strip(F.regexp_replace(t, f"{U}\\s+", " "))
    return F.substring(F.regexp_replace(t, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", ""), 1, limit)


def normalize_text(text: Column) -> Column:
    """Letters and digits of ASCII in lower case, one blank between: for comparing renderings of the same content."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), "(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, "(?m)^\\s*#{1,6}\\s*", " ")
    t = F.regexp_replace(t, "(?m)^\\s*[*+-]\\s+", " ")
    return F.lower(F.trim(F.regexp_replace(t, NOT_ALNUM, " ")))


def norm_header(text: Column) -> Column:
    t = F.lower(strip(F.regexp_replace(F.coalesce(text, F.lit("")), f"{U}[\\s\u00a0]+", " ")))
    return F.regexp_replace(F.regexp_replace(t, "[–—―-]+", "-"), "[.,:;]+$", "")


def caption_form(text: Column) -> Column:
    table = dict.fromkeys("\u00a0\u2002\u2003\u2009", " ") | dict.fromkeys("‐‑‒–—―", "-") | dict.fromkeys("‘’", "'") | dict.fromkeys("“”", '"')
    return F.regexp_replace(_translate(F.coalesce(text, F.lit("")), table, "\u200b\u00ad"), f"{U}\\s+", " ")


# -- running headers and footers, inline tables --

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Each month's name, or its first three letters ('sept' as well).
MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if m != "september" else "sept?(?:ember)?" for m in MONTHS if m != "may") + "|may"
_STAMPS = (
    "page\\s+\\d+(?:\\s+of\\s+\\d+)?",
    "(?:rev(?:ision)?|ver(?:sion)?|issue)\\.?\\s*\\d+(?:\\.\\d+)*(?:[\\s–—-].*)?",
    "(?:©|\\(c\\)|copyright)\\s.*",
    "(?:proprietary|confidential|do\\s+not\\s+distribute|internal\\s+use\\s+only)\\.?",
    f"(?:{MONTH})\\s+\\d{{4}}",
    "\\d{4}[/-]\\d{1,2}[/-]\\d{1,2}",
    "\\d{1,2}[/-]\\d{1,2}[/-]\\d{2,4}",
)
STAMP = f"(?i)\\A(?:{'|'.join(_STAMPS)})\\z"


def _block_without_stamps(block: Column) -> Column:
    def kept(ls: Column) -> Column:
        return F.array_join(F.filter(ls, lambda x, i: ~(((i < 2) | (i >= F.size(ls) - 2)) & x.rlike(U + STAMP))), "\n")

    return let(lines(block), kept)


def strip_running(text: Column) -> Column:
    """Without the headers and footers of pages: stamps in the first and last two lines of each block between markers."""
    parts = F.transform(F.split(text, U + MARKER), _block_without_stamps)
    return F.array_join(F.filter(parts, lambda p: p != ""), "\n")


TABLE_NOTE = "\n[Table left out here; it has records of its own]\n"


def strip_inline_tables(text: Column) -> Column:
    """Pipe tables and HTML tables, and runs of two or more stray rows or cells, give way to a note."""
    return let(text, lambda x: F.when(F.contains(x, F.lit("|")) | F.contains(x, F.lit("<")), _noted(x)).otherwise(x))


def _noted(text: Column) -> Column:
    t = F.regexp_replace(text, "(?:^|\\n)\\|[^\\n]+\\|\\s*\\n\\|\\s*[-:|\\s]+\\|\\s*\\n(?:\\|[^\\n]+\\|\\s*\\n?)+", TABLE_NOTE)
    t = F.regexp_replace(t, "(?is)<table.*?</table\\s*>", TABLE_NOTE)
    part = "t(?:[rdh]|head|body|foot)"
    return F.regexp_replace(t, f"(?is)(?:<{part}[^>]*>.*?</{part}\\s*>\\s*){{2,}}", TABLE_NOTE)


def surrounding_text(section: Column, anchor: Column, chars: int = 200) -> Column:
    """What stands around the anchor in the section; found as it stands, else in the caption form, else by its first 40
    characters, if it has 20; or else the section's head."""
    cleaned = strip_running(F.coalesce(section, F.lit("")))
    a = strip(F.coalesce(anchor, F.lit("")))

    def around(s: Column, x: Column) -> Column:
        at = F.call_function("locate", x, s)
        start = F.greatest(at - chars, F.lit(1))
        before = F.call_function("substring", s, start, at - start)
        after = F.call_function("substring", s, at + F.length(x), F.lit(chars))
        return F.when((x != "") & (at > 0), strip(F.concat(strip(before), F.lit(" [...] "), strip(after))))

    folded, folded_anchor = caption_form(cleaned), strip(caption_form(a))
    probe = F.substring(folded_anchor, 1, 40)
    at = F.call_function("locate", probe, folded)
    start = F.greatest(at - chars, F.lit(1))
    by_probe = F.when((F.length(probe) >= 20) & (at > 0), strip(F.call_function("substring", folded, start, at - start + F.length(probe) + chars)))
    return F.coalesce(around(cleaned, a), around(folded, folded_anchor), by_probe, strip(F.substring(cleaned, 1, 2 * chars)))


# -- classes of chunks --

LEADER = "^.{4,200}?(?:\\.\\s*){3,}\\s*[\\dA-Z][\\w.-]{0,8}\\s*$"
POINTER = "^.{4,}?\\s+[A-Z]?\\d[\\w.-]{0,8}(?:\\s*,\\s*[A-Z]?\\d[\\w.-]{0,8})*\\s*$"


def is_toc_like(text: Column) -> Column:
    """Five lines or more, of which five, and 60 %, lead to a page."""

    def leads(ls: Column) -> Column:
        hits = lambda p: F.size(F.filter(ls, lambda x: x.rlike(U + p)))
        return (F.size(ls) >= 5) & let(F.greatest(hits(LEADER), hits(POINTER)), lambda most: (most >= 5) & (most * 10 >= F.size(ls) * 6))

    return let(lines(F.coalesce(text, F.lit(""))), leads)


GLOSSARY_HEADER = "(?i)\\b(?:glossary|terminology|nomenclature|definitions?|acronyms?|abbreviations?)\\b"
GLOSSARY_LINE = "(?m)^\\s*[A-Z][\\w &()/.,'-]{1,40}\\s*[:–—-]\\s+\\S"


def is_glossary(text: Column, *headers: Column) -> Column:
    by_header = F.lit(False)
    for h in headers:
        by_header = by_header | F.coalesce(h, F.lit("")).rlike(U + GLOSSARY_HEADER)
    return by_header | (F.regexp_count(F.coalesce(text, F.lit("")), pattern(GLOSSARY_LINE)) >= 3)


STOPWORDS = {"en": "and for is of the with".split(), "es": "el la las los para que".split(), "fr": "avec des la le les pour".split()}


def detect_language(text: Column) -> Column:
    """By stop words in the first 500 characters; ties go to English, then Spanish; '' where there are none or under 30 characters."""
    sample = F.lower(F.substring(text, 1, 500))
    n = {k: sum((F.contains(sample, F.lit(f" {w} ")).cast("int") for w in ws), F.lit(0)) for k, ws in STOPWORDS.items()}
    best = F.greatest(*n.values())
    return F.when(F.coalesce(F.length(text), F.lit(0)) < 30, "").when(best == 0, "").when(n["en"] == best, "en").when(n["es"] == best, "es").otherwise("fr")


METHOD_WEIGHT = {"di_input": 300, "header_match": 300, "bbox_corrected": 250, "fuzzy_match": 200, "paragraph_bbox": 200, "document_summary": 200, "missing": 0}


def quality_score(method: Column, length: Column, has_headers: Column, toc: Column, has_callouts: Column, has_refs: Column) -> Column:
    """In thousandths inside, so that no rounding differs; between 0 and 1."""
    w = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in METHOD_WEIGHT.items() for x in kv]), method), F.lit(100))
    points = w + F.when(has_headers, 200).otherwise(0) + F.when(length.between(200, 3000), 200).when(length.between(100, 199), 100).otherwise(0)
    points = points + F.when(has_callouts, 100).otherwise(0) + F.when(has_refs, 100).otherwise(0) - F.when(toc, 300).otherwise(0)
    return F.least(F.greatest(points, F.lit(0)), F.lit(1000)) / F.lit(1000.0)


def guess_category(caption: Column, around: Column) -> Column:
    t = F.lower(F.concat_ws(" ", F.coalesce(caption, F.lit("")), F.coalesce(around, F.lit(""))))
    ladder = (
        ("schematic_wiring", "schematic|circuit|wiring diagram|(?:single|one)[- ]line"),
        ("nameplate", "name ?plate|(?:rating|label|data) plate"),
        ("block_flow", "p ?& ?id|(?:block|flow|logic) diagram|control logic|process flow"),
        ("parts_exploded", "exploded view|parts (?:list|diagram)|assembly drawing|call-?outs"),
    )
    out = F.when(F.lit(False), "")
    for name, p in ladder:
        out = out.when(t.rlike(p), name)
    return out.otherwise("default")


# -- dates, revisions, numbers --

ISO_DATE = "\\b(\\d{4})[/-](\\d{1,2})[/-](\\d{1,2})\\b"
DAY_DATE = f"(?i)\\b({MONTH})\\s+(\\d{{1,2}}),?\\s+(\\d{{4}})\\b"
MONTH_DATE = f"(?i)\\b({MONTH})\\s+(\\d{{4}})\\b"
REVISION = "(?i)\\b(?:issue|ver(?:sion)?|rev(?:ision)?)\\.?\\s*[:-]?\\s*([A-Z0-9][\\w.-]{0,15})"
DOC_NUMBER = "(?i)\\b(?:doc(?:ument)?\\s*(?:number|no\\.?|#)|publication\\s*(?:number|no\\.?))\\s*[:-]?\\s*([A-Z0-9][\\w-]{2,30})"


def parse_date(text: Column) -> Column:
    """'YYYY-MM-DD' or 'YYYY-MM' of the first date of the most exact kind; '' for none."""
    get = lambda p, g: F.regexp_extract(F.coalesce(text, F.lit("")), U + p, g)
    month = lambda name: F.element_at(F.create_map(*[x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m[:3]), F.lit(f"{i:02}"))]), F.substring(F.lower(name), 1, 3))
    two = lambda d: F.lpad(d, 2, "0")
    return (
        F.when(get(ISO_DATE, 1) != "", F.concat_ws("-", get(ISO_DATE, 1), two(get(ISO_DATE, 2)), two(get(ISO_DATE, 3))))
        .when(get(DAY_DATE, 1) != "", F.concat_ws("-", get(DAY_DATE, 3), month(get(DAY_DATE, 1)), two(get(DAY_DATE, 2))))
        .when(get(MONTH_DATE, 1) != "", F.concat_ws("-", get(MONTH_DATE, 2), month(get(MONTH_DATE, 1))))
        .otherwise("")
    )


def revision(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), U + REVISION, 1), "[.,;:]+$", "")


def document_number(text: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), U + DOC_NUMBER, 1), "[.,;:]+$", "")


# -- printed page labels --

ROMAN = "[ivxlcdm]+"
VALID_LABEL = f"(?i)\\A(?:{ROMAN}|[A-Z]{{0,4}}[.-]?\\d{{1,4}}(?:[.-]\\d{{1,4}}){{0,2}})\\z"


def is_valid_label(label: Column) -> Column:
    return strip(F.coalesce(label, F.lit(""))).rlike(U + VALID_LABEL)


def candidate_lines(text: Column) -> Column:
    """The first and the last three lines; of few lines, some twice."""
    ls = lines(without_markers(F.coalesce(text, F.lit(""))))
    return let(ls, lambda x: F.concat(F.slice(x, 1, 3), F.slice(x, F.greatest(F.size(x) - 2, F.lit(1)), F.lit(3))))


def printed_label(text: Column) -> Column:
    """The page label that a text seems to carry, by falling certainty of its form; null for none."""
    return let(candidate_lines(text), _label_of)


def _label_of(cand: Column) -> Column:
    get = lambda p, g=1: F.transform(cand, lambda x: F.regexp_extract(x, U + p, g))
    first = lambda found, ok=is_valid_label: F.get(F.filter(found, lambda x: (x != "") & ok(x)), F.lit(0))
    listing = "(?i)\\b(App|Fig|Form|Index|Table|TOC)[-\\s]?(\\d{1,4})\\b"
    dashes = "[–—\\s-]*"
    return F.coalesce(
        first(get("(?i)\\bpage\\s+([A-Za-z0-9.-]{1,8})\\b")),
        first(F.zip_with(get(listing, 1), get(listing, 2), lambda a, b: F.when(a != "", F.concat(F.upper(a), F.lit("-"), b)).otherwise(""))),
        first(get("\\b([A-Z]{1,3}[.-]\\d{1,4})\\b")),
        first(get(f"^{dashes}([A-Za-z]{{1,3}}[.-]\\d{{1,4}}|\\d{{1,4}}(?:[.-]\\d{{1,4}})?){dashes}$")),
        F.lower(first(F.transform(cand, lambda x: F.regexp_extract(x, "(?i)\\A([ivxlcdm]{1,6})\\z", 1)))),
    )

"""Page markers in texts: where they end, which page holds where, and the pages of a chunk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import BREAK_MARKER, MARKER, NUMBER_MARKER, U, let, pattern, strip, without_markers


def marker_ends(text: Column) -> Column:
    """array<struct<off, marker>>: each marker and the 0-based offset at which it ends, rebuilt from the pieces between."""
    parts = F.split(text, U + MARKER, -1)
    marks = F.regexp_extract_all(text, pattern(MARKER), F.lit(0))
    start = F.struct(F.lit(0).alias("off"), F.array().cast("array<struct<off:int,marker:string>>").alias("out"))
    step = lambda acc, x: F.struct((acc["off"] + F.length(x["part"]) + F.length(x["mark"])).alias("off"), F.concat(acc["out"], F.array(F.struct((acc["off"] + F.length(x["part"]) + F.length(x["mark"])).alias("off"), x["mark"].alias("marker")))).alias("out"))
    pairs = let(marks, lambda ms: F.zip_with(F.slice(parts, F.lit(1), F.size(ms)), ms, lambda p, m: F.struct(p.alias("part"), m.alias("mark"))))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def marker_label(marker: Column) -> Column:
    return strip(F.regexp_extract(marker, U + NUMBER_MARKER, 1))


def timeline(text: Column, first_page: Column) -> Column:
    """array<struct<off, page>>: a whole number sets the page from the end of its marker on, a break adds one."""
    entry = lambda off, page: F.struct(off.cast("int").alias("off"), page.cast("int").alias("page"))
    begin = F.array(entry(F.lit(0), first_page))

    def step(acc: Column, m: Column) -> Column:
        now = F.element_at(acc, -1)["page"]
        by_number = let(marker_label(m["marker"]), lambda label: F.when(label.rlike("^[0-9]+$"), F.concat(acc, F.array(entry(m["off"], label.try_cast("int"))))).otherwise(acc))
        return F.when(m["marker"].rlike(U + BREAK_MARKER), F.concat(acc, F.array(entry(m["off"], now + 1)))).otherwise(by_number)

    return F.aggregate(marker_ends(F.coalesce(text, F.lit(""))), begin, step)


def page_at(line: Column, offset: Column) -> Column:
    """The page of the last entry that isn't behind the offset."""
    return F.coalesce(F.element_at(F.filter(line, lambda e: e["off"] <= offset), -1)["page"], F.get(line, F.lit(0))["page"])


def pages_between(line: Column, start: Column, end: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(F.array(page_at(line, start)), _inside(line, start, end))))


def _inside(line: Column, start: Column, end: Column) -> Column:
    return F.transform(F.filter(line, lambda e: e["off"].between(start, end)), lambda e: e["page"])


def locate_chunk(chunk: Column, section: Column) -> Column:
    """0-based offset of the chunk in the section, found in full or by its first 200 characters without markers; -1 for none."""
    find = lambda x: F.call_function("locate", x, section) - 1
    by_probe = let(strip(F.substring(without_markers(chunk), 1, 200)), lambda probe: F.when(probe != "", find(probe)).otherwise(-1))
    return let(find(chunk), lambda at: F.when(at >= 0, at).otherwise(by_probe))


def trim_markers(chunk: Column) -> Column:
    return F.regexp_replace(chunk, f"{U}(?:\\s*{MARKER}\\s*)+\\z", "")


def whole_numbers(text: Column) -> Column:
    labels = F.transform(F.regexp_extract_all(text, pattern(NUMBER_MARKER), F.lit(1)), strip)
    return F.transform(F.filter(labels, lambda x: x.rlike("^[0-9]+$")), lambda x: x.try_cast("int"))


def page_span(chunk: Column, section: Column, first_page: Column) -> Column:
    """struct<first, last, pages> of a chunk, from the section that holds it and the page that this starts on."""
    chunk, section = F.coalesce(chunk, F.lit("")), F.coalesce(section, F.lit(""))
    span = lambda lo, hi, pages=None: F.struct(lo.cast("int").alias("first"), hi.cast("int").alias("last"), (pages if pages is not None else F.sequence(lo.cast("int"), hi.cast("int"))).alias("pages"))
    alone = span(first_page, first_page, F.array(first_page.cast("int")))
    with_first = lambda nums: let(F.concat(nums, F.array(first_page.cast("int"))), lambda all_: span(F.array_min(all_), F.array_max(all_)))
    by_breaks = let(F.regexp_count(chunk, pattern(BREAK_MARKER)), lambda breaks: F.when(breaks > 0, span(first_page, first_page + breaks)).otherwise(alone))
    by_chunk = let(whole_numbers(chunk), lambda nums: F.when(F.size(nums) > 0, with_first(nums)).otherwise(by_breaks))
    by_numbers = let(whole_numbers(chunk), lambda nums: F.when(F.size(nums) > 0, span(F.array_min(nums), F.array_max(nums))).otherwise(alone))

    def located(at: Column) -> Column:
        among = lambda line, end, lo, hi: span(lo, hi, F.array_sort(F.array_distinct(F.concat(_inside(line, at, end), F.array(lo, hi)))))
        upto = lambda line, end, lo: let(F.greatest(page_at(line, end), lo), lambda hi: among(line, end, lo, hi))
        ends = lambda line, end: let(page_at(line, at), lambda lo: upto(line, end, lo))
        return let(timeline(section, first_page), lambda line: let(at + F.length(trim_markers(chunk)), lambda end: ends(line, end)))

    by_section = let(locate_chunk(chunk, section), lambda at: F.when(at >= 0, located(at)).otherwise(by_numbers))
    return F.when(first_page.isNull(), F.struct(F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"), F.array().cast("array<int>").alias("pages"))).when(chunk == "", alone).when(section == "", by_chunk).otherwise(by_section)


def last_page_part(chunk: Column) -> Column:
    """What follows the last marker, or the second half where there is none."""
    parts = F.split(chunk, U + MARKER, -1)
    return F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise(F.call_function("substring", chunk, F.call_function("div", F.length(chunk), F.lit(2)).cast("int") + 1))

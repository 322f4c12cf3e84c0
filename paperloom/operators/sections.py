"""The section index of a document: headings, their levels and pages, in the order of the section tree.

The walk over the tree carries a stack of headings from section to section, so it is a fold in order; it runs per
document, and documents run in parallel."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REF = re.compile(r"^/(paragraphs|sections)/(\d+)$")
NUMBERED = re.compile(r"[0-9]+(?:[.][0-9]+){0,2}\b")
DASHES = re.compile("[–—―-]+")
FURNITURE = {"pagenumber", "pagefooter", "pageheader", "pagebreak"}
ORPHANS = "(orphan paragraphs)"
ORPHAN_LENGTH, ORPHAN_BASE = 30, 100_000
INDEX = "doc string, section_idx int, header_1 string, header_2 string, header_3 string, page_start int, page_end int, content string, is_orphan boolean"


def norm_header(text: str) -> str:
    words = " ".join((text or "").lower().split())
    return DASHES.sub("-", words).rstrip(".,:;")


def heading_level(title: str, above: list) -> int:
    """By the number that it starts with, else one below the last heading, else 2; 3 at most."""
    if m := NUMBERED.match(title):
        return m.group().count(".") + 1
    deeper = above[-1][0] + 1 if above else 2
    return min(deeper, 3)


def _pages(paragraph: dict) -> list[int]:
    return [r["pageNumber"] for r in paragraph.get("boundingRegions") or [] if isinstance(r.get("pageNumber"), int) and r["pageNumber"] > 0]


def section_index(paragraphs: list[dict], sections: list[dict]) -> list[dict]:
    paragraphs, sections = paragraphs or [], sections or []
    out: list[dict] = []
    stack: list[tuple[int, str]] = []
    seen: set[int] = set()
    used: set[int] = set()

    def visit(first: int) -> None:
        todo = [first]
        while todo:
            at = todo.pop()
            if at in seen or not 0 <= at < len(sections):
                continue
            seen.add(at)
            children, pages, content, heading_page = [], [], [], None
            for ref in sections[at].get("elements") or []:
                m = REF.match(ref or "")
                if not m:
                    continue
                n = int(m.group(2))
                if m.group(1) == "sections":
                    children.append(n)
                    continue
                if n >= len(paragraphs):
                    continue
                used.add(n)
                p = paragraphs[n]
                text, role, on = (p.get("content") or "").strip(), (p.get("role") or "").lower(), _pages(p)
                if role in ("title", "sectionheading") and text:
                    known = {norm_header(t) for _, t in stack}
                    if norm_header(text) not in known:
                        level = 1 if role == "title" else heading_level(text, stack)
                        while stack and stack[-1][0] >= level:
                            stack.pop()
                        stack.append((level, text))
                    if heading_page is None and on:
                        heading_page = on[0]
                pages += on
                if text:
                    content.append(text)
            if pages:
                by_level = dict(reversed(stack))
                out.append({"section_idx": at, **{f"header_{k}": by_level.get(k, "") for k in (1, 2, 3)}, "page_start": heading_page or min(pages), "page_end": max(pages), "content": "\n".join(content), "is_orphan": False})
            todo += reversed(children)  # a child before its siblings

    for at in range(len(sections)):
        visit(at)
    covered: set[int] = set()
    for s in out:
        covered.update(range(s["page_start"], 1 + s["page_end"]))
    stray: dict[int, list[str]] = {}
    for n, p in enumerate(paragraphs):
        text, on = (p.get("content") or "").strip(), _pages(p)
        if n not in used and (p.get("role") or "").lower() not in FURNITURE and len(text) >= ORPHAN_LENGTH and on and on[0] not in covered:
            stray.setdefault(on[0], []).append(text)
    for k, page in enumerate(sorted(stray)):
        out.append({"section_idx": len(sections) + ORPHAN_BASE + k, **dict(zip(("header_1", "header_2", "header_3"), (ORPHANS, "", ""), strict=True)), "page_start": page, "page_end": page, "content": "\n".join(stray[page]), "is_orphan": True})
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [{"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in INDEX.split(", ")]
    for batch in batches:
        rows = [(doc, s) for doc, ps, ss in zip(*(batch.column(c).to_pylist() for c in ("doc", "paragraphs", "sections")), strict=True) for s in section_index(ps, ss)]
        yield pa.RecordBatch.from_arrays([pa.array([doc if n == "doc" else s[n] for doc, s in rows], t) for n, t in zip(names, types, strict=True)], names)


def section_indexes(layouts: DataFrame) -> DataFrame:
    """The section index of every layout (doc, paragraphs, sections). A document is one row, so nothing is shuffled."""
    return layouts.select(F.col("doc").cast("string").alias("doc"), "paragraphs", "sections").mapInArrow(_index, INDEX)

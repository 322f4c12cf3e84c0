"""The texts that are embedded: of chunks and of figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text


def semantic_text(df: DataFrame) -> DataFrame:
    """The line-by-line form of a chunk that is embedded; empty lines are left out."""
    line = lambda label, value: text.let(value, lambda v: F.when(v != "", F.concat(F.lit(label), v)))
    some = lambda value: line("", value)
    refs = F.concat_ws(" | ", F.nullif("figure_ref", F.lit("")), F.nullif("table_ref", F.lit("")), some(F.array_join(text.equation_refs(F.col("chunk")), ", ")), some(F.array_join(F.transform(text.section_refs(F.col("chunk")), lambda s: F.concat(F.lit("Section "), s)), ", ")))
    path = F.concat_ws(" > ", *[F.nullif(h, F.lit("")) for h in ("header_1", "header_2", "header_3")])
    body = text.strip(text.strip_inline_tables(text.strip_running(F.col("chunk"))))
    parts = (line("Source: ", F.col("source_file")), line("Section: ", path), line("Page: ", F.col("printed_page_label")), line("References: ", refs), line("Callouts: ", F.array_join(text.callouts(F.col("chunk")), " || ")), some(body))
    return df.withColumn("chunk_for_semantic", F.concat_ws("\n", *parts))


def semantic_diagram(df: DataFrame) -> DataFrame:
    """The form of a figure that is embedded: source, page, reference and category, description, and the first 1000 characters round it."""
    bits = F.concat_ws(" ", F.nullif("figure_ref", F.lit("")), F.when(F.col("diagram_category") != "", F.concat(F.lit("("), "diagram_category", F.lit(")"))))
    line = lambda label, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(label), value))
    around = F.substring(text.strip(F.col("context_text")), 1, 1000)
    parts = (line("Source: ", F.col("source_file")), line("Page: ", F.col("physical_pdf_page").cast("string")), F.coalesce(line("Diagram: ", bits), F.lit("Diagram")), F.nullif(text.strip(F.col("diagram_description")), F.lit("")), line("Context: ", around))
    return df.withColumn("chunk_for_semantic", F.concat_ws("\n", *parts))

"""Chunking of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, OVERLAP = 1200, 200


def chunk_starts(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """Starts 1, 1 + size - overlap, ... of chunks none of which lies wholly in the overlap of the one before."""
    n = F.coalesce(F.length(text), F.lit(0))
    step = size - overlap
    last = F.when(n > 0, F.greatest(F.call_function("div", n - overlap - 1, F.lit(step)), F.lit(0))).otherwise(-1)
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)).cast("int")), lambda i: (i * step + 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def chunk(df: DataFrame, text: str = "text", size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """A row for each chunk of each row: its ordinal ``ordinal`` from 0 and its text ``chunk`` in place of the text."""
    others = [c for c in df.columns if c != text]
    parts = df.select(*others, text, F.posexplode(chunk_starts(F.col(text), size, overlap)).alias("ordinal", "start"))
    return parts.select(*others, "ordinal", F.call_function("substring", F.col(text), F.col("start"), F.lit(size)).alias("chunk"))

"""Mixing sources to target weights by repeating documents.

Tokens are summed per source. With weights w and the corpus scaled so that the target holds ``total`` tokens, a source's
repetition rate is w * total / (sum of w * its tokens). A document is emitted floor(rate) times, plus one copy where a
number in [0, 1) hashed from the seed and its id lies below the fraction.

Defined results: a null source is a source of its own. Null and empty texts hold no token; a source without tokens has
the rate 1. Rows with the same id (null included) draw the same number, so repeated rows are repeated alike. An empty
table gives an empty one. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import ROW, join_sized, materialise, packed, token_count, unpacked

SEED = 20
#: 48 bits of an md5 digest, as a share.
BITS = 48


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0, total: float | None = None) -> DataFrame:
    """(source, tokens, weight, rate). Without ``weights``, targets are tempered: tokens to the power 3/4 (two square
    roots, so that every engine rounds alike). Without ``total``, it is the least at which no source has a rate below 1,
    so that nothing is lost by mixing."""
    sums = docs.groupBy("source").agg(F.sum(token_count(F.col("text"))).cast("double").alias("tokens"))
    if weights is None:
        weight: Column = F.sqrt("tokens") * F.sqrt(F.sqrt("tokens"))
    else:
        weight = F.coalesce(F.element_at(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("source")) if weights else F.lit(None).cast("double"), F.lit(float(default_weight)))
    sums = materialise(sums, "mix-tokens").withColumn("weight", weight)
    # least factor at which every source comes to its own tokens: max(tokens / weight)
    scale = sums.where("tokens > 0 and weight > 0").agg(F.max(F.col("tokens") / F.col("weight")).alias("most"), F.sum("weight").alias("all"))
    factor = F.col("most") if total is None else F.lit(float(total)) / F.col("all")
    rate = F.when(F.col("tokens") > 0, F.col("weight") * factor / F.col("tokens")).otherwise(F.lit(1.0))
    return sums.crossJoin(scale).select("source", "tokens", "weight", rate.alias("rate"))


def draw(doc_id: Column, seed: int = SEED) -> Column:
    """A whole number below 2**48 hashed from the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, default_weight: float = 1.0, total: float | None = None, seed: int = SEED, copy_column: str | None = None) -> DataFrame:
    """Documents repeated to the target weights. ``copy_column``: name of a column with the number of the copy, from 1."""
    rates = materialise(source_rates(docs, weights, default_weight, total).select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("__source"), F.col("rate").alias("__rate")), "mix-rates")
    rows = packed(docs, __source=F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    rows = join_sized(rows, rates, ["__source"])
    whole = F.floor("__rate").cast("bigint")
    extra = draw(F.col(f"{ROW}.doc_id"), seed).cast("double") < (F.col("__rate") - F.floor("__rate")) * float(1 << BITS)
    rows = rows.withColumn("__n", whole + extra.cast("bigint")).where("__n > 0")
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    out = unpacked(rows, docs.columns) if copy_column is None else rows.select(*[F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns], F.col("__copy").alias(copy_column))
    return out


def sql(seed: int = SEED) -> str:
    """The default mixture in DuckDB SQL, with the column ``copy_no``."""
    return f"""WITH t AS (SELECT source, sum(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0))::DOUBLE AS tokens FROM documents GROUP BY source),
    w AS (SELECT source, tokens, sqrt(tokens) * sqrt(sqrt(tokens)) AS weight FROM t),
    r AS (SELECT source, CASE WHEN tokens > 0 THEN weight * (SELECT max(tokens / weight) FROM w WHERE tokens > 0) / tokens ELSE 1.0 END AS rate FROM w),
    n AS (SELECT d.*, floor(rate)::BIGINT + (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {BITS // 4}))::BIGINT::DOUBLE < (rate - floor(rate)) * {1 << BITS}::DOUBLE)::BIGINT AS n
        FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
    SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1)) AS copy_no FROM n WHERE n > 0"""

"""Corpus pipeline over the table of documents: quality rules, line dedup, SimHash near-dedup, mixing, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of documents, as they came and in their order; the last returns the packed pieces. Near-dedup compares what line dedup
left, and also reads the table of documents, for the texts as they were before: near copies lose what they share to line dedup, and no longer
look alike, while others look alike only without the lines that went.

In every stage each row counts for itself, null ids and repeated rows included; texts of any length are handled whole; columns
besides those of documents pass through, whatever they are called; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import line_dedup, mixing, packing, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a cutoff of their language and source go; so do null and empty texts, and those of blanks. Null languages and
    sources are groups of their own. Equal rows stay or go together."""
    return quality.quality_filter(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has go; so do documents of which nothing is left, and so all but the first of
    repeated rows and of copies. Null and empty texts stay. Order is by id, null ids last, then by text and place."""
    return line_dedup.line_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the first document stays. All are compared by the text they have now; those whose
    id stands once here and in the table of documents, also by the text they have there. Documents without tokens in either stay."""
    return simhash.near_dedup(docs, before=spark.read.parquet(f"{sf_dir}/documents.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated to the target weights of their sources; at the default total, none is lost. A null source is one, too; one
    without tokens keeps its documents once. Equal ids, and null ones, draw alike."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of the mixture in a sequence: (bin, start, doc_id, piece, n_tokens, text). Texts without tokens have no piece; equal rows
    each have their own."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack),
]
#: Alignment, SimHash forests and the packing program are beyond SQL; tests hold the pipeline against a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet to the shared folder and read again."""
    from paperloom.llm.common import materialise

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs

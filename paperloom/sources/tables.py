"""Tables of a folder, and inputs made from them by expressions that Spark and DuckDB read alike."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@dataclass(frozen=True)
class Made:
    """A projection of a table; the same in both engines."""

    source: str
    columns: tuple[str, ...]
    where: str = "true"

    def df(self, spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, self.source).where(self.where).selectExpr(*self.columns)

    def sql(self) -> str:
        return f"(SELECT {', '.join(self.columns)} FROM {self.source} WHERE {self.where})"


#: A chunk of a manual for each order line, full of references, callouts and identifiers.
MANUAL = Made(
    "lineitem",
    (
        "l_orderkey AS doc",
        "l_linenumber AS pos",
        "concat('See Figure ', l_linenumber, '-', l_partkey % 40, ' and FIG. ', l_suppkey % 9, '.', l_linenumber, '; fig ', l_partkey % 7, ' in Table ', l_suppkey % 12, '-', l_linenumber, ', Tbl. A-', l_partkey % 5,"
        " '. Section ', l_linenumber, '.', l_suppkey % 6, ' and Sec. ', l_partkey % 8, '-2 on page ', l_linenumber, '-', l_suppkey % 30, ', pp. ', l_partkey % 90, ' hold Equation ', l_linenumber, '.', l_partkey % 3, '.', chr(10),"
        " CASE l_suppkey % 4 WHEN 0 THEN 'WARNING: live parts at GE-THQL-' WHEN 1 THEN 'Danger - keep off ABB-VD' WHEN 2 THEN 'note: rating of NEMA-X' ELSE 'Caution fuse SQ-D' END, l_partkey % 1000, '-2 in use', chr(10), 'Rev. ', l_linenumber, '.', l_suppkey % 5,"
        " ' of Document No. MX-', l_partkey % 500, CASE l_linenumber % 3 WHEN 0 THEN ' issued 2024-3-7' WHEN 1 THEN ' March 26, 2024' ELSE ' in Sept 2023' END) AS text",
    ),
)

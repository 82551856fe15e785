"""From raw documents to packed training sequences: quality rules, line dedup, near-dedup, packing.

Each stage takes the documents that the one before has kept, as reread from Parquet, and returns documents with the
same columns; the last returns a row per packed piece. Rows with null ids pass the near-dedup stage. An empty table
runs through and gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierworks.llm import line_dedup, near_dedup, packing, quality_cascade
from tierworks.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_cascade.kept(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines; those of which nothing is left go. ``n_chars`` follows the text."""
    out = line_dedup.deduplicated(docs, drop_empty=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): that with the smallest id."""
    gone = near_dedup.near_duplicates(docs, width=5, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules), ("line dedup", repeated_lines), ("near-dedup", near_copies), ("packing", packed),
]

#: The last stage needs a tokenizer, which SQL has not; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

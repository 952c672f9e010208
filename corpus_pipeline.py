"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it has written. Documents of low quality go; later
copies of repeated line runs are cut out, and documents left without a line go; of near
duplicates one document stays; documents that hold a benchmark item go; and what is left
is packed into token sequences.

Every stage bears NULL ids and texts, empty and very long texts, repeated rows and empty
tables, and returns the columns it is given, whatever their names. A NULL or empty text is
scored as one empty passage, has no lines and no shingles, holds no benchmark item, and is
packed as its end alone. Rows that repeat are judged alike; ties go to the smaller doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftledger.llm import line_runs, lsh_forest, mil, packing, templates
from siftledger.llm.common import fresh, table
from siftledger.session import materialise


# Percent of their shingles that documents of one near-duplicate group share with another.
NEAR = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier scores 0.5 or more.

    The classifier learns the same labels as query op5, so the others stay held out.
    """
    model = mil.train(docs, table(spark, sf_dir, "labels").where(mil.learned_from()))
    (score,) = fresh(docs, "score")
    return mil.with_score(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; n_chars follows. Emptied documents go."""
    n_lines, n_removed = fresh(docs, "n_lines", "n_removed")
    cut = line_runs.deduplicated(docs)
    return (
        cut.where((F.col(n_removed) == 0) | (F.col(n_removed) < F.col(n_lines)))
        .withColumn(
            "n_chars",
            F.when(F.col(n_removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")),
        )
        .select(*docs.columns)
    )


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group, and every document without a group."""
    return lsh_forest.one_of_each(docs, NEAR)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return templates.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("line_runs", unrepeated_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", decontaminated),
    ("packing", packed),
]

# Learned scores and token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs, f"stage-{name}")
    return docs

"""From raw documents to packed sequences: the stages, and running them one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rtdw.llm.decontamination import clean_documents
from rtdw.llm.jaccard import near_unique
from rtdw.llm.packing import packed_stage
from rtdw.llm.quality import good_documents
from rtdw.llm.repeats import trimmed_documents
from rtdw.llm.tables import stored, table

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", near_unique),
    ("suffix-array dedup", trimmed_documents),
    ("benchmark decontamination", clean_documents),
    ("best-fit packing", packed_stage),
]

#: The stages on hashes, suffixes and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, each stage's result having been written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)

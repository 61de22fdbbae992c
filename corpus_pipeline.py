"""A corpus pipeline: quality, near-duplicates, mixing, tokens; each stage over the last one's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrubline.llm import mixing, pieces, quality, simhash
from scrubline.llm.tables import table
from scrubline.workspace import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, with all their columns.

    Null and empty texts are scored like others; without labels of both classes all documents stay.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest doc_id.

    Texts without words are one group. Of repeated rows one stays; rows without doc_id stay where
    their group has none, one for each fingerprint.
    """
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix of sources takes them.

    A null source is a source of its own. Documents without words are never taken; the one at which
    a source's last pass ends is taken whole if at least half of it is.
    """
    return mixing.mixed_documents(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix, in its order, and whether they decode to its text.

    Null and empty texts have no ids.
    """
    return pieces.encoded(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", duplicates_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

# Neither fitted scores nor fingerprints can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, every result written and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

"""A corpus pipeline of the training-data operators over ``documents``.

Every stage takes tables of any extra columns, whatever their names, and empty ones.

Quality rules drop documents, one document of each near-duplicate group stays, sources are
mixed to target weights by repeating and dropping documents, and the texts are encoded to
SentencePiece ids with seeded merge dropout.  Each stage works on all rows that the stage
before it kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docstrata.llm import pieces
from docstrata.llm.mixing import mixed_documents
from docstrata.llm.neardup import distinct_documents
from docstrata.llm.quality import good_documents
from docstrata.llm.storage import passing_workspaces, staged, workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is good and that pass the base rule.

    A null or wordless text fails the base rule and goes; rows that repeat an id or a text
    are judged each by itself, so equal texts get equal verdicts.
    """
    return good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id.

    A null id counts as the largest; of several rows with the id that stays, the one with
    the least text stays.  Texts without words are near to nothing and all stay.
    """
    return distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them.

    A null source is a source, a null text has no words; rows equal in id and text share out
    their copies.
    """
    return mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, and whether decoding gives the text back.

    A null text has no pieces; repeated rows of one id are segmented alike.
    """
    import public_tokenizers  # only this stage needs the vocabulary files

    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("encode_pieces", encode_pieces)]
# The estimate, the mix and the segmentation are iterative: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stage's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = workspace(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with passing_workspaces(spark):
            docs = staged(stage(spark, docs, sf_dir), f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)

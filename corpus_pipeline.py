"""From raw documents to packed training sequences: five stages, each written and read again as the next one's documents.

Defined results: all stages but the last keep the columns of documents, whatever they are called, and the values of the rows
they keep. A null text is empty: it isn't toxic, equals other empty texts, is near nothing, has no words (so the mixture
takes it as often as its source's rate says) and packs as an end id. A null id never is a training row of the first stage;
it stays last of equal texts, and of near ones only if the others have none. A null source is a source. Repeated rows are
copies of each other. Without labels of both kinds nothing is toxic. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from scriptorium.llm.common import materialise, read, steps_of


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, learned from the labels, rejects go."""
    return toxicity.reject(docs, read(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of similarity 0.8 or more, the one with the smallest id stays."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Grammar, cube sampling and packing can't be put in SQL; tests/llm/test_pipeline.py compares the stages, chained, with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage has written for itself goes when its result is written."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with steps_of() as made:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
            made.remove(docs)
    return STAGES[-1][1](spark, docs, sf_dir)

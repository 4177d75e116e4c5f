"""From raw documents to token ids: the stages of a training corpus, in order.

Every stage is a function of (session, documents so far, data folder). All but
the last return the columns of ``documents``, whatever further columns there are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import contamination, mixing, planes, quality, similar
from plumbline.llm.queries import BYTE_BPE, vocabulary
from plumbline.llm.shared import stored, table
from plumbline.session import checkpoint_dir, configure


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts; a null text is judged as an empty one."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles, the smallest id.

    Found by SimHash through the inverted index of ``op10_simhash`` (shared bytes counted, bits verified),
    by an exact index where fingerprints lie further apart, and verified on the shingles.
    """
    return similar.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``; those without an id are not judged and stay."""
    return contamination.clean_of(docs, table(spark, sf_dir, "benchmark"))


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them: none, once or several times."""
    return mixing.mixed(docs)


def as_token_planes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of all documents written in order of doc_id, and what the files say of each document."""
    folder = f"{checkpoint_dir(spark)}/plumbline-corpus-{uuid.uuid4().hex}"
    planes.write_ids(docs, folder, vocabulary(BYTE_BPE))
    return planes.read_documents(spark, folder, with_ids=False)


STAGES = [
    ("quality", good_quality),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", in_proportion),
    ("token_planes", as_token_planes),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored before the next reads it."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained rules and drawn samples have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}

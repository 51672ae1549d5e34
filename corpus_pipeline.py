"""The corpus pipeline: documents through five stages, each of which calls one operator.

1. quality     documents that the quality rules reject go
2. near_copies one document of each group of near copies stays (five-word shingles, similarity of 0.8 or more)
3. secrets     every secret is replaced by a mark that says whether it looks live
4. mixture     sources are brought to their target weights by dropping and repeating documents
5. tokens      every document is encoded; the result has counts and digests

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Cases: a null text counts as empty, fails the quality rules and goes with the first stage. Null ids, sources and
languages are values of their own; of a group of copies a known id stays before a null one. Rows that repeat id and text
are one group of copies, of which the same row stays in every run. An empty table passes all stages as an empty table.
Further columns, of any name, are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from silverloom.llm import bpe, jaccard, mixing, quality, secrets
from silverloom.llm.common import materialize, table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, n=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, bpe.default_spec())


STAGES = [
    ("quality", drop_low_quality),
    ("near_copies", keep_one_of_near_copies),
    ("secrets", redact_secrets),
    ("mixture", mix_sources),
    ("tokens", encode),
]

#: Models, hashes and schedules are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

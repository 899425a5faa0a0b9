"""From raw documents to token ids: the stages, each an operator of presslake.llm.

Every stage reads what its predecessor wrote. All but the last return the columns
of documents. A stage drops exactly the rows its operator decides against.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm import bagminhash, bpe, decontam, exact_dedup, toxicity
from presslake.llm.common import fresh, read_table, staged
from presslake.llm.queries import VOCABULARY, toxicity_chain
from presslake.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity chain does not reject; it is fitted on labelled rows of `docs`.

    Null and empty texts are judged as empty ones, copies of a row alike. Without labelled rows, and from an
    empty table, nothing is rejected. All columns are kept, whatever their names.
    """
    (kept,) = fresh(docs, "kept")
    configure(spark)
    judged = toxicity.judge(docs, toxicity_chain(spark, sf_dir, docs), lambda c: c == "toxic")
    return judged.filter(F.col(kept)).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id (null ids are the smallest).

    Null counts as the empty text; of rows with equal text and id one stays. Texts of any length are compared
    whole; an empty table stays empty; all columns are kept.
    """
    (kept,) = fresh(docs, "kept")
    configure(spark)
    return exact_dedup.exact_classes(docs).filter(F.col(kept)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id.

    Texts with fewer words than a shingle, null and empty ones are near only to equal ones; of equal rows one
    stays; an empty table stays empty; all columns are kept.
    """
    (kept,) = fresh(docs, "kept")
    configure(spark)
    return bagminhash.near_classes(docs).filter(F.col(kept)).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Rows are told apart by a number that is written with them, so ids may be null or repeat, and equal rows go or stay
    together. Null and empty texts hold nothing; either table may be empty; all columns are kept.
    """
    (key,) = fresh(docs, "leak_key")
    configure(spark)
    keyed = staged(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    leaks = decontam.find_leaks(keyed, read_table(spark, sf_dir, "benchmark"), id_col=key)
    leaks = staged(leaks.select(key).distinct(), "leaks")
    return keyed.join(leaks, key, "left_anti").select(docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with counts and digests.

    Null counts as the empty text, which has no ids; equal rows give equal rows; an empty table gives an empty one.
    """
    configure(spark)
    return bpe.encode_table(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("tokenize", tokenize),
]

#: Trained models and token merges have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

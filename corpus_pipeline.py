"""Corpus pipeline: stages over ``documents``, each one pipeline operator.

Every stage works on all rows that the one before wrote.  All but the last
return the columns of the documents; the last returns where each piece of
each document is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.functions.columns import free_names
from matchday.llm import language, mixing, neardup, packing, secrets
from matchday.llm.common import table, written
from matchday.llm.queries import TOKENIZER


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what naive Bayes can give no language: null texts and texts
    without a letter, and no others.  Trained on every labelled row of
    ``docs``; a document without a ``lang`` gets the predicted one (none where
    no row is labelled).  Repeated rows are predicted alike and all stay;
    other columns keep their values, whatever their names."""
    label, score, lettered = free_names(docs, "_label", "_score", "_lettered")
    named = language.predict(docs, language.train(docs), label=label, score=score, lettered=lettered).filter(lettered)
    # a probability of 0 says that there was no language to choose from
    found = F.coalesce("lang", F.when(F.col(score) > 0, F.col(label)))
    return named.select(*(found.alias(c) if c == "lang" else F.col(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by 5-word shingles at 80 percent:
    the one of the smallest id (nulls last), of rows that repeat id and text
    the least in its other columns.  Null and blank texts are linked with
    nothing and all stay; kept rows keep all values, whatever their names."""
    return neardup.first_of_each(docs, neardup.Settings(width=5, percent=80))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark and correct ``n_chars``; all documents
    stay, null and empty texts and repeated rows among them, and all other
    columns keep their values."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents, up to three times, so that sources meet their targets.
    Null and empty texts have size 0 and come as their source's plan says;
    ties go by a seeded hash; rows come out as they are, some repeated."""
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences of 2048.  A null or empty text
    is one end token; repeated rows are packed each; equal lengths share
    their places in any order."""
    return packing.pack_documents(docs, TOKENIZER, 2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, sketches and tokenizers are beyond SQL; the stages are
#: tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

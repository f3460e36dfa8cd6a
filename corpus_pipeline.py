"""A training corpus from raw documents: five stages, each an operator of `attesta.llm`, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attesta.llm import decontaminate, language, minhash, mixing, secrets
from attesta.llm.session import prepared, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled rows teach; those without letters, or unlike all of them, go.

    Null, empty and letterless texts go; a null id, source or label does not matter for whether a row stays. Equal texts, however often they stand there, have one fate. Without labelled rows there is no language, and all go.
    """
    prepared(spark)
    return language.keep_languages(docs, language.train(docs), least_score=0.4)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the smallest id.

    Rows of one id are one document and stay or go together, repeated rows with them; rows with a null id stay; null and empty texts are like no other.
    """
    prepared(spark)
    return minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark. Null and empty texts stay, a null id does not matter, of repeated rows all stay or none."""
    prepared(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked in the text and n_chars set to the new length. Null texts stay null; each row is masked by itself, so repeated rows stay equal."""
    prepared(spark)
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with their columns, and `copies`, how often each is taken (a longer name if the table has that column).

    Null texts have no words, null sources are one source, the last; rows of one id stand at one place of their source, so repeated rows are taken alike.
    """
    prepared(spark)
    return mixing.take(docs)


STAGES = [("language_id", language_stage), ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage), ("secrets", secret_stage), ("mixing", mixing_stage)]

#: Signatures, regressions and guess costs have no SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder, each landed in the shared folder."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

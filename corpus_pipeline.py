"""A training corpus from raw documents: five stages, each a job over all rows that the one before kept.

toxicity       documents that the string-kernel machine calls toxic go
language       documents without letters, or where no language has a clear lead, go
near_dedup     of each group of near-duplicates the document with the smallest id stays
decontaminate  documents that a benchmark item's windows contaminate go
tokens         ids of the word vocabulary, their number, and a digest of the text they decode to

All stages but the last return the columns of documents. Empty texts have no language and go in the second
stage. Near-duplicates share 80 % of their five-word shingles.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.catalog import table
from tabulith.llm import bpe, forest, kernel, mixture, winnowing
from tabulith.llm.words import SMALL_BATCH, bound_batches
from tabulith.runtime import write_out

LEAST_SHARE = 0.4  # a document whose best language scores less goes


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled documents of the stage's input."""
    machine = spark.sparkContext.broadcast(kernel.fit(docs, table(spark, sf_dir, "labels"), release=True))
    bound_batches(spark, SMALL_BATCH)
    return docs.where(kernel.score(F.col("text"), machine, release=True) < 0.5)


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the documents with a language; the language column itself stays as it is."""
    answer = mixture.predict(F.col("text"), spark.sparkContext.broadcast(mixture.fit(docs)))
    bound_batches(spark, SMALL_BATCH)
    asked = docs.select(F.struct("*").alias("row"), answer.alias("answer"))
    return asked.where((F.col("answer.lang_pred") != "und") & (F.col("answer.score") >= LEAST_SHARE)).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the same id are one document."""
    groups = forest.near_duplicates(docs.select("doc_id", "text"))
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    bound_batches(spark, SMALL_BATCH)
    n_hit = winnowing.contaminated_words(F.col("spans"))
    gone = found.where(winnowing.is_contaminated(n_hit, F.col("n_words"))).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def with_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, decoded_sha256): the last is of the UTF-8 text that the ids decode to."""
    bound_batches(spark, SMALL_BATCH)
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = docs.select("doc_id", "lang", "source", bpe.round_trip(F.col("text"), path).alias("coded"))
    return coded.select("doc_id", "lang", "source", "coded.ids", F.size("coded.ids").cast("bigint").alias("n_tokens"),
                        "coded.decoded_sha256")


STAGES = [("toxicity", without_toxic), ("language", with_language), ("near_dedup", one_of_each_group),
          ("decontaminate", without_benchmark), ("tokens", with_ids)]

ORACLE_SQL = None  # fitted models and tokenizers: tests compare the stages with plain versions instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

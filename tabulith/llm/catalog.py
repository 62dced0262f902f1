"""Registered queries of the subpackage and the SQL they must equal."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulith.catalog import table
from tabulith.runtime import scratch_folder

from . import (bpe, collisions, forest, hnsw, kernel, mixture, packing, pieces, recurrent, residual_codes, roles, variants,
               winnowing)
from .words import bound_batches

WORD_BPE, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _remainder(key: str, n: int):
    """crc32 of the key as text, modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


@query
def op1_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Language shares of every document by mixture inference, learned from the rows not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False)))
    model = mixture.fit(docs.where(~F.col("held_out")))
    answer = mixture.predict(F.col("text"), spark.sparkContext.broadcast(model))
    return docs.select("doc_id", "held_out", answer.alias("r")).select("doc_id", "held_out", "r.*")


@query
def op2_forest_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents that share 85 % of their three-word shingles."""
    found = forest.near_duplicates(table(spark, folder, "documents"), size=3, threshold=(85, 100))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op3_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation with its cheapest legal sequence of turns, rendered turn by turn."""
    return roles.repair_turns(table(spark, folder, "conversations"))


@query
def op4_piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document in the piece vocabulary."""
    bound_batches(spark)
    docs = table(spark, folder, "documents")
    n = pieces.count_tokens(F.col("text"), public_tokenizers.path(PIECES))
    counted = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
                          n.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op5_recurrent_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probability of every document by the recurrent model and by word frequencies, from the rows not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(_remainder("doc_id", 7) == 2, F.lit(False))
    return recurrent.score(docs, docs.where(~held_out)).withColumn("held_out", held_out)


@query
def op6_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    bound_batches(spark)
    path = public_tokenizers.path(WORD_BPE)
    coded = table(spark, folder, "documents").select("doc_id", bpe.encode(F.col("text"), path).alias("ids"))
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), path).cast("binary"), 256).alias("decoded_sha256"))


def _packed_digest(block: packing.Block, start: int) -> pa.RecordBatch:
    ids, offsets = block.all_ids().astype("<u4"), block.offsets
    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(block.keys, pa.int64()), pa.array(start + offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()),
         pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


@query
def op7_packed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' ids written bit-packed in document order, then read back from the files."""
    path = scratch_folder(spark, "packed-ids")
    packing.write_ids(table(spark, folder, "documents"), path, public_tokenizers.path(WORD_BPE))
    return packing.read_ids(spark, path, _packed_digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query
def op8_winnow_contamination(spark: SparkSession, folder: str) -> DataFrame:
    """Which documents hold 13-word windows of benchmark items, and how many of their words."""
    found = winnowing.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = winnowing.contaminated_words(F.col("spans"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        winnowing.is_contaminated(n_hit, F.col("n_words")).alias("contaminated"))


@query
def op9_hnsw_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups of embeddings of one label with a cosine of 0.93 or more."""
    found = hnsw.near_duplicates(table(spark, folder, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query
def op10_toxicity_kernel(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by the string-kernel machine, learned from the labels not held out."""
    labels = table(spark, folder, "labels").where(_remainder("doc_id", 5) != 0)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    machine = spark.sparkContext.broadcast(kernel.fit(docs, labels))
    bound_batches(spark)
    held_out = F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), kernel.score(F.col("text"), machine).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


@query
def op11_residual_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth embedding; every seventh row's label is shifted by one first."""
    rows = table(spark, folder, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residual_codes.hard_negatives(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


SQL["op11_residual_hard_negatives"] = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, cast(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
 p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
 q AS (SELECT p.anchor_id, positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
  AND 80 * positive_score <= 100 * score AND score <= positive_score)
 SELECT * FROM q WHERE rank <= 5"""


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Every frequent word of the documents with its more frequent spelling and the root that spellings lead to."""
    return variants.group_variants(table(spark, folder, "documents"))


@query
def op13_collision_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest other rows of every hundredth embedding."""
    return collisions.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


SQL["op13_collision_neighbours"] = """WITH r AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 s AS (SELECT a.vec_id AS query_id, b.vec_id, sqrt(list_reduce(list_transform(list_zip(a.v, b.v), lambda p: (p[2] - p[1]) * (p[2] - p[1])),
  lambda x, y: x + y)) AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0)
 SELECT query_id, cast(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10"""

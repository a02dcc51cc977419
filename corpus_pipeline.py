"""A training corpus from raw documents: filtered, deduplicated, mixed and encoded.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import SMALL, table, two_hashes
from tidemark.llm.line_dedup import drop_repeated_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.ngram_join import join_ngrams
from tidemark.llm.pieces import encode_texts
from tidemark.llm.toxicity import score_documents, trained_on
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the model learned from ``labels``; a null text counts as empty and stays."""
    return score_documents(docs, trained_on(spark, sf_dir)).where("score < 0.5").select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that others keep; ``n_chars`` is that of the new text."""
    return drop_repeated_lines(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that share most of their five-word shingles, connected at 0.8, the one with the smallest id.

    Rows are judged one by one, each by its own text, also where they repeat an
    id; ties go by text, then by the other columns, and of equal rows one stays.
    Empty documents, and rows without an id, link with nothing and stay.
    """
    # Each row has a name of its own here, so rows with one id neither link nor go together.
    rows = stage(docs.select(*COLUMNS).withColumn("_row", F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())),
                 "pipeline-rows")
    order = F.struct("doc_id", *[h.alias(f"_h{i}") for i, h in enumerate(two_hashes(F.col("text")))],
                     F.xxhash64("lang", "source", "n_chars").alias("_rest"), "_row")
    joined = join_ngrams(rows.select(F.col("_row").alias("doc_id"), "text", order.alias("_order")), words=5, per_cent=80)
    judged = stage(joined.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_row"), "component_id", "_order"), "pipeline-judged")
    first = judged.groupBy("component_id").agg(F.min("_order").alias("_order")).select("_order._row")
    gone = stage(judged.select("_row").join(first, "_row", "left_anti"), "pipeline-copies")
    return join_checked(rows, gone, ["_row"], "left_anti", limit=SMALL).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, which may be not at all or twice."""
    taken = mix_sources(docs).where("times > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text of the mix, and the text that they decode to."""
    import public_tokenizers

    out = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), decode=True)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("near_copies", drop_near_copies),
          ("mix", mix), ("sentencepiece", encode)]

# Learned scores, similarity components and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

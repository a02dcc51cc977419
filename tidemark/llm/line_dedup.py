"""Lines that many documents share are kept in one document only.

A line's key is the line without ASCII white space at both ends and with A-Z in
lower case.  Only 128-bit hashes of keys are shuffled, never lines: they are
counted per distinct document, and the positions to drop are brought to the
documents, which then put their kept lines together again in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import BLANKS, SMALL, ascii_lower, table, two_hashes, without
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked, measure
from tidemark.plans.storage import stage


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: document, text hash, position, key hash."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("_text"), F.posexplode(_lines(F.col("text"))).alias("_pos", "_line"))
    trimmed = lines.withColumn("_line", F.btrim("_line", F.lit(BLANKS))).where(F.char_length("_line") >= min_chars)
    a, b = two_hashes(ascii_lower(F.col("_line")))
    return trimmed.select("doc_id", "_text", "_pos", a.alias("_a"), b.alias("_b"))


def repeated_keys(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """Hashes of the keys that ``min_docs`` documents or more hold, and the largest such document.

    Documents are made distinct per key first, which deals a key of very many
    documents out over all tasks; what remains is a count per key and task.
    """
    pairs = _hashed_lines(docs, min_chars).select("_a", "_b", "doc_id").distinct()
    return (pairs.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("doc_id").alias("_keeper"))
            .where(F.col("_n") >= min_docs).drop("_n"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and ``n_lines`` (before) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    distinct documents loses its lines except in the largest ``doc_id`` that
    holds it; there all of them stay.  A null text is one empty line.  Rows that
    repeat a ``doc_id`` are one document with several texts, each handled in
    full; rows without a ``doc_id`` are left as they are and count for no key.
    Columns named ``n_lines`` or ``n_dropped`` are replaced, all others stay.
    """
    docs = docs.select(*without(docs, ["n_lines", "n_dropped"]))
    keys = stage(repeated_keys(docs, min_chars, min_docs), "repeated-lines")
    dropped = (join_checked(_hashed_lines(docs, min_chars), keys, ["_a", "_b"], limit=SMALL)
               .where(F.col("doc_id") != F.col("_keeper")))
    marks = stage(dropped.groupBy(F.col("doc_id").alias("_doc"), F.col("_text"))
                  .agg(F.collect_set("_pos").alias("_gone")), "dropped-lines")
    if measure(marks, SMALL):
        marks = F.broadcast(marks)
    joined = docs.join(marks, (docs["doc_id"] == marks["_doc"]) & (F.xxhash64(docs["text"]) == marks["_text"]), "left")
    n_lines = F.size(_lines(F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("_gone"))
    # The outer transform has one element: it splits the text once for all positions.
    together = F.transform(F.array(_lines(F.col("text"))), lambda lines: F.array_join(
        F.transform(kept, lambda i: F.get(lines, i)), "\n"))[0]
    text = F.when(F.col("_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(together)
    return joined.select(*[text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns],
                         n_lines.cast("bigint").alias("n_lines"),
                         F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint").alias("n_dropped"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, with the kept text as a digest."""
    out = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))

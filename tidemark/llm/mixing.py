"""Sources mixed to target weights by weighted fair queueing.

Every document gets a place in its source by a hash of its id, and a virtual
finish time: the source's words up to and including it, divided by the source's
target.  A second round over a source continues its count.  All are taken in
order of finish time until the budget is used up.

Nothing here moves texts.  Running sums are made in about sqrt(n) hash buckets
per source and moved up by the sums of the buckets before.  The order within a
source is that of (hash, id, size), so the result is two bounds per source, one
for each round, and a document is taken if it is not above them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import SMALL, table, without
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

WEIGHTS = (3, 1, 2)
ROUNDS = 2
OWN = ["size", "source_size", "target", "times", "taken"]


def _with_keys(docs: DataFrame) -> DataFrame:
    """The size, the place in the shuffle (60 bits of MD5) and the key of the source, null included."""
    place = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
    return docs.select(
        *without(docs, [*OWN, "_place", "_source"]),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint").alias("size"),
        place.cast("bigint").alias("_place"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("_source"))


def targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, cap: float) -> DataFrame:
    """One row per source: its rank by code point (null last), size and target.

    A source stops at ``cap`` times its size.  With sources in the order in which
    a rising level reaches their caps, a source is at its cap exactly if sharing
    what those before it leave would give it as much, so one pass finds all.
    """
    every, before = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), Window.orderBy(
        F.col("_limit") / F.col("_weight"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    by_source = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("_source") == "", "_source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights)) + 1)
    ranked = (by_source.withColumn("_rank", rank).withColumn("_weight", weight)
              .withColumn("_limit", F.col("source_size") * F.lit(float(cap)))
              .withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(budget)))
              .withColumn("_weights", F.sum("_weight").over(every)))
    left = F.col("_budget") - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    shares = F.col("_weights") - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    full = ranked.withColumn("_full", left * F.col("_weight") >= F.col("_limit") * shares)
    open_left = F.col("_budget") - F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0.0)).over(every)
    open_shares = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_weight"))).over(every)
    return full.select("_source", "_rank", "source_size", "_budget", F.when(
        F.col("_full"), F.col("_limit")).otherwise(open_left * F.col("_weight") / open_shares).alias("target"))


def schedule(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One staged row per source: ``source_size``, ``target``, and the last place taken in each round.

    ``sizes`` has doc_id, size, _place and _source, and should be staged.
    """
    sources = stage(targets(sizes, weights, budget, cap), "mix-sources")
    buckets = max(16, math.isqrt(sizes.count()))
    bucket = F.floor(F.col("_place") / F.lit(float(1 << 60)) * F.lit(buckets)).cast("int")
    queued = join_checked(sizes.where("size > 0").withColumn("_bucket", bucket), sources, ["_source"], limit=SMALL)
    sums = queued.groupBy("_rank", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("_rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(sums.select("_rank", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before")),
                    "mix-offsets")
    # Equal rows are peers: they get one place and are taken or left together.
    local = Window.partitionBy("_rank", "_bucket").orderBy("_place", "doc_id", "size")
    numbered = queued.withColumn("_sum", F.sum("size").over(local))
    placed = (join_checked(numbered, offsets, ["_rank", "_bucket"], limit=SMALL)
              .withColumn("_round", F.explode(F.array(*[F.lit(r) for r in range(ROUNDS)])))
              .withColumn("_sum", F.col("_sum") + F.col("_before") + F.col("_round") * F.col("source_size"))
              .withColumn("_finish", F.col("_sum") / F.col("target"))
              .withColumn("_slot", F.floor(F.least(F.col("_finish"), F.lit(2.0)) * F.lit(buckets)).cast("int")))
    placed = stage(placed.select("_rank", "_round", "_place", "doc_id", "size", "_sum", "_finish", "_slot", "_budget"),
                   "mix-queue")
    # The slot in which the budget runs out, then the last document before that, in order of finish time.
    slots = placed.groupBy("_slot").agg(F.sum("size").alias("_sum"), F.max("_budget").alias("_budget"))
    upto = F.sum("_sum").over(Window.orderBy("_slot"))
    over = (slots.withColumn("_upto", upto).where(F.col("_upto") > F.col("_budget"))
            .orderBy("_slot").select("_slot", F.col("_upto") - F.col("_sum"), "_budget").first())
    taken = F.lit(True)
    if over is not None:
        slot, used, limit = over
        last = (placed.where(F.col("_slot") == slot)
                .withColumn("_upto", F.sum("size").over(Window.orderBy("_finish", "_rank", "_sum")) + used)
                .where(F.col("_upto") <= limit).orderBy(F.desc("_upto")).select("_finish", "_rank", "_sum").first())
        taken = F.col("_slot") < slot
        if last is not None:
            here = F.struct("_finish", "_rank", "_sum")
            bound = F.struct(F.lit(last[0]).alias("_finish"), F.lit(last[1]).alias("_rank"), F.lit(last[2]).alias("_sum"))
            taken = taken | ((F.col("_slot") == slot) & (here <= bound))
    place = F.struct("_place", "doc_id", "size")
    ends = placed.where(taken).groupBy("_rank").agg(*[
        F.max(F.when(F.col("_round") == r, place)).alias(f"_last{r}") for r in range(ROUNDS)])
    return stage(sources.join(ends, "_rank", "left").select(
        "_source", "source_size", "target", *[f"_last{r}" for r in range(ROUNDS)]), "mix-ends")


def _take(keyed: DataFrame, ends: DataFrame) -> DataFrame:
    place = F.struct("_place", "doc_id", "size")
    times = sum((F.when((F.col("size") > 0) & (place <= F.col(f"_last{r}")), 1).otherwise(0) for r in range(ROUNDS)),
                F.lit(0))
    return (join_checked(keyed, ends, ["_source"], "left", limit=SMALL).withColumn("times", times)
            .withColumn("taken", F.col("size") * F.col("times"))
            .drop("_source", "_place", *[f"_last{r}" for r in range(ROUNDS)]))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, cap: float = 2.0,
                keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``size`` (words), ``source_size``, ``target``, ``times`` (0 to 2) and ``taken`` words.

    Weights are dealt to sources in code point order, null last.  All sources
    share ``budget`` times all words; a source stops at ``cap`` times its own.
    Documents are taken whole, so a source may miss its target by less than one
    document.  Empty and null texts have size 0 and are never taken.  Rows equal
    in id, size and source are taken or left together.  Columns named as the
    results are replaced.  ``keep`` names the columns wanted; without ``text``,
    texts are read once.
    """
    keyed = _with_keys(docs)
    slim = stage(keyed.select("doc_id", "size", "_place", "_source"), "mix-sizes")
    ends = schedule(slim, weights, budget, cap)
    return _take(slim if keep == ["doc_id"] else keyed, ends)


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight, source_size * 2.0::DOUBLE AS top,
    CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS budget FROM by_source),
filled AS (
  SELECT *, (budget - coalesce(sum(top) OVER before, 0)) * weight
    >= top * (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS filled
  FROM ranked WINDOW before AS (ORDER BY top / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targeted AS (
  SELECT source, rk, source_size, budget, CASE WHEN filled THEN top ELSE (budget - sum(CASE WHEN filled THEN top ELSE 0 END) OVER ())
    * weight / sum(CASE WHEN filled THEN 0 ELSE weight END) OVER () END AS target FROM filled),
summed AS (
  SELECT doc_id, size, rk, target, budget, source_size,
    CAST(sum(size) OVER (PARTITION BY rk ORDER BY place, doc_id, size) AS BIGINT) AS own
  FROM sized JOIN targeted ON sized.source IS NOT DISTINCT FROM targeted.source WHERE size > 0),
queue AS (
  SELECT doc_id, size, rk, target, budget, own + r * source_size AS upto FROM summed CROSS JOIN (VALUES (0), (1)) rounds(r)),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY upto / target, rk, upto) AS spent FROM queue),
taken AS (
  SELECT doc_id, size, rk, count(*) AS times FROM cut WHERE spent <= budget GROUP BY doc_id, size, rk)
SELECT sized.doc_id, sized.size, source_size, target, sized.size * coalesce(times, 0) AS taken
FROM sized JOIN targeted ON sized.source IS NOT DISTINCT FROM targeted.source
LEFT JOIN taken ON sized.doc_id = taken.doc_id AND sized.size = taken.size AND targeted.rk = taken.rk
"""


@query("op6_mix_sources", OP6_SQL)
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes from them."""
    out = mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "size", "source_size", "target", "taken")

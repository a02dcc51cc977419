"""Hard negatives of anchors by slot-decomposed selection.

An anchor's positives each set a window of scores in which its negatives lie.
The windows overlap, so they are not searched one by one: their upper limits cut
the scores into disjoint slots.  Tasks compare a block of anchors with a part of
all rows and keep the best few per anchor and slot, which are merged over the
parts; then merges from the lowest slot up give the best few below every limit,
and each window's lower limit cuts its end off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import table
from tidemark.llm.registry import query
from tidemark.plans.storage import stage

#: Bytes of vectors in a block of anchors and in a part of all rows, and parts at least.
BLOCK_BYTES, PART_BYTES, PARTS = 4 * 1024 * 1024, 32 * 1024 * 1024, 16
#: Anchors and rows that are multiplied at a time.
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 256, 8_192
#: Components and scores beyond these count as these.
MOST, MOST_SCORE = 2**62, 2**55

BEST = "anchor bigint, slot int, score bigint, vec_id bigint"


def quantised(embeddings: DataFrame, anchor: Column, scale: int = 256) -> DataFrame:
    """Rows that take part, staged: ``row``, ``vec_id``, ``label``, ``anchor``, ``dim`` and the integer vector as bytes."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), F.size("embedding").alias("dim"), x.alias("q"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            with np.errstate(over="ignore"):
                whole = np.floor(batch["q"].flatten().to_numpy() * scale)
            cuts = np.cumsum([0, *batch["dim"].to_pylist()])
            vectors = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
            # Two bytes a component where they hold the row, else eight.
            packed = [v.astype("<i2").tobytes() if not len(v) or np.abs(v).max() < 2**15
                      else np.array([int(min(max(c, -MOST), MOST)) for c in v], dtype="<i8").tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], names=batch.schema.names)

    return stage(rows.mapInArrow(run, "row bigint, vec_id bigint, label bigint, anchor boolean, dim int, q binary"), "quantised")


class _Vectors:
    """Rows of one task: those of small integers as doubles, which multiply exactly, others as Python integers."""

    def __init__(self, rows, dim: int):
        import numpy as np

        null = rows["vec_id"].is_null().to_numpy()
        self.id, self.row = rows["vec_id"].fill_null(0).to_numpy(), rows["row"].to_numpy()
        order = np.lexsort((self.row, self.id, null))
        self.id, self.row, self.null, self.label = self.id[order], self.row[order], null[order], rows["label"].to_numpy()[order]
        data = rows["q"].to_pylist()
        self.packed, self.dim = [data[i] for i in order], dim
        self.small = np.array([len(p) == 2 * dim for p in self.packed], dtype=bool)

    def matrix(self, at):
        """The vectors at these places, all small or all not."""
        import numpy as np

        small = not len(at) or self.small[at[0]]
        out = np.frombuffer(b"".join(self.packed[i] for i in at), dtype="<i2" if small else "<i8").reshape(len(at), self.dim)
        return out.astype(np.float64 if small else object)

    def split(self, at, size: int):
        """Runs of at most ``size`` places, small vectors apart from others."""
        for part in (at[self.small[at]], at[~self.small[at]]):
            for i in range(0, len(part), size):
                yield part[i:i + size]


def _scores(a, b):
    """Inner products as 64-bit integers."""
    import numpy as np

    if a.dtype != object and b.dtype != object:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in a], dtype=object).reshape(a.shape)
    other = np.array([[int(v) for v in r] for r in b], dtype=object).reshape(b.shape)
    return np.clip(exact @ other.T, -MOST_SCORE, MOST_SCORE).astype(np.int64).reshape(len(a), len(b))


class _Best:
    """The best ``k`` rows per anchor and slot: higher scores first, then smaller places."""

    def __init__(self, anchors: int, slots: int, k: int):
        import numpy as np

        self.k, self.slots = k, slots
        self.at_least = np.full((anchors, slots), np.iinfo(np.int64).min)
        self.key, self.score, self.place = (np.empty(0, dtype=np.int64) for _ in range(3))

    def add(self, scores, slot, places):
        """``slot`` is from 1 for what may be taken, else 0."""
        import numpy as np

        anchor, column = np.nonzero(slot)
        key, score = anchor * self.slots + slot[anchor, column] - 1, scores[anchor, column]
        good = score >= self.at_least.reshape(-1)[key]
        key, score, place = (np.concatenate(pair) for pair in (
            (self.key, key[good]), (self.score, score[good]), (self.place, places[column[good]])))
        order = np.lexsort((place, -score, key))
        key, score, place = key[order], score[order], place[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        last = rank == self.k - 1
        self.at_least.reshape(-1)[key[last]] = score[last]
        kept = rank < self.k
        self.key, self.score, self.place = key[kept], score[kept], place[kept]


def _found(out, anchors, at, best, rows):
    for i, (key, score, place) in enumerate(zip(best.key, best.score, best.place)):
        out.append((int(anchors.row[at[key // best.slots]]), int(key % best.slots) + 1, int(score),
                    None if rows.null[place] else int(rows.id[place])))


def _table(found: list[tuple]):
    import pyarrow as pa

    columns = zip(*found) if found else [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    names=[part.split()[0] for part in BEST.split(", ")])


def _pairs(rows: DataFrame, anchors: DataFrame, task) -> DataFrame:
    """Run ``task(anchors, rows, dim)`` for every block of anchors with every part of all rows, by length of vectors.

    Parts go by a hash of the row number, so no value makes a large one.  Their
    number follows from the bytes of all rows, that of the blocks from the
    anchors'; a task holds one of each.  Rows are sent once per block.
    """
    size = F.coalesce(F.sum(F.octet_length("q") + 32), F.lit(0))
    parts = max(PARTS, -(-rows.agg(size).first()[0] // PART_BYTES))
    blocks = max(1, -(-anchors.agg(size).first()[0] // BLOCK_BYTES))
    part, block = (F.pmod(F.xxhash64("row", F.lit(i)), F.lit(n)).cast("int") for i, n in enumerate((parts, blocks)))
    own = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns apart from those of ``rows``
    to = own.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    of = rows.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    on = ["dim", "block", "part"]

    def run(key, left, right):
        return _table(task(left, right, key[0].as_py()) if left.num_rows and right.num_rows else [])

    return to.groupBy(*on).cogroup(of.select("row", "vec_id", "label", "q", *on).groupBy(*on)).applyInArrow(run, BEST)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per anchor and slot over all parts."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives(rows: DataFrame, k: int = 5) -> DataFrame:
    """Per anchor (its row number) the first ``k`` other rows of its label: ``rank``, ``vec_id``, ``score``."""
    def task(left, right, dim):
        import numpy as np

        anchors, others, out = _Vectors(left, dim), _Vectors(right, dim), []
        for label in np.intersect1d(anchors.label, others.label):
            same = np.flatnonzero(others.label == label)
            for at in anchors.split(np.flatnonzero(anchors.label == label), ANCHORS_AT_ONCE):
                best, a = _Best(len(at), 1, k), anchors.matrix(at)
                for part in others.split(same, ROWS_AT_ONCE):
                    best.add(_scores(a, others.matrix(part)), (anchors.row[at][:, None] != others.row[part]).astype(np.int8), part)
                _found(out, anchors, at, best, others)
        return out

    anchors = rows.where("anchor").select("row", "vec_id", "label", "dim", "q")
    return _ranked(_pairs(rows, anchors, task), k).select("anchor", "rank", "vec_id", "score")


def negatives(rows: DataFrame, windows: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Per anchor the best ``k`` of other labels in each slot: ``slot``, ``rank``, ``vec_id``, ``score``.

    ``windows`` has per anchor ``limits``, its positives' different scores from 0
    on, falling.  Slot j holds scores up to the j-th upper limit and above the
    next; nothing below the lowest limit of a window that reaches it is kept.
    """
    def task(left, right, dim):
        import numpy as np

        anchors, others, out = _Vectors(left, dim), _Vectors(right, dim), []
        limits = dict(zip(left["row"].to_pylist(), left["limits"].to_pylist()))
        deepest = max(map(len, limits.values()))
        everyone = np.arange(len(others.row))
        for at in anchors.split(np.arange(len(anchors.row)), ANCHORS_AT_ONCE):
            best, a = _Best(len(at), deepest, k), anchors.matrix(at)
            p = np.full((len(at), deepest), -1, dtype=np.int64)
            for i, row in enumerate(anchors.row[at]):
                p[i, :len(limits[row])] = limits[row]
            for part in others.split(everyone, ROWS_AT_ONCE):
                scores = _scores(a, others.matrix(part))
                slot = sum(((100 * scores <= high * p[:, j:j + 1]) & (p[:, j:j + 1] >= 0)).astype(np.int8) for j in range(deepest))
                floor = np.take_along_axis(np.pad(low * p, ((0, 0), (1, 0))), slot.astype(np.int64), axis=1)
                slot[(100 * scores < floor) | (anchors.label[at][:, None] == others.label[part])] = 0
                best.add(scores, slot, part)
            _found(out, anchors, at, best, others)
        return out

    anchors = rows.where("anchor").select("row", "vec_id", "label", "dim", "q").join(
        windows.select(F.col("anchor").alias("row"), "limits"), "row")
    return _ranked(_pairs(rows, anchors, task), k)


def mine_hard_negatives(embeddings: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 10,
                        low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor and positive the first ``n_negatives`` rows of another label that score not too high and not too low.

    ``embeddings`` has ``vec_id``, ``label`` and ``embedding``; ``anchor`` says
    which rows are anchors.  A component x counts as floor(256 * x), a score is
    the inner product of these integers, ties go to the smaller ``vec_id`` (null
    last).  An anchor's positives are its first ``n_positives`` other rows of its
    label.  A negative's score is from ``low`` to ``high`` hundredths of the
    positive's.

    Rows with a null label, a null vector, or a component that is null or not
    finite take no part; only vectors of the same length, which may be 0, are
    compared.  Rows that repeat are rows of their own: each is an anchor, a
    positive or a negative by itself.  Scaled components beyond 2^62 and scores
    of them beyond 2^55 count as these.  Other columns are not looked at; an
    empty table gives an empty result.
    """
    rows = quantised(embeddings, anchor)
    p = F.struct((-F.col("score")).alias("minus"), F.col("vec_id").isNull().alias("last"), "vec_id", "rank")
    first = stage(positives(rows, n_positives).groupBy("anchor").agg(F.array_sort(F.collect_list(p)).alias("positives")), "positives")
    limits = F.array_distinct(F.transform(F.filter("positives", lambda x: x["minus"] <= 0), lambda x: -x["minus"]))
    windows = first.withColumn("limits", limits).where(F.size("limits") > 0)
    n = F.struct("slot", (-F.col("score")).alias("minus"), F.col("vec_id").isNull().alias("last"), "vec_id")
    found = negatives(rows, windows, n_negatives, low, high).groupBy("anchor").agg(F.collect_list(n).alias("found"))
    slots = F.transform(F.sequence(F.size("limits"), F.lit(1), F.lit(-1)), lambda j: F.transform(
        F.filter("found", lambda x: x["slot"] == j), lambda x: F.struct(x["minus"].alias("minus"), x["last"].alias("last"), x["vec_id"].alias("vec_id"))))
    row = "struct<minus:bigint,last:boolean,vec_id:bigint>"
    none = F.array().cast(f"array<{row}>")
    # From the lowest slot up; the head of what is merged so far are the best below the next limit.
    below = F.aggregate(slots, F.array().cast(f"array<array<{row}>>"), lambda done, slot: F.concat(
        F.array(F.slice(F.array_sort(F.concat(slot, F.coalesce(F.get(done, F.lit(0)), none))), 1, n_negatives)), done))
    names = rows.where("anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    each = (windows.join(found, "anchor").withColumn("below", below)
            .select("anchor", "limits", "below", F.explode("positives").alias("p")).where("p.minus <= 0"))
    score = -F.col("p.minus")
    mine = F.filter(F.get("below", F.array_position("limits", score).cast("int") - 1), lambda x: -100 * x["minus"] >= low * score)
    return (each.select("anchor", F.col("p.vec_id").alias("positive_id"), score.alias("positive_score"), F.posexplode(mine).alias("i", "x"))
            .join(names, "anchor")
            .select("anchor_id", "positive_id", (F.col("i") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"),
                    "positive_score", (-F.col("x.minus")).alias("negative_score")))


OP12_SQL = """
WITH used AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM used a JOIN used r ON a.vec_id % 100 = 0 AND len(a.v) = len(r.v) AND a.vec_id <> r.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER mine)::INT AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
WINDOW mine AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER mine <= 10
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)

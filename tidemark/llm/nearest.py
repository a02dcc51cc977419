"""Nearest vectors by multiprobe p-stable hashing.

Every table cuts some random projections of the unit vectors into equal cells;
a bucket is one cell of each.  The offset of a neighbour at a known distance
along a random projection is normal with that distance as deviation, so the
chance that it lies in a bucket can be told from the query's own place.  A query
visits buckets in that order: a few in each table first, and then, knowing how
far its k-th best is, until the chance that a nearer one was passed by in all
tables is small.  Candidates of all tables are ranked by their original cosine.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import SMALL, table
from tidemark.llm.registry import query
from tidemark.llm.vectors import cosines, lengths, unpacked, units, usable
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage, task_count

#: Tables, width of a cell (projections of unit vectors have deviation 1), and outermost cell.
TABLES, WIDTH, EDGE = 3, 1.0, 4
#: Buckets per table visited first, and the chance of passing by the k-th neighbour that ends the search.
FIRST, MISS = 4, 0.01
#: Vectors per bucket that the number of projections aims at: a query visits few large buckets, since each visit is a
#: row.  Vectors, and queries, compared in one task.
PER_BUCKET, CHUNK = 2_500, 4_000


class Hashes:
    """The projections of all tables for vectors of ``dim`` components, among ``count`` vectors."""

    def __init__(self, dim: int, count: int):
        import numpy as np

        self.functions = min(6, max(1, round(math.log(max(count, 1) / PER_BUCKET) / math.log(4.1)))) if count > PER_BUCKET else 1
        rng = np.random.default_rng([8, dim])
        self.directions = rng.standard_normal((TABLES, dim, self.functions))
        self.shifts = rng.uniform(0, WIDTH, (TABLES, self.functions))

    def places(self, values, number: int):
        return values @ self.directions[number] + self.shifts[number]

    def buckets(self, places):
        """One number per row of places: its cells, as digits."""
        import numpy as np

        cells = np.clip(np.floor(places / WIDTH), -EDGE, EDGE).astype(np.int64) + EDGE
        return cells @ (2 * EDGE + 1) ** np.arange(self.functions, dtype=np.int64)

    def chances(self, places, buckets, distance):
        """For each query (row of places) and bucket, the chance to hold a neighbour at the query's ``distance``."""
        import numpy as np

        digits = buckets[:, None] // (2 * EDGE + 1) ** np.arange(self.functions, dtype=np.int64) % (2 * EDGE + 1)
        chance = np.ones((len(places), len(buckets)))
        bounds = np.concatenate([[-np.inf], np.arange(1 - EDGE, EDGE + 1) * WIDTH, [np.inf]])
        for f in range(self.functions):
            below = _normal((bounds - places[:, f, None]) / distance[:, None])
            chance *= np.diff(below, axis=1)[:, digits[:, f]]
        return chance


def _normal(x):
    """Distribution function of the normal law, within 1e-7."""
    import numpy as np

    # Abramowitz and Stegun, formula 26.2.17.
    a = np.abs(np.clip(x, -30, 30))
    t = 1 / (1 + 0.2316419 * a)
    tail = np.exp(-a * a / 2) / math.sqrt(2 * math.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(x >= 0, 1 - tail, tail)


def first_buckets(hashes: Hashes, values, number: int, buckets):
    """Positions of the buckets that each query visits first: the likeliest for a neighbour at distance 1."""
    import numpy as np

    # Row by row, so that a query gets the same buckets among whatever others it stands.
    places = np.array([hashes.places(v, number) for v in values]).reshape(len(values), hashes.functions)
    chance = hashes.chances(places, buckets, np.ones(len(values)))
    return np.argsort(-chance, axis=1, kind="stable")[:, :FIRST]


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct candidates of each query; ties go to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _visit(index: DataFrame, probes: DataFrame, crowd: DataFrame, dim: int, k: int) -> DataFrame:
    """The k best of each visited bucket: query_id, vec_id, score.

    Crowded buckets, and buckets with many visitors, are cut into chunks, and
    every chunk of vectors meets every chunk of queries in a task of its own.
    """
    visitors = probes.groupBy("number", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("groups"))
    shares = stage(crowd.join(visitors, ["number", "bucket"]).select("number", "bucket", "chunks", "groups"), "lsh-shares")
    on = ["number", "bucket"]
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = (join_checked(index, shares, on, limit=SMALL).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int"))
            .withColumn("group", every("groups")).select("vec_id", "vector", *on, "chunk", "group"))
    asked = (join_checked(probes, shares, on, limit=SMALL).withColumn("group", F.pmod(F.xxhash64("query_id"), "groups").cast("int"))
             .withColumn("chunk", every("chunks")).select("query_id", "query", *on, "chunk", "group"))
    keys = [*on, "chunk", "group"]

    def compare(rows, queries):
        import numpy as np
        import pandas as pd

        out = []
        if len(rows) and len(queries):
            values, ids = unpacked(rows["vector"], dim), rows["vec_id"].to_numpy()
            asks, names = unpacked(queries["query"], dim), queries["query_id"].to_numpy()
            for start in range(0, len(asks), 256):
                some, own = asks[start:start + 256], names[start:start + 256]
                near = some @ values.T
                near[own[:, None] == ids[None, :]] = -np.inf
                if near.shape[1] > k:
                    kth = np.partition(near, -k, axis=1)[:, -k]
                    q, v = np.nonzero((near >= kth[:, None] - 1e-9) & np.isfinite(near))
                else:
                    q, v = np.nonzero(np.isfinite(near))
                out.append((own[q], ids[v], cosines(some[q], values[v])))
        query_ids, vec_ids, scores = map(np.concatenate, zip(*out)) if out else ([], [], [])
        found = pd.DataFrame({"query_id": query_ids, "vec_id": vec_ids, "score": scores})
        found = found.drop_duplicates().sort_values(["score", "vec_id"], ascending=[False, True])
        return found.groupby("query_id").head(k).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return mine.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(compare, "query_id bigint, vec_id bigint, score double")


def _search(vectors: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    hashes = Hashes(dim, vectors.count())

    def index_rows(batches):
        import numpy as np
        import pandas as pd

        for rows in batches:
            values = units(np.array(rows["embedding"].tolist(), dtype=np.float64).reshape(len(rows), dim))
            packed = [v.tobytes() for v in values]
            for number in range(TABLES):
                yield pd.DataFrame({"number": np.int32(number), "bucket": hashes.buckets(hashes.places(values, number)),
                                    "vec_id": rows["vec_id"], "vector": packed})

    index = stage(vectors.select("vec_id", "embedding").mapInPandas(
        index_rows, "number int, bucket bigint, vec_id bigint, vector binary"), "lsh-index")
    crowd = stage(index.groupBy("number", "bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).cast("int").alias("chunks")), "lsh-buckets")
    # At most 9 to the 6th buckets per table, whatever the number of vectors.
    held = {number: [] for number in range(TABLES)}
    for number, bucket in crowd.select("number", "bucket").collect():
        held[number].append(bucket)
    share = MISS ** (1 / TABLES)

    def choose(batches):
        """Buckets that a query visits: the first few without a distance, the rest up to the chance with one."""
        import numpy as np
        import pandas as pd

        for rows in batches:
            for start in range(0, len(rows), 64):
                some = rows.iloc[start:start + 64]
                values = unpacked(some["query"], dim)
                first = some["kth"].isna().to_numpy() & ~some["again"].to_numpy()
                distance = np.where(first, 1.0, np.sqrt(np.maximum(2 - 2 * some["kth"].fillna(-1).to_numpy(), 1e-12)))
                for number in range(TABLES):
                    buckets = np.array(held[number], np.int64)
                    chance = hashes.chances(hashes.places(values, number), buckets, distance)
                    order = np.argsort(-chance, axis=1, kind="stable")
                    passed = 1 - np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
                    # A bucket is visited if too much chance is left before it.
                    wanted = np.concatenate([np.ones((len(some), 1)), passed[:, :-1]], axis=1) > share
                    # The first visit had no distance, so it went by another order: just its buckets are left out now.
                    before = first_buckets(hashes, values, number, buckets)
                    visited = (order[:, :, None] == before[:, None, :]).any(axis=2)
                    wanted = np.where(first[:, None], visited, wanted & ~visited)
                    # Without k neighbours so far, all buckets are visited.
                    wanted |= (some["kth"].isna() & some["again"]).to_numpy()[:, None]
                    q, b = np.nonzero(wanted)
                    yield pd.DataFrame({"number": np.int32(number), "bucket": buckets[order[q, b]],
                                        "query_id": some["query_id"].to_numpy()[q], "query": some["query"].to_numpy()[q]})

    def pack(batches):
        import numpy as np
        import pandas as pd

        for rows in batches:
            values = units(np.array(rows["embedding"].tolist(), dtype=np.float64).reshape(len(rows), dim))
            yield pd.DataFrame({"query_id": rows["vec_id"], "query": [v.tobytes() for v in values]})

    asks = stage(queries.select("vec_id", "embedding").mapInPandas(pack, "query_id bigint, query binary"), "lsh-queries")
    probe = lambda rows: stage(rows.repartition(task_count(rows.sparkSession), "query_id").mapInPandas(choose, "number int, bucket bigint, query_id bigint, query binary"), "lsh-probes")
    begun = asks.withColumn("kth", F.lit(None).cast("double")).withColumn("again", F.lit(False))
    first = stage(best_of(_visit(index, probe(begun), crowd, dim, k), k), "lsh-first")
    kth = first.where(F.col("rank") == k).groupBy("query_id").agg(F.max("score").alias("kth"))
    going = join_checked(asks, kth, ["query_id"], "left", limit=SMALL).withColumn("again", F.lit(True))
    rest = _visit(index, probe(going), crowd, dim, k)
    return best_of(first.drop("rank").union(rest.select("query_id", "vec_id", "score")), k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k vectors of largest cosine to each query: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id and embedding; a query's own id is no candidate.
    Vectors that are null, zero or hold null or non-finite components, and rows
    without an id, take no part.  Only vectors of equal length are compared.
    Rows that repeat a vec_id with different vectors give that id its best score;
    equal scores go to the smaller id.  A query with fewer than k candidates gets
    all of them, since it then visits every bucket.
    """
    usable_rows = lambda df: df.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()).dropDuplicates(["vec_id", "embedding"])
    rows, asked = stage(usable_rows(vectors), "lsh-vectors"), usable_rows(queries)
    found = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    for dim in lengths(rows):
        same = F.size("embedding") == dim
        found = found.union(_search(rows.where(same), asked.where(same), dim, k))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best_of(once, k)


@query("op8_nearest")
def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)

"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

Rotations are learned that turn vectors into balanced binary codes: principal
axes, then alternating between the signs of the rotated vectors and the rotation
that comes nearest to these signs.  Pieces of the codes index as many tables;
vectors that agree in a piece are compared by their original cosine, once: in
the first table in which they agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import SMALL, table, without
from tidemark.llm.components import Forest, components
from tidemark.llm.registry import query
from tidemark.llm.vectors import cosines, lengths, unpacked, units, usable
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

#: Vectors that rotations are learned on, at most (by hash of the id), and learning rounds.
SAMPLE, ROUNDS = 20_000, 30
#: Rotations learned, before random ones follow, and pairs that misses are measured on at least.
LEARNED, TRIALS = 24, 4_000
#: Chance, measured on the sample, that a pair exactly at the threshold agrees in no table.
MISS = 5e-4
#: Vectors that share a code on average, rows per task, and vectors compared at a time.
PER_CODE, PER_TASK, AT_ONCE = 32, 3_000, 1_024


def learn_rotation(sample, rng):
    """Mean and rotation of balanced codes, one bit per component."""
    import numpy as np

    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    turned = centred @ axes[:, ::-1]
    rotation = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        signs = np.where(turned @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(signs.T @ turned)
        rotation = (left @ right).T
    return mean, axes[:, ::-1] @ rotation


def learn_codes(sample, count: int, threshold: float):
    """Rotations, bits per table and number of tables for ``count`` vectors like the sample.

    The pieces are as long as the table sizes ask for; how often a pair at the
    threshold agrees in one is measured on the sample's vectors and copies of
    them moved to just that cosine, and the number of tables follows from it.
    """
    import numpy as np

    rng, dim = np.random.default_rng(20), sample.shape[1]
    bits = min(30, max(4, math.ceil(math.log2(max(1, count / PER_CODE)))))
    pairs = np.tile(sample, (math.ceil(TRIALS / len(sample)), 1))[:max(TRIALS, len(sample))]
    aside = rng.standard_normal(pairs.shape)
    aside -= cosines(aside, pairs)[:, None] * pairs
    norms = np.sqrt(cosines(aside, aside))[:, None]
    moved = threshold * pairs + math.sqrt(max(0.0, 1 - threshold ** 2)) * aside / np.where(norms > 0, norms, 1)
    rotations, agreed, equal, tables = [], np.zeros(len(pairs), bool), np.zeros((len(pairs), 0), bool), 0

    def more():
        # Few or flat vectors may lead to the same rotation again and again; later ones are left as drawn.
        learned = learn_rotation(sample, rng) if len(rotations) < LEARNED else (
            np.zeros(dim), np.linalg.qr(rng.standard_normal((dim, dim)))[0])
        rotations.append(learned)
        return (((pairs - learned[0]) @ learned[1] >= 0) == ((moved - learned[0]) @ learned[1] >= 0))

    while agreed.mean() < 1 - MISS:
        while equal.shape[1] < bits:
            equal = np.hstack([equal, more()])
        agreed |= equal[:, :bits].all(axis=1)
        equal, tables = equal[:, bits:], tables + 1
    # A safe multiple, because the trials show only so many misses.
    tables = math.ceil(tables * 1.2)
    while len(rotations) * dim < tables * bits:
        more()
    return rotations, bits, tables


def codes_of(values, rotations, bits: int, tables: int):
    """The code of each vector in each table, as integers."""
    import numpy as np

    signs = np.hstack([(values - m) @ r >= 0 for m, r in rotations])[:, :tables * bits]
    return signs.reshape(len(values), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _pairs(codes, own, number: int, values, threshold: float, cross: bool):
    """Linked pairs (positions) of rows with the same code in table ``number`` and in none before."""
    import numpy as np

    order = np.argsort(codes[:, number], kind="stable")
    ends = np.flatnonzero(np.diff(codes[order, number])) + 1
    for group in np.split(order, ends):
        sides = (group[own[group] == 0], group[own[group] == 1]) if cross else (group, group)
        for start in range(0, len(sides[0]), AT_ONCE):
            a = sides[0][start:start + AT_ONCE]
            near = values[a] @ values[sides[1]].T >= threshold - 1e-9
            i, j = np.nonzero(near)
            i, j = a[i], sides[1][j]
            if not cross:
                i, j = i[i < j], j[i < j]
            for part in range(0, len(i), 200_000):
                p, q = i[part:part + 200_000], j[part:part + 200_000]
                held = cosines(values[p], values[q]) >= threshold
                held[held] = ~(codes[p[held], :number] == codes[q[held], :number]).any(axis=1)
                yield p[held], q[held]


def _links(classes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links, root): per task, how many vectors a class links to, and the smallest class that it reaches."""
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("embedding").toArrow()["embedding"].to_pylist()
    import numpy as np

    count = classes.count()
    rotations, bits, tables = learn_codes(units(np.array(sample, dtype=np.float64).reshape(-1, dim)), count, threshold)
    prefixes = max(1, math.ceil(count / PER_TASK))

    def encode(batches):
        import pandas as pd

        for rows in batches:
            values = units(np.array(rows["embedding"].tolist(), dtype=np.float64).reshape(len(rows), dim))
            codes = codes_of(values, rotations, bits, tables)
            for start in range(0, tables, 16):
                span = range(start, min(tables, start + 16))
                yield pd.DataFrame({
                    "node": np.tile(rows["node"].to_numpy(), len(span)), "copies": np.tile(rows["copies"].to_numpy(), len(span)),
                    "number": np.repeat(np.array(span, np.int32), len(rows)),
                    "part": np.concatenate([(codes[:, t] * prefixes) >> bits for t in span]).astype(np.int32),
                    "codes": [c.tobytes() for c in codes.astype(np.int32)] * len(span),
                    "vector": [v.tobytes() for v in values] * len(span)})

    rows = classes.select("node", "copies", "embedding").mapInPandas(
        encode, "node bigint, copies bigint, number int, part int, codes binary, vector binary")
    counted = classes.select("node", "copies", "embedding").mapInPandas(
        lambda batches: (b[["number", "part"]].groupby(["number", "part"]).size().reset_index(name="n") for b in encode(batches)),
        "number int, part int, n bigint").groupBy("number", "part").agg(F.ceil(F.sum("n") / F.lit(2 * PER_TASK)).cast("int").alias("chunks"))
    crowded = stage(counted.where("chunks > 1"), "itq-crowded")
    placed = (join_checked(rows, crowded, ["number", "part"], "left", limit=SMALL).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))
    # A crowded part is cut into chunks, and every two chunks meet in one task.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tasks = placed.withColumn("other", other).select(
        "node", "copies", "codes", "vector", "number", "part", F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))

    def compare(key, rows):
        import pandas as pd

        number, _, low, high = key
        codes = unpacked(rows["codes"], tables, "i4")
        values, nodes, copies = unpacked(rows["vector"], dim), rows["node"].to_numpy(), rows["copies"].to_numpy()
        links, forest = np.zeros(len(rows), np.int64), Forest()
        for p, q in _pairs(codes, rows["side"].to_numpy(), int(number), values, threshold, low != high):
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            for a, b in np.unique(np.stack([nodes[p], nodes[q]], axis=1), axis=0).tolist():
                forest.join(a, b)
        linked = np.flatnonzero(links)
        return pd.DataFrame({"node": nodes[linked], "links": links[linked],
                             "root": np.array([forest.find(n) for n in nodes[linked].tolist()], np.int64)})

    return tasks.groupBy("number", "part", "low", "high").applyInPandas(compare, "node bigint, links bigint, root bigint")


def dedup_embeddings(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vectors`` (vec_id, embedding) without ``embedding``, with ``n_links``, ``component_id`` and ``kept``.

    Two vectors link if their cosine in double precision is ``threshold`` or
    more.  Equal vectors are one class that is compared once; links count them
    all.  Null or zero vectors, those with null or non-finite components and rows
    without an id link with nothing; the component of a row without links is its
    own id.  Vectors of different length never link.  Rows that repeat an id are
    vectors of their own under one id.  Columns named as the results are replaced.
    """
    base = vectors.select(*without(vectors, ["n_links", "component_id", "kept", "node", "copies"]))
    part = base.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    classes = stage(part.groupBy("embedding").agg(F.min("vec_id").cast("bigint").alias("node"), F.count(F.lit(1)).alias("copies")),
                    "itq-classes")
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "node bigint, links bigint, root bigint")
    for dim in lengths(classes):
        found = found.union(stage(_links(classes.where(F.size("embedding") == dim), dim, threshold), "itq-links"))
    joined = stage(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "itq-components")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    # Ids that head two classes of vectors make one node; links are counted per vector below.
    named = join_checked(join_checked(classes, counts, ["node"], "left", limit=SMALL), joined, ["node"], "left", limit=SMALL)
    known = stage(named.where("copies > 1 OR links > 0").select(
        "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id")), "itq-known")
    return (join_checked(base, known, ["embedding"], "left", limit=SMALL)
            .withColumn("n_links", F.coalesce("n_links", F.lit(0)))
            .withColumn("component_id", F.coalesce("component_id", "vec_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).drop("embedding"))


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their near-duplicates."""
    return dedup_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))

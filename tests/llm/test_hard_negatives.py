"""Hard negatives against the plain way."""

import math
import random

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.llm import hard_negatives as H

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
                     *[T.StructField(n, T.StringType()) for n in ("row", "anchor", "slot", "score", "a.b")]])
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], ROWS).repartition(4)


def plain(rows, every=10, k=5, n=10, low=30, high=90):
    used = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, label, v) in enumerate(used):
        if anchor is None or anchor % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), i is None, i or 0, i, other) for b, (i, other, w) in enumerate(used)
                         if b != a and len(w) == len(v)), key=lambda s: s[:3])
        for minus, _, _, positive, _ in [s for s in scored if s[4] == label][:k]:
            good = [s for s in scored if s[4] != label and low * -minus <= 100 * -s[0] <= high * -minus][:n]
            out += [(anchor, positive, r, s[3], -minus, -s[0]) for r, s in enumerate(good, 1)]
    return sorted(out, key=repr)


def got(spark, rows, **more):
    out = H.mine_hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, **more)
    return sorted((tuple(r) for r in out.select(*OUT).collect()), key=repr)


def made(n, dim, seed, hot=0.3):
    rng = random.Random(seed)
    same = [rng.gauss(0, 0.3) for _ in range(dim)]
    return [(i, same if rng.random() < hot else [rng.gauss(0, 0.3) for _ in range(dim)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_plain_way(spark, seed):
    rows = made(300, 6, seed)
    want = plain(rows)
    assert got(spark, rows) == want and len(want) > 500


def test_small_blocks_and_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_BYTES", 300)
    monkeypatch.setattr(H, "PART_BYTES", 1_500)
    monkeypatch.setattr(H, "PARTS", 3)
    rows = made(200, 4, 3)
    assert got(spark, rows, n_positives=3, n_negatives=4) == plain(rows, k=3, n=4)


def test_rows_that_take_no_part_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(60, 3, 4) + [(100, None, 1), (110, [nan, 0.0, 1.0], 1), (120, [0.1, inf, 0.2], 1), (130, [None, 0.1, 0.2], 1), (140, [0.1, 0.2, 0.3], None),
                             (150, [], 1), (151, [], 1), (152, [], 2), (160, [0.5], 1), (161, [0.5], 1), (162, [0.2], 2), (None, [0.2, 0.2, 0.1], 1),
                             (None, [0.2, 0.2, 0.1], 2), (170, [0.0, 0.0, 0.0], 1)]
    assert got(spark, rows) == plain(rows)


def test_repeated_rows_and_ties(spark):
    rows = made(30, 2, 5, hot=0.8)
    rows += [r for r in rows for _ in range(2)]
    assert got(spark, rows) == plain(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([1e5, -3e5, 0.1, 3.8e5 + i]) for _ in range(3)], i % 2) for i in range(50)]
    assert got(spark, rows) == plain(rows)
    huge = [(i, [1e300, 0.0], i % 2) for i in range(12)]
    assert {r[4:] for r in got(spark, huge, high=100)} == {(H.MOST_SCORE, H.MOST_SCORE)}


def test_empty_table(spark):
    assert got(spark, []) == []

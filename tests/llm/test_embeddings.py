"""Embedding near-duplicates and nearest vectors against all pairs."""

import numpy as np
import pytest

from tidemark.llm import embedding_dedup, nearest
from tidemark.llm.embedding_dedup import dedup_embeddings

SCHEMA = "vec_id bigint, embedding array<float>, kept string, score string, rank string, number string, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "x", "x", "x", "x")
                                  for i, v in rows], SCHEMA)


def planted(seed=1, singles=150, groups=12, size=9, dim=32):
    """Unit vectors, some moved to cosines on both sides of 0.9, exact copies and scaled copies."""
    rng = np.random.default_rng(seed)
    rows = [v / np.linalg.norm(v) for v in rng.standard_normal((singles, dim))]
    for g in range(groups):
        for k in range(size):
            aside = rng.standard_normal(dim)
            aside -= aside @ rows[g] * rows[g]
            cosine = 0.86 + 0.02 * (k % 7)
            rows.append(cosine * rows[g] + np.sqrt(1 - cosine ** 2) * aside / np.linalg.norm(aside))
        rows += [rows[g], rows[g], 3 * rows[g]]
    order = rng.permutation(len(rows))
    return [(int(i) + 10, np.float32(rows[i]).tolist()) for i in order]


EDGES = [(1, None), (2, []), (3, [0.0] * 32), (4, [float("nan")] + [1.0] * 31), (5, [float("inf")] + [1.0] * 31),
         (6, [None] + [1.0] * 31), (None, [1.0] * 32), (7, [1.0] * 8), (8, [1.0] * 8), (9, [-0.0] + [1.0] * 7)]


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def expected(rows):
    ids = [i for i, v in rows if i is not None and usable(v)]
    values = [v for i, v in rows if i is not None and usable(v)]
    links, root = [0] * len(ids), {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            if len(values[a]) == len(values[b]) and cosine(values[a], values[b]) >= 0.9:
                links[a] += 1
                links[b] += 1
                x, y = find(ids[a]), find(ids[b])
                root[max(x, y)] = min(x, y)
    known = sorted((i, n, find(i)) for i, n in zip(ids, links))
    return sorted(known + [(i, 0, i) for i, v in rows if i is None or not usable(v)], key=repr)


@pytest.mark.parametrize("per_task", [3_000, 20])
def test_links(spark, monkeypatch, per_task):
    monkeypatch.setattr(embedding_dedup, "PER_TASK", per_task)  # small: crowded parts are cut into chunks
    rows = planted() + EDGES
    out = dedup_embeddings(table(spark, rows)).collect()
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=repr)
    want = expected(rows)
    missed = [(a, b) for a, b in zip(got, want) if a[1] < b[1]]
    assert all(a[1] <= b[1] for a, b in zip(got, want)) and len(missed) <= 2 and (missed or got == want)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in out)


def test_links_of_nothing_and_of_copies(spark):
    assert dedup_embeddings(table(spark, []).limit(0)).collect() == []
    out = dedup_embeddings(table(spark, [(5, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(3, 2, 3), (3, 2, 3), (5, 2, 3)]


@pytest.mark.parametrize("chunk", [4_000, 15])
def test_nearest(spark, monkeypatch, chunk):
    monkeypatch.setattr(nearest, "CHUNK", chunk)
    monkeypatch.setattr(nearest, "PER_BUCKET", 40)
    rows = planted(2) + EDGES
    vectors = table(spark, rows)
    out = nearest.nearest(vectors, vectors.where("vec_id % 5 = 0"), 5).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    part = [(i, v) for i, v in rows if i is not None and usable(v)]
    hit = total = 0
    for i, v in part:
        if i % 5 == 0:
            near = sorted((-cosine(v, w), j) for j, w in part if j != i and len(w) == len(v))[:5]
            assert len(got[i]) == len(near) and got[i] == sorted(got[i], key=lambda x: (-x[1], x[0]))
            assert all(abs(s - cosine(v, dict(part)[j])) < 1e-12 for j, s in got[i])
            hit += len({j for _, j in near} & {j for j, _ in got[i]})
            total += len(near)
    assert hit >= 0.95 * total and set(got) == {i for i, _ in part if i % 5 == 0}
    few = nearest.nearest(table(spark, rows[:4]), table(spark, rows[:1]), 5).collect()
    assert sorted(r.rank for r in few) == [1, 2, 3]
    assert nearest.nearest(vectors.limit(0), vectors.limit(0)).collect() == []
    assert nearest.nearest(vectors, table(spark, [(0, rows[0][1])]), 1).first().score == pytest.approx(1.0)


def test_second_visit_leaves_out_just_what_the_first_visited(spark, monkeypatch):
    staged, real = {}, nearest.stage

    def keep(df, label):
        staged.setdefault(label, []).append(real(df, label))
        return staged[label][-1]

    monkeypatch.setattr(nearest, "stage", keep)
    monkeypatch.setattr(nearest, "PER_BUCKET", 24)
    rng, rows = np.random.default_rng(6), []
    for v in rng.standard_normal((80, 16)):
        for aside in rng.standard_normal((5, 16)):
            rows.append((len(rows), np.float32(v / np.linalg.norm(v) + 0.3 * aside / np.linalg.norm(aside)).tolist()))
    vectors = table(spark, rows)
    nearest.nearest(vectors, vectors, 3).collect()
    hashes, (first, second) = nearest.Hashes(16, len(rows)), [
        {(r.query_id, r.number, r.bucket) for r in p.collect()} for p in staged["lsh-probes"]]
    held = [(r.number, r.bucket) for r in staged["lsh-buckets"][0].collect()]
    kth = {r.query_id: r.score for r in staged["lsh-first"][0].where("rank = 3").collect()}
    assert hashes.functions == 2 and len(kth) > 300 and not first & second
    for q, score in kth.items():
        value = nearest.units(np.array([rows[q][1]], float))
        for number in range(nearest.TABLES):
            buckets = np.array([b for n, b in held if n == number])
            chance = hashes.chances(hashes.places(value, number), buckets, np.sqrt([2 - 2 * score]))[0]
            order = np.argsort(-chance, kind="stable")
            left = 1 - np.cumsum(chance[order])
            # Every bucket is reached before which more chance is left than what ends the search.
            wanted = buckets[order][np.concatenate([[1.0], left[:-1]]) > nearest.MISS ** (1 / nearest.TABLES) + 1e-9]
            assert all((q, number, b) in first | second for b in wanted.tolist())

"""N-gram join against all pairs, in one task and cut into blocks."""

import random

import numpy as np
import pytest

from tidemark.llm import ngram_join
from tidemark.llm.components import Forest, components
from tidemark.llm.ngram_join import Measure, build_tree, join_ngrams, sample_keys, traverse


def shingles(text, words):
    found = (text or "").encode().lower().split()
    return {tuple(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def expected(rows, words, per_cent):
    sets = [(d, shingles(t, words)) for d, t in rows]
    forest = Forest()
    for i, (d, a) in enumerate(sets):
        for e, b in sets[i + 1:]:
            if a and b and d is not None and e is not None and 100 * len(a & b) >= per_cent * len(a | b):
                forest.join(d, e)
    return sorted(((d, len(s), None if d is None else forest.find(d) if s else d) for d, s in sets), key=repr)


def copies(seed, groups=25, vocabulary=400):
    """Groups of texts that differ in a few words, so that similarities lie on both sides of the threshold."""
    rng, rows = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.choice([3, 8, 12, 30, 70, 200]))]
        for _ in range(rng.choice([1, 2, 6, 15])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = f"v{rng.randrange(50)}"
            rows.append(" ".join(text) + rng.choice(["", " ", " end"]))
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("words,per_cent,block", [(3, 90, 1_500_000), (5, 80, 1_500_000), (3, 90, 300), (5, 80, 500)])
def test_components(make_docs, odd_texts, monkeypatch, words, per_cent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rows = copies(block) + list(enumerate(odd_texts)) + [(50, odd_texts[7]), (51, "Two Words"), (52, "two\twords"), (53, "two"), (None, "two")]
    rows.append(rows[0])
    out = join_ngrams(make_docs(rows), words, per_cent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr) == expected(rows, words, per_cent)
    assert "text" not in out[0].asDict() and out[0].score == "extra"


def test_nothing(make_docs):
    assert join_ngrams(make_docs([]).limit(0)).collect() == []


def test_tree_finds_what_all_pairs_find():
    rng = np.random.default_rng(3)
    for per_cent in (90, 80):
        measure = Measure(3, per_cent)
        for _ in range(20):
            base = np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))
            sets = [np.unique(np.concatenate([base[rng.random(len(base)) > rng.choice([0, .03, .06, .2])],
                                              rng.integers(0, 2**64, rng.integers(1, 30), dtype=np.uint64)])) for _ in range(40)]
            tree, pairs = Forest(), Forest()
            traverse(build_tree(sets), sets, list(range(40)), measure, tree)
            for i in range(40):
                for j in range(i):
                    if measure.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j])):
                        pairs.join(i, j)
            assert [tree.find(i) for i in range(40)] == [pairs.find(i) for i in range(40)]


def test_pruned_without_comparing(monkeypatch):
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**64, 100, dtype=np.uint64)) for _ in range(200)]
    compared = []
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: compared.append(1) or np.zeros(0))
    traverse(build_tree(sets), sets, list(range(200)), Measure(), Forest())
    assert len(compared) < 20  # of 19,900 pairs


def test_similar_sets_share_a_sample():
    rng = np.random.default_rng(5)
    for measure in (Measure(3, 90), Measure(5, 80)):
        for n in (10, 63, 64, 70, 1_000):
            for _ in range(100):
                whole = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
                cut = rng.permutation(len(whole))[: len(whole) * (100 - measure.per_cent) // 100]
                a, b = np.delete(whole, cut[::2]), np.delete(whole, cut[1::2])
                assert set(sample_keys(a, measure)) & set(sample_keys(b, measure))


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(out[i] == 0 for i in range(301)) and all(out[1000 + i] == 1000 for i in range(200)) and len(out) == 501
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []

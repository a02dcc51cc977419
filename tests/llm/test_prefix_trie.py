"""The conversation trie against a plain one, and the slots of its node tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import prefix_trie as P
from tidemark.llm.slots import Slots

TALK = T.StructType([T.StructField(n, T.LongType() if n in ("conv_id", "turn", "n") else T.StringType())
                     for n in ("conv_id", "turn", "role", "text", "pos", "first", "n", "piece", "extra.dot")])
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, "x", "x") for r in rows], TALK)


def plain(conversations: dict[int, list[tuple[str, str]]]):
    """Every node of the trie, the plain way."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        leaves = sum(not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in below) for n in below)
        ends = ",".join(map(str, sorted(c for c in ids if len(conversations[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def sequences(rows):
    by = {}
    for c, turn, role, text in rows:
        if c is not None:
            by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in by.items()}


def rebuild(conversations):
    out = {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + own[h:]
    return out


def got(df):
    return sorted((tuple(r) for r in df.select(*NODE).collect()), key=repr)


def made(n, rng, hot=0.4):
    rows = []
    for c in rng.sample(range(n * 2), n):
        same = rng.random() < hot
        for turn in range(2 if same else rng.randint(1, 7)):
            rows.append((c, turn, "user" if same else rng.choice(["user", "bot", None]),
                         f"hot {turn} words" if same else rng.choice(["a", "a b", "", None, "x" * 50_000, "ü\x0b1  2"])))
    return rows


def test_against_a_plain_trie(spark):
    rows = made(150, random.Random(5))
    assert got(P.prefix_trie(talks(spark, rows))) == plain(sequences(rows))


def test_rebuilt_conversations(spark):
    rows = made(150, random.Random(6))
    rows += [(1_000, 0, "user", "only")] + [(1_001 + i, 0, "user", "only") for i in range(19)]  # short first one; others lose all
    rows += [(2_021 + i, t, "user", f"t{t}") for i in range(6) for t in range(2)]  # first one absent, some without a turn
    whole = rebuild(sequences(rows))
    assert [] in whole.values()
    assert got(P.trie(*P.rebuilt(P.hashed_turns(talks(spark, rows))))) == plain(whole)


def test_long_conversations_in_pieces_and_many_shards(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(c, t, "user", f"w {t if t < 25 or c % 3 else c}") for c in range(12) for t in range(rng.randint(20, 40))]
    monkeypatch.setattr(P, "PIECE", 7)
    monkeypatch.setattr(P, "IDS", 3)
    monkeypatch.setattr(P, "SHARD_ROWS", 9)
    assert got(P.prefix_trie(talks(spark, rows))) == plain(sequences(rows))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (2, 5, "user", "first"), (2, 5, "user", "first"),
            (None, 0, "user", "nobody"), (3, 0, "user", "first"), (-7, 0, "user", "first")]
    assert got(P.prefix_trie(talks(spark, rows))) == plain(sequences(rows))


@pytest.mark.parametrize("of", [lambda df: P.prefix_trie(df), lambda df: P.trie(*P.rebuilt(P.hashed_turns(df)))])
def test_empty_table(spark, of):
    assert got(of(talks(spark, []))) == []


def test_slots_are_minimal_and_know_strangers():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-2**62, 2**62, 20_000), rng.integers(-2**62, 2**62, 20_000)
    a[:100], b[50:200] = 7, 7
    slots = Slots(np.r_[a, a[:500]], np.r_[b, b[:500]])
    at = slots.of(a, b)
    assert len(slots) == len(set(zip(a.tolist(), b.tolist()))) and set(at.tolist()) == set(range(len(slots)))
    assert (slots.first[at] == a).all() and (slots.second[at] == b).all()
    assert (slots.of(a + 1, b) == -1).all()
    assert len(Slots(a[:0], b[:0])) == 0 and len(Slots(a[:0], b[:0]).of(a, b)) == len(a)

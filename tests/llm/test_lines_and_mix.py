"""Line dedup and mixing against plain Python."""

import hashlib
from collections import defaultdict

from tidemark.llm.line_dedup import drop_repeated_lines
from tidemark.llm.mixing import mix_sources

BLANKS = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(BLANKS).translate(LOWER)
            if len(key) >= 20 and d is not None:
                holders[key].add(d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        gone = [d is not None and len(holders.get(k := x.strip(BLANKS).translate(LOWER), ())) >= 3 and max(holders[k]) != d for x in lines]
        out.append((d, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def test_lines(make_docs, odd_texts):
    shared, other = "This is a line THAT many hold", "ÀÉÎ another line of twenty"
    rows = [(i, f"{shared}\nown {i}\n  {shared.lower()}\t\n{other if i % 2 else 'short'}") for i in range(8)]
    rows += [(3, f"{shared}\nsecond text of three"), (3, f"{shared}\nsecond text of three"), (None, f"{shared}\n{shared}")]
    rows += [(20 + i, t) for i, t in enumerate(odd_texts)] + [(40, shared.upper()), (41, None)]
    rows += [(50 + i, f"{'y' * 19}\n{'z' * 20}\r\n {'z' * 20}") for i in range(3)]
    assert got(drop_repeated_lines(make_docs(rows))) == expected(rows)


def test_lines_keep_other_columns_and_replace_results(make_docs):
    docs = make_docs([(1, "x")]).withColumnRenamed("n", "n_lines")
    assert drop_repeated_lines(docs).columns == ["doc_id", "text", "source", "score", "pos", "size", "n_lines", "n_dropped"]
    assert drop_repeated_lines(docs.limit(0)).collect() == []


def water(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), budget * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix(make_docs, odd_texts):
    rows = [(i, "w " * (i * 7 % 50), f"s{i % 5 if i % 3 else 0}") for i in range(600)]
    rows += [(700 + i, t, None if i % 2 else "s1") for i, t in enumerate(odd_texts)] + [(5, "twice here", "s5")] * 2
    rows += [(None, "no id", "s9"), (None, None, None), (800, "", "s-empty")]
    out = mix_sources(make_docs(rows)).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in out:
        sizes[r.source] += r.size
    want, taken = water(sizes), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.size * r.times and r.times in (0, 1, 2) and (r.size or not r.times)
        taken[r.source] += r.taken
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) + 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max([r.size for r in out if r.source == s])
    assert {r.times for r in out if r.text == "twice here"} == {0} or len({r.times for r in out if r.text == "twice here"}) == 1
    again = mix_sources(make_docs(rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))
    big = next(r for r in out if r.text and len(r.text) == 300_000)
    assert big.size == 1 and hashlib.sha256(big.text.encode()).hexdigest()


def test_mix_of_nothing(make_docs):
    assert mix_sources(make_docs([]).limit(0)).collect() == []
    only = mix_sources(make_docs([(1, None, "a"), (2, " ", None)])).collect()
    assert [(r.size, r.taken, r.target) for r in only] == [(0, 0, 0.0)] * 2

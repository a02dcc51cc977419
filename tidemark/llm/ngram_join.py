"""Documents that share most of their word n-grams, joined through signature trees.

A document's signature is the bitmap of its shingles.  A tree's inner nodes hold
the OR of the bitmaps below, the range of set sizes and the most shingles that a
bitmap hides; a pair of nodes is left out if even the most shingles that any two
documents below could have in common are too few, or their sizes too different.
What the traversal of a tree against itself reaches is compared exactly.

One tree over a whole corpus would sit in one task and, as the OR of many
bitmaps has nearly all bits set, leave out nothing near its root.  So documents
are first dealt to trees.  Documents with equal sets are one class.  Classes that
agree in one of many samples of their smallest hashes go to the same tree; two
that should link disagree in all samples with a chance below 1e-8.  A tree that is
too large for a task is cut into blocks by size, and pairs of blocks whose sizes
allow a link are traversed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import SMALL, add_from_text, table, without
from tidemark.llm.components import Forest, components
from tidemark.llm.registry import query
from tidemark.plans.joins import join_checked
from tidemark.plans.storage import stage

#: Bits of a signature, children of a tree node, and shingles that one block of trees holds.
BITS, FANOUT, BLOCK_SHINGLES = 4_096, 8, 1_500_000
#: Sets below this size are sampled with fewer hashes, since a sample must be much smaller than the set.
SMALL_SET = 64


@dataclass(frozen=True)
class Measure:
    """Shingles of ``words`` words; documents link if ``per_cent`` x union <= 100 x intersection."""

    words: int = 3
    per_cent: int = 90

    def links(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.per_cent * (a + b - common)

    def needed(self, a: int, b: int) -> int:
        """The least intersection of linked sets of at least these sizes."""
        return -(-self.per_cent * (a + b) // (100 + self.per_cent))

    def sizes_allow(self, low: int, high: int) -> bool:
        return 100 * low >= self.per_cent * high

    def samples(self, small: bool) -> tuple[int, int]:
        """Hashes per sample and number of samples, for a miss below 1e-8 at the least similarity."""
        t = self.per_cent / 100
        each = max(2, round(math.log(0.4) / math.log(t)) // (3 if small else 1))
        size = max(each + 1, math.ceil(1 / (1 - t))) if small else SMALL_SET
        common = math.floor(t * size)
        agree = math.prod((common - j) / (size - j) for j in range(each))
        return each, math.ceil(math.log(1e-8) / math.log(1 - agree))


def _mix(x):
    """Bits of unsigned 64-bit numbers spread over all places."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles; hashes of words are kept per task."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def _hash(self, word: bytes) -> int:
        import xxhash

        if len(self.known) > 200_000:
            self.known.clear()
        value = self.known[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str | None):
        import numpy as np

        # bytes.lower and bytes.split know ASCII letters and ASCII white space only, as wanted here.
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        get, new = self.known.get, self._hash
        hashes = np.fromiter((h if (h := get(w)) is not None else new(w) for w in found), np.uint64, len(found))
        width = min(self.words, len(found))
        total = np.full(len(found) - width + 1, width, np.uint64)
        for k in range(width):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - width + 1 + k])
        return np.unique(total)


@lru_cache
def _orders(count: int, small: bool):
    """Factors and shifts of ``count`` orders of 64-bit hashes."""
    import numpy as np

    rng = np.random.default_rng([10, small])
    factors, shifts = rng.integers(0, 2**64, (2, count, 1), dtype=np.uint64)
    return factors | np.uint64(1), shifts


def sample_keys(values, measure: Measure):
    """One key per sample of a set: a hash of its smallest members in an order of the sample's own."""
    import numpy as np

    keys = [np.zeros(0, np.uint64)]
    for small in (False, True):
        applies = len(values) < SMALL_SET if small else measure.sizes_allow(len(values), SMALL_SET)
        if not applies:
            continue
        each, count = measure.samples(small)
        factors, shifts = _orders(count, small)
        step = max(1, 1_000_000 // len(values))  # samples at a time, for a few MB
        for start in range(0, count, step):
            order = ((values * factors[start:start + step] + shifts[start:start + step]) >> np.uint64(32)).astype(np.uint32)
            if len(values) > each:
                order = np.partition(order, each - 1, axis=1)[:, :each]
            order.sort(axis=1)
            odd = np.arange(1, 2 * order.shape[1], 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            number = np.arange(start, start + len(order), dtype=np.uint64) * np.uint64(2) + np.uint64(small)
            keys.append(_mix((order * odd).sum(axis=1, dtype=np.uint64) + number))
    return np.concatenate(keys).view(np.int64).tolist()


def _signed(docs: DataFrame, measure: Measure) -> DataFrame:
    """``n_shingles``, ``_set`` (128-bit fingerprint of the set) and ``_keys`` of its samples."""

    def start():
        import xxhash

        shingles = Shingles(measure.words)

        def one(text):
            values = shingles.of(text)
            if not len(values):
                return 0, None, None
            return len(values), xxhash.xxh3_128_digest(values.tobytes()), sample_keys(values, measure)

        return lambda texts: list(zip(*map(one, texts)))

    return add_from_text(docs, "n_shingles bigint, _set binary, _keys array<bigint>", start).drop("text")


def _dealt(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all classes with a key in common.

    Rows are range-partitioned by key and node, so that a key of very many
    classes lies in several tasks; each task connects neighbours with equal keys,
    and the keys at its ends connect it with the next.
    """
    rows = classes.select(F.explode("_keys").alias("key"), "node").repartitionByRange("key", "node").sortWithinPartitions("key", "node")

    def connect(batches):
        import numpy as np
        import pyarrow as pa

        forest, first, last = Forest(), None, None
        for batch in batches:
            keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            if first is None:
                first = (int(keys[0]), int(nodes[0]))
            elif last[0] == keys[0]:
                forest.join(last[1], int(nodes[0]))
            for i in np.flatnonzero(keys[1:] == keys[:-1]).tolist():
                forest.join(int(nodes[i]), int(nodes[i + 1]))
            last = (int(keys[-1]), int(nodes[-1]))
        links = forest.links()
        ends = [(k, n, n) for k, n in ((first, last) if first else ())]
        out = ends + [(None, a, b) for a, b in links]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))],
                                         names=["key", "a", "b"])

    found = stage(rows.mapInArrow(connect, "key bigint, a bigint, b bigint"), "ngram-links")
    ends = found.where("key IS NOT NULL")
    across = ends.join(ends.groupBy("key").agg(F.min("a").alias("m")), "key").select("a", F.col("m").alias("b"))
    return found.where("key IS NULL").select("a", "b").union(across).where("a <> b")


class _Tree:
    """A node of a signature tree: bitmap, sizes, hidden shingles, and children or a document."""

    __slots__ = ("bits", "low", "high", "hidden", "children", "doc", "whole")

    def __init__(self, bits, low, high, hidden, children, doc):
        self.bits, self.low, self.high, self.hidden = bits, low, high, hidden
        self.children, self.doc, self.whole = children, doc, doc is not None


def _bitmap(values) -> int:
    import numpy as np

    bits = np.zeros(BITS, np.uint8)
    bits[(values % np.uint64(BITS)).astype(np.int64)] = 1
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def build_tree(sets: list) -> _Tree:
    """A tree over sets sorted by size, then by smallest member."""
    level = []
    for doc in sorted(range(len(sets)), key=lambda d: (len(sets[d]), int(sets[d][0]))):
        bits, n = _bitmap(sets[doc]), len(sets[doc])
        level.append(_Tree(bits, n, n, n - bits.bit_count(), (), doc))
    while len(level) > 1:
        groups = [level[i:i + FANOUT] for i in range(0, len(level), FANOUT)]
        level = []
        for g in groups:
            bits = 0
            for x in g:
                bits |= x.bits
            level.append(_Tree(bits, min(x.low for x in g), max(x.high for x in g), max(x.hidden for x in g), g, None))
    return level[0]


def traverse(root: _Tree, sets: list, nodes: list[int], measure: Measure, forest: Forest, apart=None) -> None:
    """Connect all linked documents of a tree; pairs already connected are not compared.

    ``apart(a, b)`` may exclude pairs that another task compares.
    """
    import numpy as np

    def first(x):
        while x.doc is None:
            x = x.children[0]
        return x.doc

    def connected(x) -> bool:
        """Whether all documents below are known to be in one component; once true, it stays."""
        if not x.whole and all(map(connected, x.children)):
            x.whole = len({forest.find(nodes[first(c)]) for c in x.children}) == 1
        return x.whole

    stack = [(root, root)]
    while stack:
        x, y = stack.pop()
        if not measure.sizes_allow(x.low if x.low > y.high else x.high, y.low if x.low > y.high else y.low) and x.high < y.low:
            continue
        if y.high < x.low and not measure.sizes_allow(y.high, x.low):
            continue
        if (x.bits & y.bits).bit_count() + min(x.hidden, y.hidden) < measure.needed(x.low, y.low):
            continue
        if x.doc is not None and y.doc is not None:
            a, b = x.doc, y.doc
            if a == b or (apart and apart(a, b)) or forest.find(nodes[a]) == forest.find(nodes[b]):
                continue
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if measure.links(common, len(sets[a]), len(sets[b])):
                forest.join(nodes[a], nodes[b])
            continue
        if connected(x) and connected(y) and forest.find(nodes[first(x)]) == forest.find(nodes[first(y)]):
            continue
        if x is y:
            own = x.children  # the last pushed go first: each child with itself, then with its siblings
            stack += [(own[i], own[j]) for i in range(len(own)) for j in range(i + 1, len(own))]
            stack += [(c, c) for c in own]
        elif y.doc is not None or (x.doc is None and x.high - x.low >= y.high - y.low):
            stack += [(c, y) for c in x.children]
        else:
            stack += [(x, c) for c in y.children]


def _blocks(members: DataFrame, measure: Measure) -> DataFrame:
    """Each member's tasks: ``_task`` and ``_own`` (its block), one row per task.

    Small trees share tasks by hash.  A large one is cut into blocks of about
    equal size: by bands of set size that can only link with themselves and the
    next, and by hash within a band; every two such blocks meet in one task.
    """
    per_tree = members.groupBy("tree").agg(F.sum("n_shingles").alias("_sum"))
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    shared = max(16, math.ceil(4 * total / BLOCK_SHINGLES))
    large = stage(per_tree.where(F.col("_sum") > BLOCK_SHINGLES).select("tree"), "ngram-large")
    band = F.floor(F.log(F.col("n_shingles") + F.lit(0.5)) / F.lit(math.log(100 / measure.per_cent))).cast("int")
    marked = join_checked(members, large.withColumn("_large", F.lit(True)), ["tree"], "left", limit=SMALL)
    small = marked.where("_large IS NULL").select("node", "tree", F.pmod(F.xxhash64("tree"), F.lit(shared)).cast("string").alias("_task"),
                                                  F.lit(0).alias("_own"))
    banded = marked.where("_large").withColumn("_band", band)
    parts = stage(banded.groupBy("tree", "_band").agg(
        F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES / 2)).cast("int").alias("_parts")), "ngram-bands")
    following = parts.select("tree", (F.col("_band") - 1).alias("_band"), F.col("_parts").alias("_after"))
    before = parts.select("tree", (F.col("_band") + 1).alias("_band"), F.col("_parts").alias("_before"))
    sized = parts.join(following, ["tree", "_band"], "left").join(before, ["tree", "_band"], "left").fillna(0)
    mine = (join_checked(banded, sized, ["tree", "_band"], limit=SMALL)
            .withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int")))
    name = lambda a, i, b, j: F.concat_ws("/", "tree", a, i, b, j)
    every = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array())
    tasks = F.concat(
        F.transform(every(F.col("_parts")), lambda j: name(F.col("_band"), F.least(F.col("_own"), j), F.col("_band"), F.greatest(F.col("_own"), j))),
        F.transform(every(F.col("_after")), lambda j: name(F.col("_band"), F.col("_own"), F.col("_band") + 1, j)),
        F.transform(every(F.col("_before")), lambda j: name(F.col("_band") - 1, j, F.col("_band"), F.col("_own"))))
    return small.union(mine.select("node", "tree", F.explode(tasks).alias("_task"), "_own"))


def link_classes(docs: DataFrame, classes: DataFrame, measure: Measure) -> DataFrame:
    """(a, b) edges between classes (named by ``node``, their smallest doc_id) that give the true components."""
    trees = stage(components(_dealt(classes)).select("node", F.col("component").alias("tree")), "ngram-trees")
    members = stage(join_checked(classes.select("node", "n_shingles"), trees, ["node"], limit=SMALL), "ngram-members")
    tasks = stage(_blocks(members, measure), "ngram-tasks")

    def start():
        shingles = Shingles(measure.words)
        return lambda texts: [[shingles.of(t).tobytes() for t in texts]]

    mine = docs.select("doc_id", "text").join(F.broadcast(tasks), docs["doc_id"] == tasks["node"]) if _fits(tasks) else \
        docs.select("doc_id", "text").join(tasks, docs["doc_id"] == tasks["node"])
    # Sets are made once per document, then copied to its tasks.
    texts = mine.groupBy("node", "text").agg(F.collect_list(F.struct("tree", "_task")).alias("_tasks"))
    sets = add_from_text(texts, "shingles binary", start).drop("text").select("node", "shingles", F.inline("_tasks"))

    def run(rows):
        import numpy as np
        import pandas as pd

        forest = Forest()
        for _, tree in rows.groupby("tree"):
            values = [np.frombuffer(b, np.uint64) for b in tree["shingles"]]
            nodes = tree["node"].tolist()
            held = [i for i, v in enumerate(values) if len(v)]
            if len(held) > 1:
                values, nodes = [values[i] for i in held], [nodes[i] for i in held]
                traverse(build_tree(values), values, nodes, measure, forest)
        return pd.DataFrame(forest.links(), columns=["a", "b"], dtype="int64")

    return stage(sets.groupBy("_task").applyInPandas(run, "a bigint, b bigint"), "ngram-edges")


def _fits(tasks: DataFrame) -> bool:
    from tidemark.plans.joins import measure as small_enough

    return small_enough(tasks, SMALL)


def join_ngrams(docs: DataFrame, words: int = 3, per_cent: int = 90) -> DataFrame:
    """``docs`` without ``text``, with ``n_shingles`` and ``component_id``.

    Words are split at ASCII white space, with A-Z in lower case.  A text of
    fewer words than a shingle is one shingle.  A null or empty text has none and
    links with nothing; its component is its own id.  ``doc_id`` is an integer;
    rows without it link with nothing and have no component.  Rows that repeat a
    ``doc_id`` are judged by their own text, and two classes of texts with the
    same smallest ``doc_id`` are one.  Columns named as the results are replaced.
    """
    measure = Measure(words, per_cent)
    docs = docs.select(*without(docs, ["n_shingles", "component_id", "_set", "_keys"]))
    signed = stage(_signed(docs, measure), "ngram-signed")
    known = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(known.groupBy("_set").agg(F.min("doc_id").cast("bigint").alias("node"), F.first("n_shingles").alias("n_shingles"),
                                              F.count(F.lit(1)).alias("_copies"), F.first("_keys").alias("_keys")), "ngram-classes")
    edges = link_classes(docs, classes, measure)
    joined = stage(components(edges), "ngram-components")
    # Only classes with copies or links need their component; all other documents are alone.
    named = join_checked(classes.select("_set", "node", "_copies"), joined, ["node"], "left", limit=SMALL)
    several = stage(named.where("_copies > 1 OR component IS NOT NULL")
                    .select("_set", F.coalesce("component", "node").alias("component_id")), "ngram-several")
    return (join_checked(signed.drop("_keys"), several, ["_set"], "left", limit=SMALL)
            .withColumn("component_id", F.coalesce("component_id", F.col("doc_id"))).drop("_set"))


@query("op10_ngram_join")
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their near-duplicates."""
    return join_ngrams(table(spark, sf_dir, "documents").select("doc_id", "text"))

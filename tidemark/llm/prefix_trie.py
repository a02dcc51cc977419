"""The trie of conversation prefixes, counted in node tables of minimal perfect hash slots.

A prefix is known by a 128-bit digest, the exclusive or of a hash of each of its
turns with its place.  Conversations are cut into shards by ranges of
``conv_id``; each shard enumerates its distinct digests, gives them slots and
scatters its counts into flat arrays.  Whatever is summed over subtrees is put
at one conversation only, the smallest that has the node, and goes up through
the parent slots of that conversation's shard, deepest first.  A shard holds all
prefixes of its conversations, so it never asks another one, and a prefix that
a third of all conversations share is one slot in every shard: rows are added
up before they meet.  Conversations of very many turns are cut into pieces; what
a piece sums up is handed to the deepest node of the pieces before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import SMALL, table
from tidemark.llm.registry import query
from tidemark.llm.slots import Slots
from tidemark.plans.joins import join_checked
from tidemark.plans.ranking import running_number
from tidemark.plans.storage import stage, task_count

#: Rows of a shard, turns of a piece, and ids that are written in one text.
SHARD_ROWS, PIECE, IDS = 100_000, 4_096, 65_536

LOCAL = ("shard int, slot int, parent_slot int, first bigint, second bigint, up_first bigint, up_second bigint, "
         "depth bigint, words bigint, n bigint, conv_id bigint")


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id``, ``pos`` from 1, two hashes of role and text, and words of the text.

    Turns stand by ``turn`` (null first); ties by their hashes, so a tie has one
    order and repeated rows are turns of their own.  A null role or text is
    empty.  Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    slim = stage(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(7), role, text).alias("b"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words")), "turns")
    return running_number(slim, ["conv_id"], ["turn", "a", "b"], "pos").drop("turn")


def _head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame, group: int = 20) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of their group's first conversation.

    Conversation c takes the first h turns of c - c % ``group`` (all if it has
    fewer, none if there is no such conversation), then its own after its first
    h; h is crc32 of its decimal id, modulo 4.  Returns turns as
    ``hashed_turns`` gives them, and all ids, also those left without a turn.
    """
    turns = stage(turns, "numbered")
    ids = stage(turns.select("conv_id").distinct(), "conversations")
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = turns.where((F.col("pos") <= 3) & (base == F.col("conv_id"))).groupBy(F.col("conv_id").alias("base")).agg(
        F.collect_list(F.struct("pos", "a", "b", "words")).alias("heads"))
    taken = stage(ids.select("conv_id", base.alias("base"), _head(F.col("conv_id")).alias("h")).join(heads, "base", "left")
                  .select("conv_id", "h", F.filter(F.coalesce("heads", F.array()), lambda t: t["pos"] <= F.col("h")).alias("heads")),
                  "heads")
    begun = taken.select("conv_id", F.inline("heads"))
    # A short or absent first conversation moves the own turns up.
    moved = taken.where(F.size("heads") < F.col("h")).select("conv_id", (F.col("h") - F.size("heads")).alias("less"))
    own = join_checked(turns.where(F.col("pos") > _head(F.col("conv_id"))), moved, ["conv_id"], "left", limit=SMALL)
    own = own.select("conv_id", (F.col("pos") - F.coalesce("less", F.lit(0))).alias("pos"), "a", "b", "words")
    return begun.select(own.columns).union(own), ids


def prefixes(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation and prefix, the empty one included, with the prefix's digest and its parent's."""
    rows = turns.select("conv_id", "pos", "a", "b", "words").union(
        ids.select("conv_id", F.lit(0).cast("bigint"), *[F.lit(0).cast("bigint")] * 3))
    piece = F.floor(F.col("pos") / PIECE).cast("int")
    rows = stage(rows.select("conv_id", "pos", piece.alias("piece"), "words", F.xxhash64("pos", "a", "b").alias("m1"),
                             F.xxhash64(F.lit(7), "pos", "a", "b").alias("m2")), "prefix-turns")
    here = Window.partitionBy("conv_id", "piece").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({"first": F.bit_xor("m1").over(here), "second": F.bit_xor("m2").over(here)})
    if not rows.where("piece > 0").isEmpty():
        before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        sums = rows.groupBy("conv_id", "piece").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"))
        sums = stage(sums.select("conv_id", "piece", F.bit_xor("m1").over(before).alias("o1"),
                                 F.bit_xor("m2").over(before).alias("o2")).where("piece > 0"), "prefix-pieces")
        out = join_checked(out, sums, ["conv_id", "piece"], "left", limit=SMALL).withColumns({
            "first": F.col("first").bitwiseXOR(F.coalesce("o1", F.lit(0))),
            "second": F.col("second").bitwiseXOR(F.coalesce("o2", F.lit(0)))})
    above = F.col("pos") > 0
    return stage(out.select("conv_id", "piece", F.col("pos").alias("depth"), (F.col("pos") % PIECE == 0).alias("cut"), "words", "first", "second",
                            F.when(above, F.col("first").bitwiseXOR(F.col("m1"))).alias("up_first"),
                            F.when(above, F.col("second").bitwiseXOR(F.col("m2"))).alias("up_second")), "prefixes")


def _node_tables(batches):
    """The node table of a shard, one row per slot."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    no_parent, cut = whole["up_first"].is_null().to_numpy(), whole["cut"].to_numpy()
    col = {c: whole[c].fill_null(0).to_numpy() for c in ("conv_id", "depth", "words", "first", "second", "up_first", "up_second")}
    slots = Slots(col["first"], col["second"])
    at = slots.of(col["first"], col["second"])
    flat = {c: np.zeros(len(slots), dtype=np.int64) for c in ("depth", "words", "up_first", "up_second")}
    for c in flat:
        flat[c][at] = col[c]
        if not (flat[c][at] == col[c]).all():
            raise ValueError("two different prefixes have the same digest")
    flat["n"] = np.bincount(at, minlength=len(slots))
    flat["conv_id"] = np.full(len(slots), np.iinfo(np.int64).max)
    np.minimum.at(flat["conv_id"], at, col["conv_id"])
    top, first = np.zeros(len(slots), dtype=bool), np.zeros(len(slots), dtype=bool)
    top[at], first[at] = no_parent, cut
    # A piece ends at its first node, also where the piece before it is in the same shard.
    parent = np.where(first, -1, slots.of(flat["up_first"], flat["up_second"]))
    flat |= {"shard": np.full(len(slots), TaskContext.get().partitionId()), "slot": np.arange(len(slots)),
             "parent_slot": parent, "first": slots.first, "second": slots.second}
    small = {"shard", "slot", "parent_slot"}
    names = [part.split()[0] for part in LOCAL.split(", ")]
    yield pa.RecordBatch.from_arrays(
        [pa.array(flat[c], pa.int32() if c in small else pa.int64(), mask=top if c.startswith("up_") else None) for c in names],
        names=names)


def _gather(local, given):
    """Values given at nodes of a shard, summed over their subtrees within it."""
    import numpy as np
    import pyarrow as pa

    col = {c: local[c].to_numpy() for c in ("slot", "parent_slot", "depth", "first", "second")}
    slots = Slots(col["first"], col["second"])
    parent, depth = np.empty(len(slots), dtype=np.int64), np.empty(len(slots), dtype=np.int64)
    parent[col["slot"]], depth[col["slot"]] = col["parent_slot"], col["depth"]
    at = slots.of(given["first"].to_numpy(), given["second"].to_numpy())
    if (at < 0).any():
        raise ValueError("a node is not in the table of its shard")
    sums = []
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)[::-1]
    levels = [level[parent[level] >= 0] for level in levels] if len(slots) else []
    for c in ("saved", "leaves"):
        total = np.zeros(len(slots), dtype=np.int64)
        np.add.at(total, at, given[c].to_numpy())
        for level in levels:
            np.add.at(total, parent[level], total[level])
        sums.append(total)
    some = (sums[0] != 0) | (sums[1] != 0)
    return pa.table({"first": slots.first[some], "second": slots.second[some], "saved": sums[0][some], "leaves": sums[1][some]})


def _handed_down(rows: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """What conversations of several pieces sum up in later pieces, at the last node of each piece before."""
    if rows.where("piece > 0").isEmpty():
        return None
    later = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(1, Window.unboundedFollowing)
    whole = nodes.groupBy("conv_id", F.floor(F.col("depth") / PIECE).cast("int").alias("piece")).agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    none = F.lit(0).cast("bigint")
    ends = rows.where(F.col("depth") % PIECE == PIECE - 1).select("conv_id", "piece", "first", "second")
    # Pieces in which a conversation has no node of its own still pass on what comes after them.
    marks = whole.unionByName(ends.select("conv_id", "piece", none.alias("saved"), none.alias("leaves")))
    after = marks.groupBy("conv_id", "piece").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    after = after.select("conv_id", "piece", *[F.sum(c).over(later).alias(c) for c in ("saved", "leaves")])
    owed = ends.join(after.where("saved > 0 OR leaves > 0"), ["conv_id", "piece"])
    return owed.join(nodes.select("first", "second", "shard"), ["first", "second"]).select(
        "shard", "first", "second", "saved", "leaves")


def _packed(at_most: int):
    """Runs of ids of one node as text, so many of them in a row at most."""
    def run(batches):
        import pyarrow as pa

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*done), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["first", "second", "conv_id", "ids"])

        key, held, done, size = None, [], [], 0
        for batch in batches:
            for node, conv in zip(zip(batch["first"].to_pylist(), batch["second"].to_pylist()), batch["conv_id"].to_pylist()):
                if held and (node != key or len(held) == at_most):
                    done.append((*key, held[0], ",".join(map(str, held))))
                    size, held = size + len(held), []
                    if size >= at_most:
                        yield out(done)
                        done, size = [], 0
                key = node
                held.append(conv)
        if held:
            done.append((*key, held[0], ",".join(map(str, held))))
        if done:
            yield out(done)

    return run


def _chained(batches):
    """SHA-256 of each node's texts, which come in order, one after the other."""
    import hashlib

    import pyarrow as pa

    key, state = None, None
    for batch in batches:
        done = []
        for node, ids in zip(zip(batch["first"].to_pylist(), batch["second"].to_pylist()), batch["ids"]):
            if node == key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["first", "second", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])],
                                         names=["first", "second", "ends_sha256"])


def end_digests(rows: DataFrame) -> DataFrame:
    """Per node SHA-256 of the ids of the conversations that end there, ascending, joined by commas.

    SHA-256 goes through its input in order.  So ids are put in order and written
    as texts by many tasks; one task then only reads the few texts of a node.
    """
    last = stage(rows.groupBy("conv_id").agg(F.max(F.struct("depth", "first", "second")).alias("_end"))
                 .select("conv_id", "_end.first", "_end.second"), "ends")
    parts = task_count(rows.sparkSession)
    texts = (last.repartitionByRange(parts, "conv_id").sortWithinPartitions("first", "second", "conv_id")
             .mapInArrow(_packed(IDS), "first bigint, second bigint, conv_id bigint, ids string"))
    return (texts.repartition(parts, "first", "second").sortWithinPartitions("first", "second", "conv_id")
            .mapInArrow(_chained, "first bigint, second bigint, ends_sha256 string"))


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """The nodes of the trie of hashed turns: see ``prefix_trie``."""
    rows = prefixes(turns, ids)
    spark = rows.sparkSession
    shards = max(task_count(spark), -(-rows.count() // SHARD_ROWS))
    local = stage(rows.repartitionByRange(shards, "conv_id", "piece").mapInArrow(_node_tables, LOCAL), "node-tables")
    same = [F.when(F.min(c).eqNullSafe(F.max(c)), F.max(c)).otherwise(
        F.raise_error(F.lit("two different prefixes have the same digest")).cast("bigint")).alias(c)
        for c in ("up_first", "up_second", "depth", "words")]
    found = stage(local.groupBy("first", "second").agg(
        F.sum("n").alias("n_convs"), F.min(F.struct("conv_id", "shard")).alias("_own"), *same), "nodes")
    kids = found.where(F.col("depth") > 0).groupBy(F.col("up_first").alias("first"), F.col("up_second").alias("second")).agg(
        F.count(F.lit(1)).alias("n_children"))
    children = F.coalesce("n_children", F.lit(0))
    nodes = stage(found.join(kids, ["first", "second"], "left").select(
        "first", "second", "up_first", "up_second", "depth", "n_convs", "_own.conv_id", "_own.shard",
        children.alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (children == 0).cast("bigint").alias("leaves")), "nodes-with-children")
    given = nodes.where("saved > 0 OR leaves > 0").select("shard", "first", "second", "saved", "leaves")
    owed = _handed_down(rows, nodes)
    given = given if owed is None else given.union(owed)
    sums = (local.select("shard", "slot", "parent_slot", "depth", "first", "second").groupBy("shard")
            .cogroup(given.groupBy("shard")).applyInArrow(_gather, "first bigint, second bigint, saved bigint, leaves bigint")
            .groupBy("first", "second").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")))
    # Only nodes that are not of their parent's conversation have to ask who the parent is.
    named = nodes.where("n_children > 0").select(F.col("first").alias("up_first"), F.col("second").alias("up_second"),
                                                 F.col("conv_id").alias("parent_conv_id"))
    out = (nodes.drop("saved", "leaves", "shard").join(sums, ["first", "second"], "left")
           .join(end_digests(rows), ["first", "second"], "left"))
    return join_checked(out, stage(named, "parents"), ["up_first", "up_second"], "left", limit=SMALL).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns (role, text) of conversations, from the empty one on.

    ``conv_id`` is the smallest conversation that begins so, and ``depth`` the
    number of turns, which together find the turn in the table; ``n_convs``
    conversations begin so, ``n_children`` nodes follow, ``n_leaves`` nodes of
    the subtree have none.  ``saved_tokens`` are the words that sharing the
    prefixes of the subtree saves, each node's (n_convs - 1) times the words of
    its last text.  ``ends_sha256`` stands for the conversations that end here.

    Turns stand by ``turn``, null first; ties, repeated rows, nulls and rows
    without ``conv_id`` as ``hashed_turns`` says.  Texts of any length are
    hashed where they are read and never moved.  Other columns are not looked
    at.  No conversation at all gives no node, not even the empty prefix.
    """
    turns = stage(hashed_turns(conversations), "numbered")
    return trie(turns, turns.select("conv_id").distinct())


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (SELECT c, list({'role': role, 'text': text} ORDER BY i) AS seq FROM turns GROUP BY c),
hashed AS (
  SELECT c, seq, c::VARCHAR AS s,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, bit: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
  FROM own
), whole AS (
  SELECT a.c, list_concat(coalesce(b.seq, [])[1:a.h], a.seq[a.h + 1:]) AS seq
  FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 20
), path AS (
  SELECT c, d, md5(seq[1:d]::VARCHAR || '#' || d) AS node, CASE WHEN d > 0 THEN md5(seq[1:d - 1]::VARCHAR || '#' || (d - 1)) END AS parent,
         CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words, d = len(seq) AS ends
  FROM whole, unnest(range(0, len(seq) + 1)) AS r(d)
), node AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM path GROUP BY node
), kids AS (SELECT parent AS node, count(*) AS n FROM node WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT a.node, sum(n.saved) AS saved_tokens, count(*) FILTER (k.n IS NULL) AS n_leaves
  FROM node n JOIN path m ON m.node = n.node AND m.c = n.conv_id JOIN path a ON a.c = n.conv_id AND a.d <= n.depth
  LEFT JOIN kids k ON k.node = n.node GROUP BY a.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node JOIN below b ON b.node = n.node
"""


@query("op13_prefix_trie", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(hashed_turns(table(spark, sf_dir, "conversations"))))

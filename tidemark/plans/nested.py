"""Range join over nested prefixes: every text meets the prefixes that it begins with.

The prefixes of a container are a forest: sorted, each stands before those that
it encloses.  A text belongs at its deepest enclosing prefix, and the prefixes
that enclose that one are all others that it begins with.  The deepest one is
found by a search over prefix lengths, which halves them with each equality
lookup: shorter heads of prefixes are markers that say "longer ones may match",
and carry the deepest prefix they begin with themselves.  So a text takes as
many lookups as the logarithm of the number of lengths, is never copied, and is
joined once, with exactly its prefixes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.joins import BroadcastLimit, measure
from tidemark.plans.storage import stage, task_count

# Rows that a task returns at a time.
BATCH = 10_000


@dataclass(frozen=True)
class Forest:
    """Nested prefixes of containers.

    ``markers`` (container, text, node): heads of prefixes that the search looks
    up, each with the deepest prefix it begins with.  ``chains`` (container,
    node, anchor): each prefix with itself and all that enclose it.
    """

    markers: DataFrame
    chains: DataFrame
    levels: list[int]
    folders: bool


def _parts(text: str, folders: bool):
    return tuple(text.split("/")) if folders and text else () if folders else text


def _begins(text, prefix) -> bool:
    return text[:len(prefix)] == prefix


def sweep(prefixes: list[str], levels: list[int], folders: bool):
    """Markers and chains of one container: (head, deepest prefix or None) and (prefix, enclosing prefix)."""
    nodes = {_parts(p, folders): p for p in prefixes}
    place = {n: i for i, n in enumerate(levels)}
    heads = set()
    for node in nodes:
        low, high, own = 0, len(levels) - 1, place[len(node)]
        while low <= high:
            mid = (low + high) // 2
            if mid <= own:
                heads.add(node[:levels[mid]])
                low = mid + 1
            else:
                high = mid - 1
    around: list = []
    for head in sorted(heads | nodes.keys()):
        while around and not _begins(head, around[-1]):
            around.pop()
        if head in nodes:
            around.append(head)
            for outer in around:
                yield "chain", nodes[head], nodes[outer]
        if head in heads:
            yield "marker", "/".join(head) if folders else head, nodes[around[-1]] if around else None


def nest(prefixes: DataFrame, levels: list[int], folders: bool) -> Forest:
    """The forest of distinct prefixes (container, anchor), which must be few enough to broadcast.

    ``levels`` are the lengths that occur: characters, or with ``folders`` path
    parts, in which case a prefix ends between two parts.
    """
    def run(batches):
        import pyarrow as pa

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["container", "kind", "a", "b"])

        def groups():
            name, held = None, []
            for batch in batches:
                for container, anchor in zip(batch["container"].to_pylist(), batch["anchor"].to_pylist()):
                    if container != name and held:
                        yield name, held
                        held = []
                    name = container
                    held.append(anchor)
            if held:
                yield name, held

        rows = []
        for container, held in groups():
            for row in sweep(held, levels, folders):
                rows.append((container, *row))
                if len(rows) == BATCH:
                    yield out(rows)
                    rows = []
        if rows:
            yield out(rows)

    kept = prefixes.where(F.col("container").isNotNull() & F.col("anchor").isNotNull()).distinct()
    dealt = kept.repartition(task_count(prefixes.sparkSession), "container").sortWithinPartitions("container")
    found = stage(dealt.mapInArrow(run, "container string, kind string, a string, b string"), "nested")
    return Forest(found.where("kind = 'marker'").select("container", F.col("a").alias("text"), F.col("b").alias("node")),
                  found.where("kind = 'chain'").select("container", F.col("a").alias("node"), F.col("b").alias("anchor")),
                  levels, folders)


def fits(forest: Forest, limit: BroadcastLimit) -> bool:
    """Whether the lookups can be broadcast joins."""
    return measure(forest.markers, limit)


def locate(df: DataFrame, forest: Forest, text: Column, length: Column, out: str = "node") -> DataFrame:
    """Add the deepest enclosing prefix of a text, null if there is none, without copying or shuffling a row.

    ``length`` is the text's length in the unit of the levels.
    """
    lengths = F.array(*[F.lit(n) for n in forest.levels])
    names, low, high = df.columns, F.col("_nest_low"), F.col("_nest_high")
    found = df.withColumns({"_nest_text": text, "_nest_length": length, "_nest_low": F.lit(0), "_nest_high": F.lit(len(forest.levels) - 1),
                            out: F.lit(None).cast("string")})
    markers = F.broadcast(forest.markers.select(F.col("container").alias("_m_container"), F.col("text").alias("_m_text"),
                                                F.col("node").alias("_m_node")))
    for _ in range(len(forest.levels).bit_length()):
        mid = F.shiftright(low + high, 1)
        level = F.get(lengths, mid)
        head = (F.call_function("substring_index", F.col("_nest_text"), F.lit("/"), level) if forest.folders
                else F.substring(F.col("_nest_text"), F.lit(1), level))
        asked = found.withColumns({"_nest_mid": mid, "_nest_head": F.when((low <= high) & (F.col("_nest_length") >= level), head)})
        met = asked.join(markers, (F.col("container") == F.col("_m_container")) & (F.col("_nest_head") == F.col("_m_text")), "left")
        hit = F.col("_m_text").isNotNull()
        found = met.select(*names, "_nest_text", "_nest_length", F.when(hit, F.col("_nest_mid") + 1).otherwise(low).alias("_nest_low"),
                           F.when(hit, high).otherwise(F.col("_nest_mid") - 1).alias("_nest_high"),
                           F.coalesce("_m_node", out).alias(out))
    return found.select(*names, out)

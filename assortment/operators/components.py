"""Connected components by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assortment.sources.lineage import cut, shuffled

HOPS = 2


def connected_components(
    nodes: DataFrame, edges: DataFrame, keys: tuple[str, ...] = (), many: bool = False
) -> DataFrame:
    """(*keys, node, component): component = smallest node that is reachable.

    `nodes` holds (*keys, node), `edges` (*keys, a, b); `keys` name independent graphs that are
    solved together. Each round every node points to its smallest neighbour, pointers are followed
    a few hops, edges are drawn between the nodes pointed at, and edges inside a node vanish. The
    minimum is combined in the map tasks and equal edges are merged before the next round, so a
    node with very many edges shrinks to one pointer. Rounds end when no edge is left.

    Edges and pointers of a round are written tables, so a lost executor costs one round at most. With `many` nodes
    pointers are never broadcast, however small their files are.
    """
    keys, joined = list(keys), shuffled if many else lambda df: df
    edges = cut(_between(edges, keys))
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(*keys, "a").agg(F.min("b").alias("to"))
        to = to.select(*keys, F.col("a").alias("node"), F.least("a", "to").alias("to"))
        for _ in range(HOPS):
            further = to.select(*keys, F.col("node").alias("to"), F.col("to").alias("_next"))
            to = to.join(joined(further), [*keys, "to"]).select(*keys, "node", F.col("_next").alias("to"))
        to = cut(to)
        steps.append(to)
        for end in ("a", "b"):
            moved = to.withColumnsRenamed({"node": end, "to": "_to"})
            edges = edges.join(joined(moved), [*keys, end]).drop(end).withColumnRenamed("_to", end)
        edges = cut(_between(edges, keys))

    found = nodes.select(*keys, "node", F.col("node").alias("component"))
    for to in steps:
        moved = to.withColumnsRenamed({"node": "component", "to": "_to"})
        found = found.join(joined(moved), [*keys, "component"], "left").select(
            *keys, "node", F.coalesce("_to", "component").alias("component")
        )
    return cut(found)


def _between(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each undirected edge once, smaller end first, without loops."""
    ordered = edges.where(F.col("a") != F.col("b"))
    return ordered.select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

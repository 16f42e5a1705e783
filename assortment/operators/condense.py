"""Condensed tree of a spanning forest: clusters over all weights, their stability and choice.

Edges are taken in by rising weight, all of one weight at once. A component becomes a cluster when it first holds
`min_cluster_size` rows. It goes on while smaller components join it; where two or more clusters meet, they end and a
new one starts. A row joins one cluster first, at some weight; it belongs to the clusters above from their start on.

Edges come in steps of bounded size, lightest first. A step is one sort and one pass on the driver over its edges,
whose ends carry the size and the cluster of their component; the other edges are relabelled by a join. Where more edges
than a step takes have one weight, as those between equal vectors do, Spark finds what they join, and the driver sees
the components that are clusters alone. Between the steps the driver keeps a few numbers per cluster, no rows.
"""

from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assortment.operators.components import connected_components
from assortment.sources.lineage import cut, shuffled

STEP_EDGES = 1 << 19
#: Smaller weights count as this, so that densities are finite.
LEAST_WEIGHT = 1e-6


def _numbers(kind: str):
    return field(default_factory=lambda: array(kind))


@dataclass
class Clusters:
    """Figures of each cluster, in the order of their start, so that a parent comes after its children.

    `mass` adds 1 / weight over the rows as they join, `rows` counts them, `smallest` is their smallest id.
    """

    start: array = _numbers("d")
    end: array = _numbers("d")
    parent: array = _numbers("q")
    mass: array = _numbers("d")
    rows: array = _numbers("q")
    smallest: array = _numbers("q")

    def opened(self, weight: float, children: list[int]) -> int:
        number = len(self.start)
        self.start.append(weight)
        self.end.append(np.inf)
        self.parent.append(-1)
        self.rows.append(sum(self.rows[c] for c in children))
        self.mass.append(self.rows[-1] / weight)
        self.smallest.append(min((self.smallest[c] for c in children), default=(1 << 63) - 1))
        for c in children:
            self.end[c], self.parent[c] = weight, number
        return number

    def joined(self, cluster: int, smallest: int, size: int, weight: float) -> None:
        self.rows[cluster] += size
        self.mass[cluster] += size / weight
        self.smallest[cluster] = min(self.smallest[cluster], smallest)

    def chosen(self, allow_single: bool) -> np.ndarray:
        """For each cluster the chosen one that it belongs to, itself or one above; -1 for none.

        A cluster is chosen over those below it unless they are more stable together. A lone root holds everything
        and is chosen only if `allow_single`.
        """
        n = len(self.start)
        stability = array("d", (round(m - r / e, 6) for m, r, e in zip(self.mass, self.rows, self.end)))
        below, keep = array("d", bytes(8 * n)), bytearray(n)
        lone = not allow_single and self.parent.count(-1) == 1
        for c in range(n):
            keep[c] = stability[c] >= round(below[c], 6) and not (lone and self.parent[c] < 0)
            if self.parent[c] >= 0:
                below[self.parent[c]] += max(stability[c], round(below[c], 6))
        out = np.full(n, -1)
        for c in reversed(range(n)):
            above = out[self.parent[c]] if self.parent[c] >= 0 else -1
            out[c] = above if above >= 0 else c if keep[c] else -1
        return out


def merge(edges: pa.Table, clusters: Clusters, size: int) -> tuple[pa.Table, pa.Table]:
    """Take in the (u, v, weight, size_u, size_v, cluster_u, cluster_v) edges of a step, the ends being components.

    Returns (node, to, size, cluster) of all ends, and (node, cluster, weight) of those that join their first cluster.
    """
    u, v, weight = (edges[c].to_numpy() for c in ("u", "v", "weight"))
    nodes, first, places = np.unique(np.concatenate([u, v]), return_index=True, return_inverse=True)
    of = lambda name: array("q", np.concatenate([edges[f"{name}_{e}"].to_numpy() for e in "uv"])[first].tobytes())
    sizes, cluster, n = of("size"), of("cluster"), len(nodes)
    own_size, root = sizes[:], array("q", range(n))
    # Those that wait for a cluster are a chain per component, from `head` to `tail`.
    head = array("q", (i if c < 0 else -1 for i, c in enumerate(cluster)))
    tail, after = head[:], array("q", [-1]) * n
    joins, when = array("q", [-1]) * n, array("d", bytes(8 * n))

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    def settled(r: int, met: list[int], at: float) -> None:
        """The component of root `r` after all edges of one weight; `met` are the clusters that came together in it."""
        if len(met) == 1:
            cluster[r] = met[0]
        elif met or sizes[r] >= size:
            cluster[r] = clusters.opened(at, met)
        if cluster[r] >= 0 and head[r] >= 0:
            i, least, rows = head[r], head[r], 0
            while i >= 0:
                joins[i], when[i] = cluster[r], at
                least, rows, i = min(least, i), rows + own_size[i], after[i]
            clusters.joined(cluster[r], int(nodes[least]), rows, at)
            head[r] = -1

    weight = np.maximum(weight, LEAST_WEIGHT)
    order = np.argsort(weight, kind="stable")
    left, right = (array("q", places.reshape(2, -1)[end, order].tobytes()) for end in (0, 1))
    weight = weight[order]
    bounds = array("q", np.flatnonzero(np.r_[True, weight[1:] != weight[:-1], True]).tobytes())
    for start, stop in zip(bounds, bounds[1:]):
        met: dict[int, list[int]] = {}
        for x, y in zip(left[start:stop], right[start:stop]):
            x, y = find(x), find(y)
            if x == y:
                continue
            x, y = min(x, y), max(x, y)  # nodes are sorted: the root is the smallest
            gathered = [*met.pop(x, [cluster[x]] if cluster[x] >= 0 else []), *met.pop(y, [cluster[y]] if cluster[y] >= 0 else [])]
            root[y] = x
            sizes[x] += sizes[y]
            if head[y] >= 0:
                if head[x] < 0:
                    head[x] = head[y]
                else:
                    after[tail[x]] = head[y]
                tail[x] = tail[y]
            met[x] = gathered
        for r in sorted(met):
            settled(r, met[r], float(weight[start]))
    roots = np.array(array("q", map(find, range(n))), np.int64)
    moved = pa.table({
        "node": nodes, "to": nodes[roots], "size": np.array(sizes, np.int64)[roots], "cluster": np.array(cluster, np.int64)[roots],
    })
    at = np.flatnonzero(np.array(joins, np.int64) >= 0)
    return moved, pa.table({
        "node": nodes[at], "cluster": np.array(joins, np.int64)[at], "weight": np.array(when, np.float64)[at],
    })


def merge_tied(edges: DataFrame, weight: float, clusters: Clusters, size: int) -> tuple[DataFrame, DataFrame]:
    """`merge` for edges that are all of one weight, whatever their number.

    What reaches the driver are the components of `size` rows and more, and the clusters that meet in them.
    """
    spark, free = edges.sparkSession, F.col("cluster") < 0
    u, v = (edges.select(F.col(e).alias("node"), F.col(f"size_{e}").alias("size"), F.col(f"cluster_{e}").alias("cluster")) for e in "uv")
    ends = cut(u.unionByName(v).distinct())
    pairs = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    ends = cut(ends.join(shuffled(connected_components(ends.select("node"), pairs, many=True)), "node"))
    sums = cut(ends.groupBy("component").agg(
        F.sum("size").alias("size"), F.sum(F.when(free, F.col("size")).otherwise(0)).alias("rows"),
        F.min(F.when(free, F.col("node"))).alias("smallest"),
    ))
    grown = sums.where(F.col("size") >= size).select("component", "rows", "smallest").toArrow().sort_by("component")
    met = ends.where(~free).select("component", "cluster").toArrow()
    met = met.sort_by([("component", "ascending"), ("cluster", "ascending")])
    names, children = grown["component"].to_numpy(), met["cluster"].to_numpy()
    first, last = (np.searchsorted(met["component"].to_numpy(), names, side=side).tolist() for side in ("left", "right"))
    into = array("q")
    for a, b, rows, smallest in zip(first, last, grown["rows"], grown["smallest"]):
        into.append(int(children[a]) if b - a == 1 else clusters.opened(weight, children[a:b].tolist()))
        if rows.as_py():
            clusters.joined(into[-1], smallest.as_py(), rows.as_py(), weight)
    own = spark.createDataFrame(pa.table({"component": names, "into": np.array(into, np.int64)}))
    sums = sums.select("component", F.col("size").alias("total")).join(shuffled(own), "component", "left")
    moved = cut(ends.join(shuffled(sums), "component").select(
        "node", F.col("component").alias("to"), F.col("total").alias("size"), F.coalesce("into", F.lit(-1)).alias("cluster"),
        (free & F.col("into").isNotNull()).alias("joins"),
    ))
    return moved.drop("joins"), moved.where("joins").select("node", "cluster", F.lit(weight).alias("weight"))


def _next_step(edges: DataFrame, n: int) -> tuple[DataFrame, DataFrame | None, float | None]:
    """The lightest of `n` edges, some STEP_EDGES, and the others, if any. A step of more has one weight, which comes last."""
    if n <= STEP_EDGES:
        return edges, None, None
    limit = edges.approxQuantile("weight", [STEP_EDGES / n], 0.1 * STEP_EDGES / n)[0]
    own = F.col("weight")
    lighter, equal = edges.agg(F.count_if(own < limit), F.count_if(own == limit)).first()
    if lighter and lighter + equal > 1.25 * STEP_EDGES:
        return edges.where(own < limit), edges.where(own >= limit), None
    return edges.where(own <= limit), edges.where(own > limit), limit if equal > STEP_EDGES else None


def condensed(tree: DataFrame, nodes: DataFrame, size: int) -> tuple[Clusters, DataFrame]:
    """Clusters of the (u, v, weight) forest, and (node, cluster, weight) of the rows that join one.

    `nodes` names all rows in its column `node`.
    """
    spark, clusters = tree.sparkSession, Clusters()
    none = {f"size_{e}": F.lit(1).cast("long") for e in "uv"} | {f"cluster_{e}": F.lit(-1).cast("long") for e in "uv"}
    tree = tree.withColumn("weight", F.greatest("weight", F.lit(LEAST_WEIGHT)))
    edges, waiting, found = cut(tree.withColumns(none)), None, []
    while n := edges.count():
        step, edges, tied = _next_step(edges, n)
        if tied is None:
            moved, joins = (spark.createDataFrame(t) for t in merge(step.toArrow(), clusters, size))
        else:
            moved, joins = merge_tied(step, tied, clusters, size)
        if waiting is None:
            waiting = nodes.select("node", F.col("node").alias("at"))
            if edges is None:
                found.append(joins)
                break
        waiting = cut(waiting.join(shuffled(joins.withColumnRenamed("node", "at")), "at", "left"))
        found.append(waiting.where("cluster IS NOT NULL").select("node", "cluster", "weight"))
        if edges is None:
            break
        moved = shuffled(cut(moved) if tied is None else moved)
        to = moved.select(F.col("node").alias("at"), "to")
        waiting = waiting.where("cluster IS NULL").select("node", "at").join(to, "at", "left")
        waiting = cut(waiting.select("node", F.coalesce("to", "at").alias("at")))
        for e in "uv":
            here = moved.withColumnsRenamed({"node": e, "to": "_to", "size": "_size", "cluster": "_cluster"})
            edges = edges.join(here, e, "left").withColumns({
                e: F.coalesce("_to", e), f"size_{e}": F.coalesce("_size", f"size_{e}"),
                f"cluster_{e}": F.coalesce("_cluster", f"cluster_{e}"),
            }).drop("_to", "_size", "_cluster")
        edges = cut(edges)
    out = spark.createDataFrame([], "node long, cluster long, weight double")
    for part in found:
        out = out.unionByName(part)
    return clusters, out

"""Minimum spanning tree of the mutual reachability distances of vectors.

The tree starts from the neighbour lists. The least listed edge out of a component is an edge of the tree if nothing
that is not listed can be shorter: a row's unlisted neighbours lie at least as far as the last one on its list, so a
component is sure of its least edge up to the smallest such radius among its rows. Components that are sure merge, in
rounds of grouped minima and contraction; when few edges are left, by one sort on the driver.

What is left are components whose inside is denser than the gap around them. Their nearest other components come
from one search over blocks of rows: a task reduces its block pair, tile by tile, to the least distance of each pair of
components and hands on a few per component. Of equal vectors in a component the row with the least core searches for
all. These are lists of neighbours again, now of components, and the same rule merges them. Every pass divides the
number of components by several times, until one is left. Each row goes to as many tasks as there are blocks, whose
number does not grow until their bytes reach a bound (`knn.parts`).
"""

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assortment.operators import knn
from assortment.sources.lineage import cut, shuffled

#: Edges that one sort takes on, and components that a component lists.
LOCAL_EDGES = 1 << 18
LISTED = 32
BLOCK_ROWS = 2048
#: Rows of a tile, and pairs of rows that two components of a tile are searched by at once.
TILE_ROWS = 2048
FEW_PAIRS = 64
HOPS = 3
TREE = "u long, v long, weight double"


def sure_merges(a, b, weight, listed, far) -> tuple[array, np.ndarray, np.ndarray]:
    """Positions of the edges (a, b) that merge, lightest first, all nodes, and the component each of them ends in.

    `far` is how far the lists of the `listed` nodes reach; those of others have no end. An edge merges if one of its two
    components is sure of it; what they are sure of together is the smaller of the two.
    """
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends, kept, reach = places.reshape(2, -1), array("q"), np.full(len(nodes), np.inf)
    reach[np.searchsorted(nodes, listed)] = far
    root, reach = array("q", range(len(nodes))), array("d", reach.tobytes())

    def find(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    order = np.lexsort((b, a, weight))
    left, right = (array("q", ends[side][order].tobytes()) for side in (0, 1))
    for at, x, y, w in zip(order, left, right, array("d", weight[order].tobytes())):
        x, y = find(x), find(y)
        if x != y and w <= max(reach[x], reach[y]):
            x, y = min(x, y), max(x, y)
            root[y], reach[x] = x, min(reach[x], reach[y])
            kept.append(at)
    return kept, nodes, nodes[np.array(array("q", map(find, range(len(nodes)))), np.int64)]


def _round(edges: DataFrame, sure: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over (a, b, weight, u, v): the chosen (u, v, weight), and (node, to) of the components that move."""
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight", "u", "v")
    best = edges.unionByName(swapped).groupBy("a").agg(F.min(F.struct("weight", "u", "v", "b")).alias("e"))
    best = best.join(shuffled(sure), "a", "left").where(F.col("e.weight") <= F.coalesce("reach", F.lit(float("inf"))))
    best = cut(best.select("a", "e.*"))
    to = best.select("a", F.col("b").alias("to"))
    back = to.select(F.col("a").alias("to"), F.col("to").alias("back"))
    # Two components that choose the same edge would point at each other: the smaller one stays.
    mutual = (F.col("back") == F.col("a")) & (F.col("a") < F.col("to"))
    to = to.join(shuffled(back), "to", "left").select("a", F.when(mutual, F.col("a")).otherwise(F.col("to")).alias("to"))
    for _ in range(HOPS):
        further = to.select(F.col("a").alias("to"), F.col("to").alias("next"))
        to = to.join(shuffled(further), "to", "left").select("a", F.coalesce("next", "to").alias("to"))
    return best.select("u", "v", "weight"), shuffled(cut(to))


def _moved(df: DataFrame, to: DataFrame, column: str) -> DataFrame:
    return df.join(to.withColumnsRenamed({"a": column, "to": "_to"}), column, "left").withColumn(
        column, F.coalesce("_to", column)
    ).drop("_to")


def _between(edges: DataFrame) -> DataFrame:
    """The least edge of each pair of components."""
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    apart = edges.where("a <> b").select(*ends, F.struct("weight", "u", "v").alias("e"))
    return apart.groupBy("a", "b").agg(F.min("e").alias("e")).select("a", "b", "e.*")


def _merged(edges: DataFrame, sure: DataFrame, labels: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Merge all components that are sure of an edge: chosen (u, v, weight) tables, and the new (node, a) labels."""
    chosen, edges = [], cut(_between(edges))
    while (n := edges.count()) > LOCAL_EDGES:
        found, to = _round(edges, sure)
        if to.where("a <> to").isEmpty():
            return chosen, labels
        chosen.append(found)
        sure = cut(_moved(sure, to, "a").groupBy("a").agg(F.min("reach").alias("reach")))
        labels = cut(_moved(labels, to, "a"))
        edges = cut(_between(_moved(_moved(edges, to, "a"), to, "b")))
    if n:
        rows = edges.toArrow()  # LOCAL_EDGES at most
        a, b, weight, u, v = (rows[c].to_numpy() for c in ("a", "b", "weight", "u", "v"))
        ends = edges.select(F.explode(F.array("a", "b")).alias("a")).distinct()
        reach = sure.select("a", "reach").join(ends, "a", "left_semi").toArrow()  # of the ends of these edges
        kept, nodes, roots = sure_merges(a, b, weight, reach["a"].to_numpy(), reach["reach"].to_numpy())
        spark, kept = edges.sparkSession, np.array(kept, np.int64)
        if len(kept):
            chosen.append(spark.createDataFrame(pa.table({"u": u[kept], "v": v[kept], "weight": weight[kept]})))
            to = spark.createDataFrame(pa.table({"a": nodes, "to": roots}))
            labels = cut(_moved(labels, to, "a"))
    return chosen, labels


def spanning_forest(edges: DataFrame) -> DataFrame:
    """(u, v, weight): a minimum spanning forest of the (a, b, weight) edges."""
    own = edges.select("a", "b", "weight", F.col("a").alias("u"), F.col("b").alias("v"))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nothing = nodes.sparkSession.createDataFrame([], "a long, reach double")
    chosen, _ = _merged(own, nothing, nodes.withColumn("a", F.col("node")))
    return _all(edges.sparkSession, chosen)


def _all(spark, chosen: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], TREE)
    for part in chosen:
        out = out.unionByName(part)
    return out.distinct()


def spanning_tree(vectors: DataFrame, graph: DataFrame, cores: DataFrame, edges: DataFrame, nprobe: int | None = None) -> DataFrame:
    """(u, v, weight): a minimum spanning tree of the mutual reachability distances of all products with a core.

    `graph`, `cores` and `edges` are those of `vectors` in `clusters`. With `nprobe` the searches visit the nearest
    cells alone, and what they leave apart stays so.
    """
    spark = vectors.sparkSession
    radius = graph.groupBy(F.col("product_id").alias("a")).agg(F.max("distance").alias("reach"))
    own = edges.select("a", "b", "weight", F.col("a").alias("u"), F.col("b").alias("v"))
    labels = cores.select(F.col("product_id").alias("node"), F.col("product_id").alias("a"))
    chosen, labels = _merged(own, cut(radius), labels)
    rows = vectors.select(F.col("product_id").cast("long").alias("id"), "embedding").join(
        shuffled(cores.select(F.col("product_id").alias("id"), "core")), "id"
    )
    search = None
    while (left := labels.select("a").distinct().count()) > 1:
        search = search or _Search(rows, labels, nprobe)
        lists = cut(search.nearest(labels))
        if lists.isEmpty():
            break
        sure = lists.where(F.col("rank") == LISTED).select("a", F.col("weight").alias("reach"))
        found, labels = _merged(lists.select("a", "b", "weight", "u", "v"), cut(sure), labels)
        if labels.select("a").distinct().count() == left:
            break
        chosen += found
    return _all(spark, chosen)


class _Search:
    """Nearest other components over blocks of rows (id, embedding, core), `labels` as in `nearest`."""

    def __init__(self, rows: DataFrame, labels: DataFrame, nprobe: int | None):
        rows = cut(knn._keyed(rows))
        placed = rows.select("id", "h1", "h2", "core").join(_labelled(labels), "id")
        first = placed.groupBy("h1", "h2", "a").agg(F.min(F.struct("core", "id")).alias("first"))
        rows = cut(rows.join(first.select("first.id"), "id", "left_semi").drop("h1", "h2"))
        count = rows.count()
        if nprobe is None:
            length = len(rows.select("embedding").first()[0])
            self.stored, self.blocks, self.keys = rows, knn.parts(count, BLOCK_ROWS, length), ["own", "block"]
            return
        pivots = knn.choose_pivots(rows, count)
        placed, places = knn.cell_blocks(rows, pivots)
        near = rows.withColumn("cell", F.explode(knn.list_choice(F.col("embedding"), pivots, nprobe)))
        last = (F.col("first") + F.col("blocks") - 1).cast("int")
        near = near.join(F.broadcast(places), "cell").withColumn("block", F.explode(F.sequence(F.col("first").cast("int"), last)))
        self.asked, self.stored = near.select("id", "embedding", "core", "block"), placed.select("id", "embedding", "core", "block")
        self.blocks, self.keys = None, ["block"]

    def _sides(self, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Both sides of the search, each with the component `a` of a row."""
        stored = self.stored.join(_labelled(labels), "id")
        if self.blocks is None:
            return self.asked.join(_labelled(labels), "id"), stored
        block, last = F.pmod(F.xxhash64("id"), F.lit(self.blocks)).cast("int"), F.lit(self.blocks - 1)
        asked = stored.withColumn("own", block).withColumn("block", F.explode(F.sequence("own", last)))
        return asked, stored.withColumn("block", block).withColumn("own", F.explode(F.sequence(F.lit(0), "block")))

    def nearest(self, labels: DataFrame) -> DataFrame:
        """(a, b, weight, u, v, rank): up to LISTED nearest other components b of each component a, by the rows u, v."""
        left, right = self._sides(labels)
        right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of their own, apart from the left ones
        found = left.groupBy(*self.keys).cogroup(right.groupBy(*self.keys)).applyInArrow(_component_distances, f"a long, b long, {TREE}")
        pairs = found.groupBy("a", "b").agg(F.min(F.struct("weight", "u", "v")).alias("e")).select("a", "b", "e.*")
        near = Window.partitionBy("a").orderBy("weight", "b")
        return pairs.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= LISTED)


def _labelled(labels: DataFrame) -> DataFrame:
    return shuffled(labels.select(F.col("node").alias("id"), "a"))


def _component_distances(asked: pa.Table, stored: pa.Table) -> pa.Table:
    """The least mutual reachability of pairs of components with a row on either side, LISTED per component."""
    if not len(asked) or not len(stored):
        return _Lists(np.empty(0, np.int64)).table()
    left, right = _side(asked), _side(stored)
    lists = _Lists(np.union1d(left[3], right[3]))
    tiles = [_tiles(side, lists.names) for side in (left, right)]
    for ids_a, units_a, cores_a, comps_a, starts_a in tiles[0]:
        for ids_b, units_b, cores_b, comps_b, starts_b in tiles[1]:
            if len(comps_a) == len(comps_b) == 1 and comps_a[0] == comps_b[0]:
                continue
            pairs = units_a @ units_b.T
            np.subtract(1.0, pairs, out=pairs)
            np.maximum(pairs, cores_a[:, None], out=pairs)
            np.maximum(pairs, cores_b, out=pairs)
            least = _by_run(np.ascontiguousarray(_by_run(pairs, starts_a).T), starts_b).T
            least[comps_a[:, None] == comps_b] = np.inf
            reach_a, reach_b = lists.reach[comps_a], lists.reach[comps_b]
            near = (least <= np.maximum(reach_a[:, None], reach_b)) & np.isfinite(least)
            if not (np.isfinite(reach_a).all() and np.isfinite(reach_b).all()):
                near &= _picked(least)
            i, j = np.nonzero(near)
            if len(i):
                row, column = _places(pairs, least[i, j], i, j, np.r_[starts_a, len(ids_a)], np.r_[starts_b, len(ids_b)])
                weight = np.round(np.maximum(pairs[row, column], 0.0), knn.DECIMALS)
                of_row, of_column = (np.searchsorted(s, x, side="right") - 1 for s, x in ((starts_a, row), (starts_b, column)))
                lists.add(comps_a[of_row], comps_b[of_column], ids_a[row], ids_b[column], weight)
    return lists.table()


class _Lists:
    """The LISTED nearest others of each component of `names`, as far as they are known; `reach` is how far the full
    lists go."""

    def __init__(self, names: np.ndarray):
        self.names, self.reach = names, np.full(len(names), np.inf)
        self.kept = [np.empty(0, np.int64)] * 4 + [np.empty(0)]
        self.new, self.waiting = [], 0

    def add(self, a, b, u, v, weight) -> None:
        """Components by their place in `names`, and the rows between them."""
        ends = np.minimum(u, v), np.maximum(u, v), weight
        self.new += [(a, b, *ends), (b, a, *ends)]
        self.waiting += 2 * len(a)
        if self.waiting > len(self.kept[0]) // 2:
            self._merge()

    def _merge(self) -> None:
        a, b, u, v, weight = (np.concatenate(c) for c in zip(self.kept, *self.new))
        by = np.lexsort((v, u, weight, b, a))
        by = by[np.r_[True, (np.diff(a[by]) != 0) | (np.diff(b[by]) != 0)]]  # the least of each pair
        by = by[np.lexsort((b[by], weight[by], a[by]))]
        rank = np.arange(len(by)) - np.searchsorted(a[by], a[by])
        last = by[rank == LISTED - 1]
        self.reach[a[last]] = weight[last] + knn.TIE
        self.kept = [c[by[rank < LISTED]] for c in (a, b, u, v, weight)]
        self.new, self.waiting = [], 0

    def table(self) -> pa.Table:
        if self.new:
            self._merge()
        a, b, u, v, weight = self.kept
        return pa.table({"a": self.names[a], "b": self.names[b], "u": u, "v": v, "weight": weight})


def _side(table: pa.Table):
    """Ids, unit vectors, cores and components of rows sorted by component."""
    table = table.sort_by("a")
    return *knn._columns(table, "id"), table["core"].to_numpy(), table["a"].to_numpy()


def _tiles(side: tuple, names: np.ndarray) -> list[tuple]:
    """(ids, unit vectors, cores, places of the components in `names`, where they start) of TILE_ROWS rows each."""
    out = []
    for first in range(0, len(side[0]), TILE_ROWS):
        ids, units, cores, labels = (c[first:first + TILE_ROWS] for c in side)
        starts = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
        out.append((ids, units, cores, np.searchsorted(names, labels[starts]), starts))
    return out


def _by_run(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The least row, part by part, of each run of rows. (`reduceat` takes several times as long for short runs.)"""
    if len(starts) == len(values):
        return values
    out = np.empty((len(starts), values.shape[1]))
    for n, (a, b) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(values)])):
        if b - a == 1:
            out[n] = values[a]
        else:
            np.minimum.reduce(values[a:b], axis=0, out=out[n])
    return out


def _places(pairs, least, i, j, rows, columns) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of `pairs` with the value `least` inside the runs i and j; `rows` and `columns` bound all runs."""
    tall, wide = np.diff(rows)[i], np.diff(columns)[j]
    few = tall * wide <= FEW_PAIRS
    found = []
    for x, y, value in zip(i[~few].tolist(), j[~few].tolist(), least[~few].tolist()):
        part = pairs[rows[x]:rows[x + 1], columns[y]:columns[y + 1]]
        at = int((part == value).argmax())
        found.append((rows[x] + at // part.shape[1], columns[y] + at % part.shape[1]))
    found = np.array(found, np.int64).reshape(-1, 2)
    size = (tall * wide)[few]
    each = np.repeat(np.flatnonzero(few), size)
    inside = np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)
    row, column = rows[i[each]] + inside // wide[each], columns[j[each]] + inside % wide[each]
    hit = pairs[row, column] == least[each]
    return np.r_[found[:, 0], row[hit]], np.r_[found[:, 1], column[hit]]


def _picked(least: np.ndarray) -> np.ndarray:
    """Marks of those among the LISTED least of their row or of their column, ties included."""
    near = np.zeros(least.shape, bool)
    for matrix, marks in ((least, near), (least.T, near.T)):
        top = min(LISTED, matrix.shape[1]) - 1
        worst = np.partition(matrix, top, axis=1)[:, top]
        marks |= matrix <= worst[:, None]
    return near & np.isfinite(least)

"""Hard-negative mining through a multiway hyperplane tree (after GNAT).

Every inner node holds a few split points, far from each other; a row goes to the child of the nearest one, so the
children are parted by hyperplanes. For each split point the node stores the range of its distances to the rows of
each sibling subtree. A search window is an annulus around the anchor: by the triangle inequality, a child whose
range at any one split point lies off the annulus holds no hit and is dropped with all that is below it. Leaves are
compared exactly, by integer inner products.

An inner product becomes a distance by lifting: a row x gets one more part, sqrt(M^2 - |x|^2), where M is the
largest norm, and an anchor a zero. Then |a - x|^2 = |a|^2 + M^2 - 2 a.x, so that scores in [low, high] are distances
in an annulus.

Split points come from a bounded sample; every row is indexed, and results are exact whatever the sample is. Leaves
are dealt in blocks of bounded bytes, so a third of all rows in one leaf spreads over tasks. Anchors first search
their home leaf; what they find there narrows the windows for the other leaves. No pair of rows leaves a task but the
k best per anchor, window and block.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment.llm.whitening import usable
from assortment.sources.lineage import cut

FANOUT = 8
LEAF_ROWS = 2048
MOST_LEVELS = 4
SAMPLE_ROWS = 16_384
SAMPLE_BYTES = 32 << 20
BLOCK_BYTES = 8 << 20
CHUNK_ROWS = 4096
#: Tasks that merge the distance ranges; the driver receives as many copies of them.
MERGERS = 16
#: Inner products of rows with a squared norm below this are exact.
EXACT = 1 << 53
FAR = 1 << 62


@dataclass
class Node:
    """Split points with their last (lifted) part, children (>= 0: a node, < 0: leaf ~child), ranges of distances
    from split point i (row) to subtree j (column)."""

    points: np.ndarray
    lifts: np.ndarray
    children: list[int]
    low: np.ndarray
    high: np.ndarray


@dataclass
class Tree:
    """Nodes from the root on; `top` is the square of the largest norm."""

    top: float
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    @classmethod
    def built(cls, sample: np.ndarray, top: float, levels: int) -> "Tree":
        tree = cls(top)
        tree._grown(sample, levels)
        return tree

    def _grown(self, rows: np.ndarray, levels: int) -> int:
        chosen = self._split_points(rows) if levels else rows[:0]
        if len(chosen) < 2:
            self.leaves += 1
            return -self.leaves
        m, at = len(chosen), len(self.nodes)
        node = Node(chosen, self._lifts(chosen), [], np.full((m, m), np.inf), np.full((m, m), -np.inf))
        self.nodes.append(node)
        nearest = self._distances(rows, node).argmin(1)
        node.children = [self._grown(rows[nearest == j], levels - 1) for j in range(m)]
        return at

    def _split_points(self, rows: np.ndarray) -> np.ndarray:
        """Up to FANOUT rows, each the farthest from those before it; equal rows count once."""
        if not len(rows):
            return rows
        chosen, gap = [0], np.full(len(rows), np.inf)
        while len(chosen) < FANOUT:
            gap = np.minimum(gap, np.square(rows - rows[chosen[-1]]).sum(1))
            if gap.max() == 0:
                break
            chosen.append(int(gap.argmax()))
        return rows[chosen]

    def _lifts(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.top - np.square(rows).sum(1)))

    def _distances(self, rows: np.ndarray, node: Node) -> np.ndarray:
        dots = rows @ node.points.T + np.outer(self._lifts(rows), node.lifts)
        return np.sqrt(np.maximum(0.0, 2 * self.top - 2 * dots))

    def routed(self, rows: np.ndarray, ranges: bool = False) -> np.ndarray:
        """The leaf of each row. With `ranges`, the ranges of the nodes are widened to hold the rows."""
        out, todo = np.zeros(len(rows), np.int32), [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            at, own = todo.pop()
            node = self.nodes[at]
            distances = self._distances(rows[own], node)
            nearest = distances.argmin(1)
            for j, child in enumerate(node.children):
                mine = nearest == j
                if not mine.any():
                    continue
                if ranges:
                    node.low[:, j] = np.minimum(node.low[:, j], distances[mine].min(0))
                    node.high[:, j] = np.maximum(node.high[:, j], distances[mine].max(0))
                if child < 0:
                    out[own[mine]] = ~child
                else:
                    todo.append((child, own[mine]))
        return out

    def ranges(self) -> np.ndarray:
        """All ranges in one vector, the upper ends negated: those of two trees merge by the minimum."""
        return np.concatenate([np.empty(0), *(x.ravel() for n in self.nodes for x in (n.low, -n.high))])

    def set_ranges(self, flat: np.ndarray) -> None:
        at = 0
        for node in self.nodes:
            m = len(node.points)
            node.low, node.high = flat[at:at + m * m].reshape(m, m), -flat[at + m * m:at + 2 * m * m].reshape(m, m)
            at += 2 * m * m

    def visits(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(anchors, leaves): whether a leaf can hold a score inside one of the windows of an anchor.

        `low` and `high` hold a row per anchor and a column per window; an unused window has low > high.
        """
        out = np.zeros((len(anchors), max(1, self.leaves)), bool)
        if not self.nodes:
            out[:] = (low <= high).any(1)[:, None]
            return out
        reach = np.square(anchors).sum(1) + self.top
        slack = 1e-6 * (1 + np.sqrt(reach))[:, None]
        used = low <= high
        near = np.sqrt(np.maximum(0.0, reach[:, None] - 2.0 * high)) - slack
        far = np.sqrt(np.maximum(0.0, reach[:, None] - 2.0 * low)) + slack
        todo = [(0, np.flatnonzero(used.any(1)))]
        while todo:
            at, own = todo.pop()
            node = self.nodes[at]
            t = np.sqrt(np.maximum(0.0, reach[own, None] - 2 * (anchors[own] @ node.points.T)))[:, :, None]
            least = np.maximum(np.maximum(node.low - t, t - node.high), 0.0).max(1)  # (anchors, children)
            most = (t + node.high).min(1)
            hit = (least[:, :, None] <= far[own, None, :]) & (most[:, :, None] >= near[own, None, :]) & used[own, None, :]
            for j, child in enumerate(node.children):
                mine = own[hit[:, j].any(1)]
                if not len(mine):
                    continue
                if child < 0:
                    out[mine, ~child] = True
                else:
                    todo.append((child, mine))
        return out


def integer_vectors(vector: Column, scale: int) -> Column:
    """floor(scale * part) of each part as a long."""
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * scale))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column.flatten()) else 0)
    return rows.astype(np.float64)


def _merged_ranges(rows: DataFrame, tree: Tree) -> np.ndarray:
    def lowest(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            total = part if total is None else np.minimum(total, part)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["ranges"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree.routed(_matrix(batch.column("x")), ranges=True)
        return lowest(iter([tree.ranges()]))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return lowest(np.frombuffer(v.as_py()) for batch in batches for v in batch.column(0))

    found = rows.select("x").mapInArrow(first, "ranges binary").repartition(MERGERS).mapInArrow(again, "ranges binary")
    return np.minimum.reduce([np.frombuffer(row.ranges) for row in found.collect()])


@dataclass
class Index:
    """Rows (row, id, label, x, leaf, block) with the tree above them; leaf l has `blocks[l]` blocks from `first[l]`."""

    rows: DataFrame
    tree: Tree
    first: np.ndarray
    blocks: np.ndarray


def indexed(rows: DataFrame) -> Index | None:
    """Index all (row, id, label, x) rows, x of one length; None without rows."""
    square = F.aggregate("x", F.lit(0).cast("long"), lambda s, v: s + v * v)
    figures = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top"), F.max(F.size("x")).alias("d")).first()
    if not figures.n:
        return None
    if figures.top >= EXACT:
        raise ValueError("inner products of these vectors are not exact")
    width = 8 * max(1, figures.d)
    picked = rows.orderBy(F.xxhash64("id", "x"), "row").limit(min(SAMPLE_ROWS, SAMPLE_BYTES // width)).select("x").toArrow()
    levels = next((i for i in range(MOST_LEVELS) if FANOUT ** i * LEAF_ROWS >= figures.n), MOST_LEVELS)
    tree = Tree.built(_matrix(picked.column("x")), float(figures.top), levels)
    if tree.nodes:
        tree.set_ranges(_merged_ranges(rows, tree))
    kind = rows.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("leaf", pa.array(tree.routed(_matrix(batch.column("x")))))

    placed = cut(rows.select("row", "id", "label", "x", "anchor").mapInArrow(
        place, f"row long, id {kind}, label long, x array<long>, anchor boolean, leaf int"
    ))
    sizes = np.zeros(max(1, tree.leaves), np.int64)
    for leaf in placed.groupBy("leaf").count().collect():  # one row per leaf, at most FANOUT ** MOST_LEVELS
        sizes[leaf["leaf"]] = leaf["count"]
    blocks = -(-sizes // max(1, BLOCK_BYTES // width))
    first = np.r_[0, np.cumsum(blocks)[:-1]]
    start, count = (F.element_at(F.array(*(F.lit(int(v)) for v in values)), F.col("leaf") + 1) for values in (first, blocks))
    block = (start + F.pmod(F.xxhash64("row"), count)).cast("int")
    return Index(placed.withColumn("block", block), tree, first, blocks)


def _blocks_of(index: Index, home: bool):
    """Function for mapInArrow: anchors with the blocks that they visit, those of their own leaf or the others."""
    tree, first, blocks = index.tree, index.first, index.blocks

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 512):
                batch = whole.slice(start, 512)
                leaf = batch.column("leaf").to_numpy()
                own = np.arange(max(1, tree.leaves)) == leaf[:, None]
                if home:
                    hit = own
                else:
                    hit = tree.visits(_matrix(batch.column("x")), _windows(batch, "low"), _windows(batch, "high")) & ~own
                sizes = np.where(hit, blocks, 0).sum(1)
                found = [np.arange(first[j], first[j] + blocks[j]) for row in hit for j in np.flatnonzero(row)]
                offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                flat = np.concatenate([np.empty(0, np.int64), *found]).astype(np.int32)
                yield batch.append_column("visits", pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))

    return visited


def _windows(batch, name: str) -> np.ndarray:
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k highest allowed scores per row; ties to the smaller column."""
    held = np.where(allowed, scores, -np.inf)
    top = min(k, held.shape[1])
    least = -np.partition(-held, top - 1, axis=1)[:, top - 1]
    row, col = np.nonzero(allowed & (held >= least[:, None]))
    by = np.lexsort((col, -held[row, col], row))
    row, col = row[by], col[by]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < top
    return row[kept], col[kept]


def _leaf_search(k: int, same_label: bool, id_type: pa.DataType):
    names = ["row", "window", "score", "found_row", "found_id"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), id_type]

    def search(asked: pa.Table, stored: pa.Table) -> pa.Table:
        out = pa.schema(list(zip(names, types))).empty_table()
        if not len(asked) or not len(stored):
            return out
        stored = stored.sort_by([("id", "ascending"), ("row", "ascending")])  # nulls last
        base, labels, rows = _matrix(stored["x"]), stored["label"].to_numpy(), stored["row"].to_numpy()
        parts, step = [out], max(1, min(1024, 4_000_000 // len(stored)))
        for start in range(0, len(asked), step):
            part = asked.slice(start, step)
            mine, low, high = part["row"].to_numpy(), _windows(part, "low"), _windows(part, "high")
            scores = _matrix(part["x"]) @ base.T
            alike = part["label"].to_numpy()[:, None] == labels
            fits = alike & (mine[:, None] != rows) if same_label else ~alike
            for w in range(low.shape[1]):
                row, col = _best(scores, fits & (scores >= low[:, w, None]) & (scores <= high[:, w, None]), k)
                parts.append(pa.Table.from_arrays([
                    pa.array(mine[row]), pa.array(np.full(len(row), w, np.int32)), pa.array(scores[row, col].astype(np.int64)),
                    pa.array(rows[col]), stored["id"].take(pa.array(col)).combine_chunks(),
                ], names=names))
        return pa.concat_tables(parts)

    return search


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _searched(index: Index, anchors: DataFrame, k: int, same_label: bool, home: bool) -> DataFrame:
    """(row, window, score, found_row, found_id): up to k hits per anchor, window and visited block."""
    schema = anchors.schema.simpleString()[len("struct<"):-1] + ",visits:array<int>"
    asked = cut(anchors.mapInArrow(_blocks_of(index, home), schema))
    load = cut(asked.select(F.explode("visits").alias("block")).groupBy("block").agg(
        F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("chunks")
    ))
    left = asked.select("row", "label", "x", "low", "high", F.explode("visits").alias("block")).join(load, "block")
    left = left.withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")).drop("chunks")
    right = index.rows.select("row", "id", "label", "x", "block").join(load, "block")
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    kind = index.rows.schema["id"].dataType
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    pairs = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
    return pairs.applyInArrow(
        _leaf_search(k, same_label, id_type),
        f"row long, window int, score long, found_row long, found_id {kind.simpleString()}",
    )


def search(index: Index, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
    """(row, window, score, found_row, found_id, rank): the k highest scores inside each window of each anchor.

    `anchors` are rows of the index with `low` and `high`, arrays of equal length. Rows of the anchor's label count,
    without the anchor, or those of other labels. Ties go to the smaller id, null last.
    """
    home = cut(_top(_searched(index, anchors, k, same_label, home=True), k).drop("rank"))
    reached = home.groupBy("row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    reached = reached.where(F.col("n") >= k).groupBy("row").agg(F.map_from_entries(
        F.collect_list(F.struct("window", "least"))  # one entry per window of the anchor
    ).alias("least"))
    bounds = F.transform("low", lambda v, w: F.greatest(v, F.coalesce(F.try_element_at("least", w), v)))
    narrowed = anchors.join(reached, "row", "left").withColumn("low", bounds).drop("least")
    rest = _searched(index, narrowed, k, same_label, home=False)
    return _top(home.unionByName(rest), k)


def mined(
    rows: DataFrame, positives: int = 5, negatives: int = 5, least_percent: int = 80,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the anchors.

    `rows` holds (id, label, x, anchor): whole numbers x, and whether the row is an anchor. A score is the inner
    product with the anchor. Positives are the `positives` best other rows of the anchor's label; for each, the
    `negatives` best rows of other labels with a score from `least_percent` of the positive's to all of it. Higher
    scores come first, ties by smaller id, null last; a positive score below 0 has an empty range.

    Rows with a null label, a null vector or a null part take no part; a null anchor flag is no anchor. A shorter
    vector counts as one with zeros at its end. Each row of a repeated id is a row of its own. An empty table, a
    single label or a lone row give no rows. Other columns are not read.
    """
    own = rows.select("id", F.col("label").cast("long").alias("label"), "x", F.coalesce("anchor", F.lit(False)).alias("anchor"))
    own = own.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    own = cut(own.withColumn("row", F.monotonically_increasing_id()))
    sizes = own.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if sizes.least != sizes.most:
        own = own.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(sizes.most) - F.size("x"))))
    index = indexed(own)
    kind = rows.schema["id"].dataType.simpleString()
    if index is None:
        return rows.sparkSession.createDataFrame(
            [], f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score long, negative_score long"
        )
    anchors = index.rows.where("anchor").select("row", "id", "label", "x", "leaf")
    whole = {"low": F.array(F.lit(-FAR)), "high": F.array(F.lit(FAR))}
    best = cut(search(index, anchors.withColumns(whole), positives, same_label=True))
    # A window per positive, in the order of the ranks; at most `positives` of them.
    ranges = best.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
    low = F.expr(f"transform(found, p -> if(p.score < 0, {FAR}, ({least_percent} * p.score + 99) div 100))")
    padded = lambda values, fill: F.concat(values, F.array_repeat(F.lit(fill), positives - F.size("found")))
    asked = anchors.join(ranges, "row").withColumns({"low": padded(low, FAR), "high": padded(F.col("found.score"), -FAR)})
    hits = search(index, asked.drop("found"), negatives, same_label=False)
    pairs = best.select(
        "row", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    out = hits.join(pairs, ["row", "window"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
    return out.select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def rows_of_vectors(vectors: DataFrame, key: str, label: Column, column: str, anchor: Column, scale: int) -> DataFrame:
    """(id, label, x, anchor) of the usable vectors: each part is floor(scale * part)."""
    own = vectors.where(usable(F.col(column).cast("array<double>")))
    return own.select(
        F.col(key).alias("id"), label.alias("label"), integer_vectors(F.col(column), scale).alias("x"), anchor.alias("anchor")
    )

"""Nearest neighbour join of two vector tables.

Rows are dealt into blocks of bounded size; a task multiplies one chunk of queries with one block and keeps k rows per
query. No pair of rows ever leaves a task but those k. Exact mode sends every query to every block: in the dimensions
of text vectors no bound on distances leaves blocks out, so that its work grows with the square of the rows. The rows
sent grow with the table alone, GRID times on either side, until a block reaches BLOCK_BYTES. Probe mode
visits the cells of the nearest pivots only (an inverted-file search). `descent` finds neighbours by neighbour descent,
with work in proportion to the rows.

Equal vectors are joined once, so a vector with very many copies costs as much as any other. They are told apart
by 128 bits of hash; no key of a shuffle holds a vector.

Vectors of one length with a direction take part (`has_direction`); the length is that of the pivots or else the
most frequent one of the base, the shorter on a tie.
"""

from functools import reduce
from math import isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assortment.functions.vectors import has_direction, matrix, unit_rows
from assortment.sources.lineage import cut

#: Least rows of a block and of a chunk of queries, how many of them there are beyond that, and their bytes at most.
BLOCK_ROWS = 4096
CHUNK_ROWS = 8192
GRID = 12
BLOCK_BYTES = 48 << 20
CELL_ROWS = 2048
#: Queries and rows of one matrix product.
TILE = 256, 2048
#: Neighbour descent: entries of a list, cells that a row searches first, entries that meet per row and direction, random
#: rows per row, rounds at most, share of new entries at the end.
ENTRIES = 40
PROBED = 6
LISTED = 20
RANDOM = 8
ROUNDS = 20
SETTLED = 0.01
#: Least centres of a task in it, how many tasks there are beyond that, and its centres at most.
CENTRES = 512
MEETINGS = 24
MOST_CENTRES = 16384
DECIMALS = 10
#: Likenesses that are less apart can have the same rounded distance.
TIE = 2e-10
RESULT = "query long, id long, distance double"


def parts(rows, least: int, length: int, grid: int = GRID):
    """How many blocks `rows` vectors (a number or a column) make: `least` rows each up to `grid` blocks, then `grid` until
    a block would pass BLOCK_BYTES."""
    most = max(1, BLOCK_BYTES // (8 * length))
    if isinstance(rows, Column):
        return F.least(F.ceil(rows / least), F.greatest(F.lit(grid), F.ceil(rows / most))).cast("int")
    return max(1, min(-(-rows // least), max(grid, -(-rows // most))))


def nearest_rows(asked_ids, asked, ids, units, k: int):
    """(query, id, distance) arrays: the k nearest of `ids` per asked row, ties to the smaller id.

    A tile of short products is only compared with the k-th nearest row so far, less what they can be off by; the few
    rows that may be nearer get their distance in full and are sorted in.
    """
    top, (queries, rows) = min(k, len(ids)), TILE
    short, slack = units.astype(np.float32), (units.shape[1] + 8) * 2.0 ** -23 + TIE
    out = []
    for start in range(0, len(asked_ids), queries):
        part = asked[start:start + queries]
        short_part = part.astype(np.float32)
        floor, best, found, waiting = np.full(len(part), -np.inf), None, [], 0
        for first in range(0, len(ids), rows):
            likeness = short_part @ short[first:first + rows].T
            if first == 0 and likeness.shape[1] > top:
                known = np.where(np.isnan(likeness), -np.inf, likeness)
                floor = np.partition(known, -top, axis=1)[:, -top] - slack
            at = np.flatnonzero(likeness >= (floor - slack).astype(np.float32)[:, None])
            if not len(at):
                continue
            if many := 16 * len(at) > likeness.size:  # near copies: all in full
                likeness = part @ units[first:first + rows].T
                at = np.flatnonzero(likeness >= floor[:, None])
            row, col = np.divmod(at, likeness.shape[1])
            full = likeness.ravel()[at] if many else np.einsum("ij,ij->i", part[row], units[first + col])
            d = np.round(np.maximum(0.0, 1.0 - full), DECIMALS)
            fine = np.isfinite(d)
            found.append((row[fine], ids[first + col[fine]], d[fine]))
            waiting += len(at)
            if waiting >= len(part) * top:
                best = _best([best, *found] if best else found, top)
                floor = _floor(best, len(part), top)
                found, waiting = [], 0
        best = _best([best, *found] if best else found, top) if found else best
        if best:
            out.append((asked_ids[start:start + queries][best[0]], *best[1:]))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip((empty, empty, np.empty(0)), *out))


def _best(found: list[tuple], top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The `top` nearest of (row, id, distance) arrays per row, by row."""
    row, ids, d = (np.concatenate(c) for c in zip(*found))
    by = np.lexsort((ids, d, row))
    row = row[by]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < top
    return row[kept], ids[by][kept], d[by][kept]


def _floor(best: tuple, rows: int, top: int) -> np.ndarray:
    """The least product by which a row can still come among the `top` of each."""
    row, _, d = best
    counts = np.bincount(row, minlength=rows)
    floor, full = np.full(rows, -np.inf), counts >= top
    floor[full] = 1.0 - d[np.cumsum(counts)[full] - 1] - TIE
    return floor


def _result(query, ids, distance) -> dict:
    return {"query": query, "id": ids, "distance": distance}


def _columns(batch, id_name: str):
    """Ids and unit vectors of an Arrow batch or table."""
    vectors = batch.column("embedding")
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return batch.column(id_name).to_numpy(), unit_rows(matrix(vectors))


def common_length(vectors: DataFrame) -> int | None:
    """The most frequent length of the vectors with a direction, the shorter on a tie; None without any."""
    own = F.col("embedding").cast("array<double>")
    lengths = vectors.where(has_direction(own)).groupBy(F.size("embedding").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "length").first()
    return first and first.length


def directed(vectors: DataFrame, length: int | None) -> DataFrame:
    """(id, embedding) rows whose vector has a direction and `length` parts."""
    out = vectors.select("id", F.col("embedding").cast("array<double>").alias("embedding"))
    return out.where(has_direction(F.col("embedding"), length))


def choose_pivots(base: DataFrame, rows: int) -> np.ndarray:
    """Unit pivots: rows picked by id hash, one per CELL_ROWS rows but not more than the square root of the rows."""
    count = max(1, min(rows // CELL_ROWS, isqrt(rows)))
    picked = base.orderBy(F.xxhash64("id"), "id").limit(count).select("embedding").toArrow()
    return unit_rows(matrix(picked.column(0).combine_chunks()))


def nearest_cell(vector, pivots: np.ndarray):
    """struct(cell, gap): nearest pivot and the Euclidean distance between unit vectors."""

    @arrow_udf("struct<cell: int, gap: double>")
    def nearest(v: pa.Array) -> pa.Array:
        cells, gaps = [np.empty(0, np.int32)], [np.empty(0)]
        for start in range(0, len(v), 4096):
            dots = unit_rows(matrix(v.slice(start, 4096))) @ pivots.T
            best = dots.argmax(axis=1)
            cells.append(best.astype(np.int32))
            gaps.append(np.sqrt(np.maximum(0.0, 2 - 2 * dots[np.arange(len(best)), best])))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(cells)), pa.array(np.concatenate(gaps))], ["cell", "gap"]
        )

    return nearest(vector)


def tag_cells(base: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add the cell of each row and its distance to the pivot."""
    tagged = base.withColumn("_near", nearest_cell(F.col("embedding"), pivots))
    return tagged.select(*base.columns, "_near.cell", "_near.gap")


def _keyed(vectors: DataFrame) -> DataFrame:
    """Add two 64-bit hashes that tell vectors apart."""
    return vectors.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})


def _copies(vectors: DataFrame, keep: int) -> DataFrame:
    """Up to `keep` smallest ids per vector; the first of them, copy 1, stands for the others.

    The filter on the row number limits the rows per vector in the map tasks already.
    """
    copies = Window.partitionBy("h1", "h2").orderBy("id")
    return _keyed(vectors).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= keep)


def _apart(df: DataFrame) -> DataFrame:
    """`df` with columns of its own, for a join with itself."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def cell_blocks(base: DataFrame, pivots: np.ndarray, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows with the `block` of their cell, and (cell, first, blocks): a cell of many rows is split by id hash."""
    tagged = cut(tag_cells(base, pivots).drop("gap"))
    figures = tagged.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").toPandas()  # one row per pivot
    blocks = np.ceil(figures.n.to_numpy() / block_rows).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype(np.int64)
    places = base.sparkSession.createDataFrame(
        list(zip(figures.cell.tolist(), first.tolist(), blocks.tolist())), "cell int, first long, blocks long"
    )
    block = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("blocks"))).cast("int")
    return tagged.join(F.broadcast(places), "cell").withColumn("block", block).drop("first", "blocks"), places


def _dealt(queries: DataFrame, base: DataFrame, rows: int, length: int, pivots, nprobe) -> tuple[DataFrame, DataFrame]:
    """Queries and base rows by (block, chunk)."""
    asked = max(1, queries.count())
    # Where queries are more than rows, the grid has fewer blocks and more chunks: each block sends k rows of each query.
    grid = max(1, round(GRID * sqrt(min(1, rows / asked)))) if nprobe is None else GRID
    chunks = parts(asked, CHUNK_ROWS, length, GRID * GRID // grid)
    chunk = F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int")
    if nprobe is None:
        blocks = parts(rows, BLOCK_ROWS, length, grid)
        left = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = base.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    else:
        pivots = choose_pivots(base, rows) if pivots is None else pivots
        right, places = cell_blocks(base, pivots)
        near = queries.withColumn("cell", F.explode(list_choice(F.col("embedding"), pivots, nprobe)))
        last = (F.col("first") + F.col("blocks") - 1).cast("int")
        left = near.join(F.broadcast(places), "cell").withColumn("block", F.explode(F.sequence(F.col("first").cast("int"), last)))
    left = left.select("query", "embedding", "block", chunk.alias("chunk"))
    return left, right.select("id", "embedding", "block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))


def _block_search(k: int):
    def nearest(asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not len(asked) or not len(stored):
            return pa.schema([("query", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())]).empty_table()
        return pa.table(_result(*nearest_rows(*_columns(asked, "query"), *_columns(stored, "id"), k)))

    return nearest


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block_join(queries: DataFrame, base: DataFrame, k: int, exclude_self: bool, length: int, pivots, nprobe) -> DataFrame:
    keep = k + 1 if exclude_self else k
    members = cut(_copies(base, keep))
    stored = members.where("copy = 1").select("id", "embedding")
    rows = stored.count()
    if not rows:
        return queries.sparkSession.createDataFrame([], RESULT)
    if queries is base:
        reps = _apart(stored).withColumnRenamed("id", "query")
    else:
        each = _keyed(queries).groupBy("h1", "h2").agg(F.min("id").alias("query"), F.first("embedding").alias("embedding"))
        reps = cut(each.select("query", "embedding"))
    left, right = _dealt(reps, stored, rows, length, pivots, nprobe)
    pairs = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
    return _for_rows(_top(pairs.applyInArrow(_block_search(keep), RESULT), keep), queries, members, keep, exclude_self)


def _for_rows(nearest: DataFrame, queries: DataFrame, members: DataFrame, keep: int, exclude_self: bool) -> DataFrame:
    """Back from distinct vectors to rows: at most `keep` copies of each of the `keep` vectors count. A vector with `keep`
    rows nearer than itself gives none."""
    same = ["h1", "h2"]
    copies = members.groupBy(*same).agg(F.min("id").alias("id"), F.collect_list("id").alias("copies"))
    nearest = nearest.drop("rank").join(copies.select("id", "copies"), "id")
    up_to = F.sum(F.size("copies")).over(Window.partitionBy("query").orderBy("distance"))
    level = F.sum(F.size("copies")).over(Window.partitionBy("query", "distance"))
    nearest = nearest.withColumns({"up_to": up_to, "level": level}).where(F.col("up_to") - F.col("level") < keep)
    nearest = nearest.select("query", F.explode("copies").alias("id"), "distance")
    nearest = _top(nearest, keep).drop("rank")
    ids = _keyed(queries).select("id", *same)
    firsts = ids.groupBy(*same).agg(F.min("id").alias("query"))
    asking = _apart(ids).withColumnRenamed("id", "asked").join(firsts, same).select("asked", "query")
    out = asking.join(nearest, "query").select(F.col("asked").alias("query"), "id", "distance")
    return out.where(F.col("query") != F.col("id")) if exclude_self else out


def probe_lists(
    queries: DataFrame, lists: DataFrame, k: int, pivots: np.ndarray, nprobe: int, of_each: int | None = None
) -> DataFrame:
    """(query, id, distance, rank) from stored lists of (id, embedding, list_id): each query visits the lists of
    its `nprobe` nearest pivots. Lists are spread over chunks of queries and blocks of rows of bounded size. `of_each`
    bounds the rows that one list gives to a query."""
    probed = list_choice(F.col("embedding"), pivots, nprobe)
    asked = directed(queries, pivots.shape[1]).select(F.col("id").alias("query"), "embedding", probed.alias("lists"))
    asked = cut(asked)
    each = asked.select("query", F.explode("lists").alias("list_id"))
    load = each.groupBy("list_id").agg(parts(F.count(F.lit(1)), CHUNK_ROWS, pivots.shape[1]).alias("chunks"))
    wanted = [row.list_id for row in load.select("list_id").distinct().collect()]  # one number per list
    lists = lists.where(F.col("list_id").isin(wanted))
    sizes = lists.groupBy("list_id").agg(parts(F.count(F.lit(1)), BLOCK_ROWS, pivots.shape[1]).alias("blocks"))
    shape = F.broadcast(cut(load.join(sizes, "list_id")))  # one row per list

    left = asked.select("query", "embedding", F.explode("lists").alias("list_id")).join(shape, "list_id").select(
        "query", "embedding", "list_id", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    right = lists.join(shape, "list_id").select(
        "id", "embedding", "list_id", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    keys = ["list_id", "block", "chunk"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return _top(pairs.applyInArrow(_block_search(of_each or k), RESULT), k)


def list_choice(vector, pivots: np.ndarray, nprobe: int):
    """array<int>: the numbers of the `nprobe` nearest pivots."""

    @arrow_udf("array<int>")
    def nearest(v: pa.Array) -> pa.Array:
        found = [np.empty((0, min(nprobe, len(pivots))), np.int32)]
        for start in range(0, len(v), 4096):
            dots = unit_rows(matrix(v.slice(start, 4096))) @ pivots.T
            found.append(np.argsort(-dots, axis=1, kind="stable")[:, :nprobe].astype(np.int32))
        out = np.concatenate(found)
        offsets = np.arange(0, out.size + 1, max(1, out.shape[1]), dtype=np.int32)[: len(out) + 1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return nearest(vector)


def knn_join(
    queries: DataFrame, base: DataFrame, k: int, exclude_self: bool = False,
    pivots: np.ndarray | None = None, nprobe: int | None = None,
) -> DataFrame:
    """(query, id, distance, rank): the k nearest base rows of each query by cosine distance.

    Both inputs hold (id, embedding) with unique long ids; rows without a direction and those of another length
    are left out. Exact unless `nprobe` is given. Ties go to the smaller id; distances have ten decimals.
    """
    same = queries is base
    length = common_length(base) if pivots is None else pivots.shape[1]
    base = directed(base, length)
    queries = base if same else directed(queries, length)
    return _top(_block_join(queries, base, k, exclude_self, length, pivots, nprobe), k)


def descent(base: DataFrame, k: int, rounds: int = ROUNDS) -> DataFrame:
    """(query, id, distance, rank): nearly the k nearest other rows of each row, by neighbour descent.

    Lists start from the cells of the PROBED nearest pivots. In a round each row brings its neighbours, and the rows that
    have it as one, to meet each other; where a pair is nearer than what one of them has listed, it is listed. Only pairs
    with a neighbour that is new since the last round meet, LISTED new and as many old ones per row and direction, picked
    by a hash, and a few random rows. Rounds end when less than SETTLED of the entries are new. Rows meet in tasks that
    hold the rows around some centres: MEETINGS tasks, to each of which a row is sent once, until a task would pass
    MOST_CENTRES; so many neighbours at most has a row, whatever the size of the table. Lists are longer than `k`, as short
    ones miss more neighbours the larger the table is. A row's entries are those of the same columns and rules as in
    `knn_join`; they are the same for any partitions.
    """
    base = directed(base, common_length(base))
    members = cut(_copies(base, k + 1))
    stored = members.where("copy = 1").select("id", "embedding")
    rows = stored.count()
    if not rows:
        return base.sparkSession.createDataFrame([], RESULT + ", rank int")
    listed = max(2 * k, ENTRIES) + 1
    pivots = choose_pivots(stored, rows)
    tagged = cut(tag_cells(stored, pivots).drop("gap"))
    placed = _centre_blocks(tagged, pivots, rows)
    cells = tagged.withColumnRenamed("cell", "list_id")
    lists = probe_lists(tagged.select("id", "embedding"), cells, listed, pivots, PROBED, max(k, LISTED) + 1)
    lists = cut(lists.select("query", "id", "distance", (F.col("query") != F.col("id")).alias("fresh")))
    for number in range(rounds):
        if lists.where("fresh").count() <= SETTLED * rows * listed:
            break
        lists = cut(_closer(lists, placed, listed, rows, number))
    # Every vector has a copy, so more than k + 1 vectors are not asked for.
    return _top(_for_rows(_top(lists.drop("fresh"), k + 1), base, members, k + 1, True), k)


def _centre_blocks(tagged: DataFrame, pivots: np.ndarray, rows: int) -> DataFrame:
    """(id, embedding, block): blocks of equal size, each of cells near one another."""
    blocks = min(-(-rows // CENTRES), max(MEETINGS, -(-rows // MOST_CENTRES)))
    figures = tagged.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()  # one row per pivot
    held = dict(zip(figures.cell.tolist(), figures.n.tolist()))
    places, first = [], 0
    for cell in _chain(pivots):
        if cell in held:
            places.append((cell, first, held[cell]))
            first += held[cell]
    places = tagged.sparkSession.createDataFrame(places, "cell int, first long, n long")
    within = F.pmod(F.xxhash64("id", F.lit(2)), F.col("n"))
    block = F.floor((F.col("first") + within) * blocks / rows).cast("int")
    return tagged.join(F.broadcast(places), "cell").select("id", "embedding", block.alias("block"))


def _chain(pivots: np.ndarray) -> list[int]:
    """The numbers of the pivots, each followed by the nearest of those left."""
    left, order = np.ones(len(pivots), bool), [0]
    for _ in range(len(pivots) - 1):
        left[order[-1]] = False
        order.append(int(np.where(left, pivots @ pivots[order[-1]], -np.inf).argmax()))
    return order


def _closer(lists: DataFrame, placed: DataFrame, listed: int, rows: int, number: int) -> DataFrame:
    """One round: the lists with what was found nearer.

    Entries and pairs are dealt once, by the column that all steps up to the next cut go by.
    """
    others = lists.where("query <> id")
    # Some RANDOM rows besides, other ones each round, so that no part of the graph is cut off.
    bucket = F.pmod(F.xxhash64("id", F.lit(number)), F.lit(-(-rows // RANDOM))).alias("bucket")
    one, two = (placed.select(F.col("id").alias(name), bucket) for name in ("centre", "member"))
    ways = [
        others.select(F.col("query").alias("centre"), F.col("id").alias("member"), "fresh"),
        others.select(F.col("id").alias("centre"), F.col("query").alias("member"), "fresh"),
        one.join(two, "bucket").select("centre", "member", (F.col("centre") != F.col("member")).alias("fresh")),
    ]
    both = reduce(DataFrame.unionByName, (df.withColumn("way", F.lit(i)) for i, df in enumerate(ways)))
    few = Window.partitionBy("centre", "way", "fresh").orderBy(F.xxhash64("centre", "member", F.lit(number)), "member")
    met = both.repartition("centre").withColumn("place", F.row_number().over(few)).where(F.col("place") <= LISTED)
    met = met.groupBy("centre", "member").agg(F.max("fresh").alias("fresh"))
    met = cut(met.join(placed.select(F.col("id").alias("centre"), "block"), "centre"))
    # A vector goes once to each block that has centres around it.
    worst = lists.groupBy(F.col("query").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= listed, F.max("distance")).otherwise(2.0).alias("worst")
    )
    rows = placed.select("id", "embedding").join(worst, "id")
    asked = met.select("block", F.col("member").alias("id")).repartition("id").distinct()
    sent = _apart(asked.join(rows, "id"))
    found = met.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_meetings(listed), RESULT)
    both = lists.select("query", "id", "distance", F.lit(0).alias("new")).unionByName(found.withColumn("new", F.lit(1)))
    both = both.repartition("query").groupBy("query", "id")
    both = both.agg(F.min("distance").alias("distance"), F.min("new").alias("new"))
    return _top(both, listed).select("query", "id", "distance", (F.col("new") == 1).alias("fresh"))


def _meetings(listed: int):
    """Function for a block: pairs around its centres that are nearer than what one of the two has listed."""

    def meet(met: pa.Table, sent: pa.Table) -> pa.Table:
        out = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("distance", pa.float64())]).empty_table()
        if not len(met) or not len(sent):
            return out
        ids, units = _columns(sent, "id")
        worst, by = sent["worst"].to_numpy(), np.argsort(ids)
        met = met.sort_by([("centre", "ascending"), ("member", "ascending")])
        at = by[np.searchsorted(ids, met["member"].to_numpy(), sorter=by)]
        fresh, centre = met["fresh"].to_numpy(), met["centre"].to_numpy()
        starts = np.flatnonzero(np.r_[True, centre[1:] != centre[:-1], True])
        queries, found, distances = [], [], []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            own, new = at[a:b], fresh[a:b]
            near = units[own]
            d = np.round(np.maximum(0.0, 1.0 - near @ near.T), DECIMALS)
            closer = (d <= worst[own][:, None]) & (new[:, None] | new)
            np.fill_diagonal(closer, False)
            row, col = np.nonzero(closer)
            queries.append(own[row])
            found.append(own[col])
            distances.append(d[row, col])
        q, i, d = (np.concatenate(parts) for parts in (queries, found, distances))
        _, first = np.unique(q * len(ids) + i, return_index=True)
        q, i, d = q[first], i[first], d[first]
        by = np.lexsort((i, d, q))
        q, i, d = q[by], i[by], d[by]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < listed
        return pa.table(_result(ids[q[kept]], ids[i[kept]], d[kept]))

    return meet

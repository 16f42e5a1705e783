"""Short codes of vectors in inverted lists: product quantisation of what the centroid of the list leaves over."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assortment.functions.vectors import list_array, matrix, unit_rows

#: Entries of a codebook: a code is one byte per piece of a vector.
ENTRIES = 256
#: Parts of a vector that share a byte.
PIECE = 4
#: Rows that the codebooks are trained on, in expectation.
TRAINING_ROWS = 16_384
ROUNDS = 12
#: What the codes may lose of the nearest rows.
KEPT = 0.98


@dataclass
class Codebooks:
    """`books[piece, code]` is what a code stands for; `depth` says how many candidates per wanted row are compared
    by their vectors."""

    books: np.ndarray
    depth: float = 1.0

    def table(self, query: np.ndarray) -> np.ndarray:
        """[piece, code]: the inner product of a piece of a unit query with each entry."""
        pieces, _, parts = self.books.shape
        return np.einsum("pcx,px->pc", self.books, _pieces(query[None, :], parts)[0])


def _pieces(rows: np.ndarray, parts: int) -> np.ndarray:
    """[row, piece, part]; the last piece is filled up with zeros."""
    n, length = rows.shape
    padded = np.zeros((n, -(-length // parts) * parts))
    padded[:, :length] = rows
    return padded.reshape(n, -1, parts)


def _left_over(vectors: pa.Array, lists: pa.Array, centroids: np.ndarray, parts: int) -> np.ndarray:
    """What the centroids of their lists leave of the unit vectors, in pieces."""
    return _pieces(unit_rows(matrix(vectors)) - centroids[lists.to_numpy(zero_copy_only=False)], parts)


def _nearest_entry(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (0.5 * np.einsum("cx,cx->c", book, book) - points @ book.T).argmin(1)


def _book(points: np.ndarray) -> np.ndarray:
    """ENTRIES means of points by Lloyd's rounds. They start from distinct points, evenly spaced in sorted order; an
    entry without points stays. Fewer distinct points give a book that holds all of them."""
    distinct = np.unique(points, axis=0)
    if len(distinct) <= ENTRIES:
        return np.concatenate([distinct, np.repeat(distinct[:1], ENTRIES - len(distinct), axis=0)])
    book = distinct[np.linspace(0, len(distinct) - 1, ENTRIES).astype(int)]
    for _ in range(ROUNDS):
        own = _nearest_entry(points, book)
        count = np.bincount(own, minlength=ENTRIES)
        sums = np.stack([np.bincount(own, weights=x, minlength=ENTRIES) for x in points.T], axis=1)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


def train(rows: DataFrame, centroids: np.ndarray, parts: int = PIECE, sample: int = TRAINING_ROWS) -> Codebooks:
    """Codebooks for (product_id, embedding, list_id) rows, one per piece of `parts` parts.

    Rows are drawn by a hash of their id, about `sample` of them; each piece is trained by a task of its own, which
    holds that piece of the drawn rows only.
    """
    total = max(1, rows.count())
    drawn = rows.where(F.pmod(F.xxhash64("product_id"), F.lit(total)) < sample)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _left_over(batch.column("embedding"), batch.column("list_id"), centroids, parts)
            for piece in range(found.shape[1] if len(found) else 0):
                yield pa.RecordBatch.from_pydict({
                    "piece": pa.array(np.full(len(found), piece, np.int32)), "product_id": batch.column("product_id"),
                    "part": list_array(found[:, piece]),
                })

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("product_id")
        book = _book(matrix(group["part"].combine_chunks()))
        return pa.table({
            "piece": pa.array([group["piece"][0].as_py()] * ENTRIES, pa.int32()),
            "code": pa.array(range(ENTRIES), pa.int32()), "entry": list_array(book),
        })

    pieces = drawn.select("product_id", "embedding", "list_id").mapInArrow(split, "piece int, product_id long, part array<double>")
    found = pieces.groupBy("piece").applyInArrow(fit, "piece int, code int, entry array<double>")
    entries = found.orderBy("piece", "code").toArrow()  # ENTRIES rows of `parts` numbers per piece
    return Codebooks(matrix(entries["entry"].combine_chunks()).reshape(-1, ENTRIES, parts))


def encode(rows: DataFrame, centroids: np.ndarray, codebooks: Codebooks) -> DataFrame:
    """(product_id, code, list_id): a byte per piece. Row by row, no shuffle."""
    books = codebooks.books
    pieces, _, parts = books.shape

    @arrow_udf("binary")
    def code(vectors: pa.Array, lists: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.binary())
        rest = _left_over(vectors, lists, centroids, parts)
        codes = np.stack([_nearest_entry(rest[:, p], books[p]) for p in range(pieces)], axis=1).astype(np.uint8)
        return pa.array([c.tobytes() for c in codes], pa.binary())

    return rows.select("product_id", code("embedding", "list_id").alias("code"), "list_id")


def _code_matrix(codes: pa.Array, pieces: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), pieces)


def _likeness(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table entries that each code names."""
    out = np.zeros(len(codes))
    for piece, entries in enumerate(table):
        out += entries[codes[:, piece]]
    return out


def _coded(table: np.ndarray, to_centroid: np.ndarray, codes: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """Approximate cosine distances to one query, from its table and its products with the centroids."""
    return np.round(1.0 - to_centroid[lists] - _likeness(codes, table), 12)


def coded_distance(codebooks: Codebooks, centroids: np.ndarray, query: np.ndarray) -> Column:
    """Approximate cosine distance to one unit query of rows with `code` and `list_id`, by table lookups."""
    table, to_centroid = codebooks.table(query), centroids @ query

    @arrow_udf("double")
    def distance(codes: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array(_coded(table, to_centroid, _code_matrix(codes, len(table)), lists.to_numpy(zero_copy_only=False)))

    return distance("code", "list_id")


def measured_depth(
    codes: DataFrame, centroids: np.ndarray, codebooks: Codebooks, asked: DataFrame, true: DataFrame, wanted: list[int],
) -> float:
    """The least number of candidates per wanted row at which KEPT of the nearest rows are among the candidates.

    `asked` are a bounded number of (id, embedding) queries, `true` their exact (query, id, rank) neighbours, `wanted`
    the numbers of rows that requests ask for. Per true neighbour the coded rows that come before it, of all lists, are
    counted; tasks add up counts for each batch of rows and emit one array.
    """
    queries = asked.orderBy("id").toArrow()
    place = {q: n for n, q in enumerate(queries["id"].to_pylist())}
    if not place:
        return 1.0
    units = unit_rows(matrix(queries["embedding"].combine_chunks()))
    tables, to_centroids = [codebooks.table(u) for u in units], units @ centroids.T
    pieces = len(codebooks.books)

    def distances(number: int, codes: np.ndarray, lists: np.ndarray) -> np.ndarray:
        return _coded(tables[number], to_centroids[number], codes, lists)

    near = true.join(codes.withColumnRenamed("product_id", "id"), "id").orderBy("query", "rank").toArrow()  # bounded by `asked`
    of, ranks = np.array([place[q] for q in near["query"].to_pylist()]), near["rank"].to_numpy()
    near_codes, near_lists = _code_matrix(near["code"].combine_chunks(), pieces), near["list_id"].to_numpy()
    marks, order = [], []
    for number in range(len(units)):
        mine = np.flatnonzero(of == number)
        found = distances(number, near_codes[mine], near_lists[mine])
        by = np.lexsort((near["id"].to_numpy()[mine], found))
        marks.append(found[by])
        order.append(mine[by])

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            coded, lists = _code_matrix(batch.column("code"), pieces), batch.column("list_id").to_numpy()
            counts = [np.searchsorted(np.sort(distances(n, coded, lists)), mark) for n, mark in enumerate(marks)]
            rows = np.concatenate(counts).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"mark": pa.array(np.arange(len(rows))), "rows": pa.array(rows)})

    sums = codes.mapInArrow(before, "mark long, rows long").groupBy("mark").agg(F.sum("rows").alias("rows"))
    ahead = sums.orderBy("mark").toArrow()["rows"].to_numpy()
    # Of rows at one distance the smaller ids come first.
    tied = np.concatenate([np.arange(1, len(m) + 1) - np.searchsorted(m, m) for m in marks])
    places, ranks = ahead + tied, ranks[np.concatenate(order)]
    return max([1.0] + [float(np.quantile(places[ranks <= k], KEPT)) / k for k in wanted if (ranks <= k).any()])

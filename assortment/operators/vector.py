"""Vector search: exact top k, and inverted lists."""

import uuid
import warnings
from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.numbers import round2
from assortment.functions.vectors import distance_to, has_vector, list_array, matrix, unit_rows
from assortment.operators import knn, quantise
from assortment.sources.lineage import cut

MAX_ITERATIONS = 50
ROWS_PER_FILE = 1_000_000
#: More lists than this are made in two levels; sampled rows per list and lists of a cell at most on the second.
ONE_LEVEL = 128
SAMPLE_PER_LIST = 64
MOST_IN_CELL = 512
PROBE_SAMPLE = 256
#: Rows of the largest request: 100 with a price bound.
LARGEST_POOL = 100 * fixed.SEARCH_OVERFETCH
FEWEST_WANTED = 10
MANIFEST = "part string, file string"
CENTROIDS = "list_id int, centroid array<double>, nprobe int, depth double"
CODEBOOKS = "piece int, entries array<array<double>>"
#: Pages of stored vectors hold about so many bytes, so that a few rows can be read without the others.
PAGE_BYTES = 8192
#: Ranges of ids that a read of candidates names, unless their lists are more; candidates of one request at most.
ID_RANGES = 128
MOST_CANDIDATES = 20_000


def _as_ids(vectors: DataFrame, id_name: str) -> DataFrame:
    return vectors.select(F.col(id_name).cast("long").alias("id"), "embedding")


def _nearest(rows: DataFrame, query: list[float], k: int) -> DataFrame:
    distance = F.round(distance_to(F.col("embedding"), query), knn.DECIMALS)
    near = rows.where(has_vector(F.col("embedding"))).select("product_id", distance.alias("distance"))
    return near.where("distance IS NOT NULL").orderBy("distance", "product_id").limit(k)


def vector_top_k(vectors: DataFrame, query: list[float], k: int) -> DataFrame:
    """(product_id, distance): the k rows nearest to one vector by cosine distance."""
    return _nearest(vectors, query, k)


def vector_top_k_batch(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, product_id, distance, rank) for a table of (query_id, embedding)."""
    found = knn.knn_join(_as_ids(queries, "query_id"), _as_ids(vectors, "product_id"), k)
    return found.withColumnsRenamed({"query": "query_id", "id": "product_id"})


@dataclass
class VectorIndex:
    """Inverted lists: one unit centroid per list, and the vectors with their `list_id`.

    `nprobe` is how many lists a search visits unless it says otherwise. `files` names the files of the table of vectors
    that a stored index holds, and `path` its folder; None for an index that is not stored. With `codebooks` there are
    `codes`, (product_id, code, list_id) with a byte per piece of a vector.
    """

    centroids: np.ndarray
    rows: DataFrame
    nprobe: int = fixed.NPROBE
    files: frozenset[str] | None = None
    path: str | None = None
    codebooks: quantise.Codebooks | None = None
    codes: DataFrame | None = None

    def spark_centroids(self) -> DataFrame:
        """(number, centroid), one row per list."""
        rows = [(i, [float(x) for x in c]) for i, c in enumerate(self.centroids)]
        return self.rows.sparkSession.createDataFrame(rows, "number int, centroid array<double>")

    def not_held(self, vectors: DataFrame) -> DataFrame | None:
        """The rows of the files of a table that this stored index does not hold, None if it holds all. Files are
        compared by name; no id and no vector is read for it."""
        new = [f for f in vectors.inputFiles() if file_name(f) not in self.files]
        return vectors.sparkSession.read.schema(vectors.schema).parquet(*new) if new else None


def file_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def lists_for(rows: int) -> int:
    """Number of lists for so many vectors: the root of it, IVF_LISTS at least, so that lists stay short."""
    return max(fixed.IVF_LISTS, isqrt(rows))


def ivf_build(
    vectors: DataFrame, lists: int | None = None, seed: int = 42, max_iterations: int = MAX_ITERATIONS,
    tolerance: float = 1e-4, codes: bool = False,
) -> VectorIndex:
    """Centroids of `lists` lists, by the number of rows unless given, and every vector with its nearest list.

    Centroids come from cosine k-means over all vectors, which ends when none moves by more than `tolerance`; a warning
    says when `max_iterations` came first. More than ONE_LEVEL lists are made in two levels: k-means parts all vectors
    into the root of that number of cells, and each cell is parted into lists in proportion to its rows, so that large
    cells give many lists. The number of lists that a search visits is measured (`measured_probes`). With `codes` the
    lists get short codes too, from which a search chooses the vectors it reads; how many is measured as well.
    """
    named = _as_ids(vectors, "product_id")
    rows = cut(knn.directed(named, knn.common_length(named)))
    total = rows.count()
    if total == 0:
        raise ValueError("no vectors to index")
    lists = min(lists or lists_for(total), total)
    coarse = lists if lists <= ONE_LEVEL else isqrt(lists)
    train = cut(rows.select(array_to_vector("embedding").alias("features")))
    model = KMeans(
        k=coarse, distanceMeasure="cosine", seed=seed, maxIter=max_iterations, tol=tolerance, solver="block"
    ).fit(train)
    if model.summary.numIter >= max_iterations:
        warnings.warn(f"centroids still moved after {max_iterations} rounds", stacklevel=2)
    centroids = np.array(model.clusterCenters())
    centroids = unit_rows(centroids[np.linalg.norm(centroids, axis=1) > 0])
    if lists > ONE_LEVEL:
        centroids = _parted_cells(rows, centroids, lists / total)
    index = VectorIndex(centroids, cut(_assign(rows, centroids)))
    asked, true = _measured_neighbours(index, LARGEST_POOL)
    index.nprobe = measured_probes(index, asked, true)
    if codes:
        index.codebooks = quantise.train(index.rows, centroids)
        index.codes = cut(quantise.encode(index.rows, centroids, index.codebooks))
        index.codebooks.depth = quantise.measured_depth(
            index.codes, centroids, index.codebooks, asked, true, [FEWEST_WANTED, LARGEST_POOL]
        )
    return index


def _parted_cells(rows: DataFrame, cells: np.ndarray, share: float) -> np.ndarray:
    """Centroids inside each cell, `share` of them per row; each cell trains on a bounded sample of its rows."""
    tagged = cut(knn.tag_cells(rows, cells).drop("gap"))
    sizes = tagged.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.greatest(F.lit(1), F.round(F.col("n") * share)).cast("int")
    sizes = sizes.select("cell", "n", F.least(wanted, F.lit(MOST_IN_CELL)).alias("lists"))  # one row per cell
    drawn = F.pmod(F.xxhash64("id"), F.col("n")) < F.col("lists") * SAMPLE_PER_LIST
    sample = tagged.join(F.broadcast(sizes), "cell").where(drawn)

    def part(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        units = unit_rows(matrix(group["embedding"].combine_chunks()))
        found = _unit_means(units, min(group["lists"][0].as_py(), len(units)))
        return pa.table({"cell": pa.array([group["cell"][0].as_py()] * len(found), pa.int32()), "centroid": list_array(found)})

    found = sample.groupBy("cell").applyInArrow(part, "cell int, centroid array<double>")
    return np.stack(found.orderBy("cell", "centroid").toPandas().centroid.to_numpy())  # one row per list


def _unit_means(units: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Up to k unit means of unit rows by cosine k-means; starts from rows far from one another."""
    chosen, near = [0], np.full(len(units), -np.inf)
    while len(chosen) < k:
        near = np.maximum(near, units @ units[chosen[-1]])
        if near.min() > 1 - 1e-12:
            break
        chosen.append(int(near.argmin()))
    means = units[chosen]
    for _ in range(rounds):
        own = (units @ means.T).argmax(1)
        sums = np.zeros_like(means)
        np.add.at(sums, own, units)
        size = np.linalg.norm(sums, axis=1)
        means = np.where(size[:, None] > 1e-12, sums / np.maximum(size, 1e-12)[:, None], means)
    return means


def _measured_neighbours(index: VectorIndex, pool: int) -> tuple[DataFrame, DataFrame]:
    """Up to PROBE_SAMPLE of the indexed vectors, and their exact `pool` nearest rows."""
    named = index.rows.select(F.col("product_id").alias("id"), "embedding")
    asked = cut(named.orderBy(F.xxhash64("id"), "id").limit(PROBE_SAMPLE))
    return asked, cut(knn.knn_join(asked, named, pool))


def measured_probes(index: VectorIndex, asked: DataFrame, true: DataFrame, recall: float = fixed.RECALL) -> int:
    """The least number of lists at which searches for `asked` find `recall` of their `true` nearest rows, on average."""
    held = index.rows.select(F.col("product_id").alias("id"), "list_id")
    lists = true.join(held, "id").groupBy("query").agg(F.collect_list("list_id").alias("lists"))
    rows = lists.join(asked.withColumnRenamed("id", "query"), "query").toPandas()  # PROBE_SAMPLE rows of LARGEST_POOL numbers
    places = np.zeros(len(index.centroids) + 1)
    for row in rows.itertuples():
        order = np.argsort(-(index.centroids @ np.asarray(row.embedding)), kind="stable")
        place = np.empty(len(order), int)
        place[order] = np.arange(len(order))
        np.add.at(places, place[np.asarray(row.lists, int)] + 1, 1 / len(row.lists))
    reached = np.cumsum(places) / max(1, len(rows))
    return max(1, int(np.searchsorted(reached, recall - 1e-9))) if len(rows) else 1


def _assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    tagged = knn.tag_cells(rows, centroids)
    return tagged.select(F.col("id").alias("product_id"), "embedding", F.col("cell").alias("list_id"))


def _write_part(rows: DataFrame, codes: DataFrame | None, path: str, files: list[str] | None) -> None:
    """Store vectors with their `list_id`, and their codes, as a part of the index. Last comes the manifest's entry, so
    that a part that failed half way is never read."""
    spark, part = rows.sparkSession, uuid.uuid4().hex
    if codes is None:
        _write_lists(rows, f"{path}/vectors/part={part}")
    else:
        pages = {"parquet.page.row.count.limit": _rows_per_page(rows), "parquet.enable.dictionary": "false"}
        _write_lists(rows.withColumn("in_list", F.col("list_id")), f"{path}/vectors/part={part}", pages)
        _write_lists(codes, f"{path}/codes/part={part}")
    held = [(part, file_name(f)) for f in files] if files is not None else [(part, None)]
    spark.createDataFrame(held, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _rows_per_page(rows: DataFrame) -> int:
    """Vectors that fill a page."""
    one = rows.select(F.size("embedding").alias("parts")).first()
    return max(1, PAGE_BYTES // (8 * one.parts)) if one else 1


def _write_lists(rows: DataFrame, path: str, options: dict | None = None) -> None:
    """A folder per list, a list of many rows in several files, each in the order of its ids."""
    sizes = rows.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("files"))
    spread = rows.join(F.broadcast(sizes), "list_id").withColumn("_file", F.pmod(F.xxhash64("product_id"), F.col("files")))
    dealt = spread.repartition("list_id", "_file").sortWithinPartitions("list_id", "_file", "product_id")
    dealt.drop("_file", "files").write.options(**options or {}).partitionBy("list_id").parquet(path)


def write_index(index: VectorIndex, path: str, files: list[str] | None = None) -> None:
    """Store an index; `files` are those of the table whose vectors it holds."""
    spark = index.rows.sparkSession
    books = index.codebooks
    centroids = [(i, [float(x) for x in c], index.nprobe, books and books.depth) for i, c in enumerate(index.centroids)]
    spark.createDataFrame(centroids, CENTROIDS).coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    if books:
        entries = [(piece, book.tolist()) for piece, book in enumerate(books.books)]
        spark.createDataFrame(entries, CODEBOOKS).coalesce(1).write.mode("overwrite").parquet(f"{path}/codebooks")
    _write_part(index.rows, index.codes, path, files)


def append_index(index: VectorIndex, vectors: DataFrame) -> None:
    """Add the rows of the files of a table that a stored index does not hold, to the lists of their nearest centroids.

    Nothing is trained anew, and no other row is read."""
    new = index.not_held(vectors)
    if new is not None:
        rows = knn.directed(_as_ids(new, "product_id"), index.centroids.shape[1])
        rows = cut(_assign(rows, index.centroids))
        codes = quantise.encode(rows, index.centroids, index.codebooks) if index.codebooks else None
        _write_part(rows, codes, index.path, new.inputFiles())


def read_index(spark: SparkSession, path: str) -> VectorIndex:
    centroids = spark.read.schema(CENTROIDS).parquet(f"{path}/centroids").orderBy("list_id").toPandas()
    held = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()  # one row per file of the table
    parts = sorted({r.part for r in held})

    def lists(folder: str, column: str) -> DataFrame:
        rows = spark.read.schema(f"product_id long, {column}, part string, list_id int").parquet(f"{path}/{folder}")
        return rows.where(F.col("part").isin(parts)).drop("part")

    files = None if any(r.file is None for r in held) else frozenset(r.file for r in held)
    coded = centroids.depth.notna().all()
    vectors = lists("vectors", "embedding array<double>" + (", in_list int" if coded else ""))
    index = VectorIndex(np.stack(centroids.centroid.to_numpy()), vectors, int(centroids.nprobe[0]), files, path)
    if coded:
        books = spark.read.schema(CODEBOOKS).parquet(f"{path}/codebooks").orderBy("piece").collect()  # one row per piece
        index.codebooks = quantise.Codebooks(np.array([b.entries for b in books]), float(centroids.depth[0]))
        index.codes = lists("codes", "code binary")
    return index


def ivf_search(index: VectorIndex, query: list[float], k: int, nprobe: int | None = None) -> DataFrame:
    """Top k among the lists of the `nprobe` nearest centroids; other folders are not read.

    Of lists with codes only the codes are read, and the vectors of the rows that come nearest by them; their distances
    are exact. All lists together, and requests of more than MOST_CANDIDATES candidates, are read as vectors: exact.
    """
    nprobe = nprobe or index.nprobe
    q = np.asarray(query, dtype=np.float64)
    q = q / np.linalg.norm(q)
    near = [int(i) for i in np.argsort(-(index.centroids @ q), kind="stable")[:nprobe]]
    if index.codebooks and nprobe < len(index.centroids) and ceil(k * index.codebooks.depth) <= MOST_CANDIDATES:
        return _nearest(_candidates(index, q, near, ceil(k * index.codebooks.depth)), query, k)
    return _nearest(index.rows.where(F.col("list_id").isin(near)), query, k)


def _candidates(index: VectorIndex, query: np.ndarray, lists: list[int], number: int) -> DataFrame:
    """Vectors of the rows that are nearest by their codes. Their ids come to the driver, MOST_CANDIDATES at most."""
    distance = quantise.coded_distance(index.codebooks, index.centroids, query)
    coded = index.codes.where(F.col("list_id").isin(lists)).withColumn("distance", distance)
    found = coded.orderBy("distance", "product_id").limit(number).select("list_id", "product_id").collect()
    ids, held = sorted({r.product_id for r in found}), sorted({r.list_id for r in found})
    chosen = F.col("list_id").isin(held) & F.col("product_id").isin(ids)
    return index.rows.where(chosen & _id_ranges(sorted(map(tuple, found)), "in_list") if index.path else chosen)


def _id_ranges(places: list[tuple[int, int]], name: str) -> Column:
    """A condition on the column `name` of lists and the ids that the scan can push down to pages: ranges around sorted
    (list, id) pairs, parted between lists and at the widest gaps, joined as a balanced tree. ID_RANGES at most, or
    one per list."""
    if not places:
        return F.lit(False)
    gaps = [b[1] - a[1] if a[0] == b[0] else np.inf for a, b in zip(places, places[1:])]
    between = sum(np.isinf(gaps))
    cuts = sorted(np.argsort(-np.array(gaps), kind="stable")[: max(between, ID_RANGES - 1)].tolist())
    starts, ends = [0] + [c + 1 for c in cuts], cuts + [len(places) - 1]
    terms = [
        (F.col(name) == places[a][0]) & F.col("product_id").between(places[a][1], places[b][1]) for a, b in zip(starts, ends)
    ]
    while len(terms) > 1:
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def ivf_search_batch(index: VectorIndex, queries: DataFrame, k: int, nprobe: int | None = None) -> DataFrame:
    """`ivf_search` for a table of (query_id, embedding). Lists that no query probes are not read."""
    nprobe = nprobe or index.nprobe
    found = knn.probe_lists(
        _as_ids(queries, "query_id"), index.rows.select(F.col("product_id").alias("id"), "embedding", "list_id"),
        k, index.centroids, nprobe,
    )
    return found.withColumnsRenamed({"query": "query_id", "id": "product_id"})


def index_coverage(vectors: DataFrame, index: VectorIndex, index_name: str, table_name: str) -> DataFrame:
    """Share of the rows of a table that the stored lists hold; vectors without direction are not held. The index
    is active if it holds a row."""
    held = index.rows.select("product_id", F.lit(True).alias("_held"))
    joined = vectors.select("product_id").join(held, "product_id", "left")
    covered = F.try_divide(100.0 * F.count("_held"), F.count(F.lit(1)))
    figures = joined.agg(round2(covered).alias("coverage_percentage"), F.count("_held").alias("_rows"))
    return figures.select(
        F.lit(index_name).alias("index_name"), F.lit(table_name).alias("table_name"),
        F.when(F.col("_rows") > 0, "ACTIVE").otherwise("EMPTY").alias("index_status"), "coverage_percentage",
    )

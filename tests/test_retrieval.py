"""Neighbour join, inverted lists, search requests, price phrases."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assortment import fixed
from assortment.functions.prices import price_limits
from assortment.functions.vectors import list_array
from assortment.operators import embed, knn, retrieval, vector
from assortment.sources.lineage import cut
from checks.queries import Inputs

VECTORS = "id long, embedding array<double>"


def copies_and_ties(seed: int = 3):
    """Clustered vectors, a third of them one vector, some scaled ones, and rows without direction."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + random.normal(size=8)).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[5][1]) for i in range(120)]
    rows += [(2000 + i, [2 * x for x in rows[i][1]]) for i in range(20)]
    return rows, rows + [(5000, None), (5001, []), (5002, [0.0] * 8)]


def brute_force(asked, base, k, exclude_self=False):
    ids = np.array([r[0] for r in base])
    units = np.array([r[1] for r in base], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    out = {}
    for query, v in asked:
        v = np.array(v) / np.linalg.norm(v)
        d = np.round(np.maximum(0, 1 - units @ v), knn.DECIMALS)
        order = [j for j in np.lexsort((ids, d)) if not (exclude_self and ids[j] == query)][:k]
        out[query] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found(rows):
    out = {}
    for r in sorted(rows.collect(), key=lambda r: (r.query, r["rank"])):
        out.setdefault(r.query, []).append((r.id, r.distance))
    return out


@pytest.mark.parametrize("cells", [{}, {"CELL_ROWS": 40, "BLOCK_ROWS": 30, "CHUNK_ROWS": 64}])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_neighbours_equal_brute_force(spark, monkeypatch, cells, exclude_self):
    good, rows = copies_and_ties()
    base = spark.createDataFrame(rows, VECTORS).repartition(5)
    for name, value in cells.items():
        monkeypatch.setattr(knn, name, value)
    got = found(knn.knn_join(base, base, 7, exclude_self))
    want = brute_force(good, good, 7, exclude_self)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q, pairs in want.items():
        assert np.allclose([d for _, d in got[q]], [d for _, d in pairs], atol=1e-9)


BAD = [(9001, None), (9002, []), (9003, [0.0] * 8), (9004, [1.0] * 3), (9005, [1.0] * 16), (9006, [float("inf")] + [1.0] * 7),
       (9007, [float("nan")] * 8), (9008, [None] + [1.0] * 7), (9009, [1e200] * 8)]


def test_bad_vectors_are_left_out_everywhere(spark):
    good, _ = copies_and_ties()
    rows = spark.createDataFrame(good + BAD, VECTORS).repartition(3)
    named = rows.withColumnRenamed("id", "product_id")
    want = brute_force(good[:1], good, 9)[good[0][0]]
    top = [(r.product_id, r.distance) for r in vector.vector_top_k(named, good[0][1], 9).collect()]
    batch = vector.vector_top_k_batch(named, rows.withColumnRenamed("id", "query_id"), 9)
    index = vector.ivf_build(named, lists=5)
    probed = [(r.product_id, r.distance) for r in vector.ivf_search(index, good[0][1], 9, 5).collect()]
    own = [(r.product_id, r.distance) for r in batch.where(F.col("query_id") == good[0][0]).orderBy("rank").collect()]
    for got in (top, own, probed):
        assert [i for i, _ in got] == [i for i, _ in want]
    assert {r.query_id for r in batch.select("query_id").distinct().collect()} == {i for i, _ in good}
    assert index.rows.count() == len(good)


@pytest.mark.parametrize("kind", ["raw", "planted", "hashed"])
def test_recall_of_neighbour_descent(spark, kind):
    inputs = Inputs(spark, "/root/testdata/sf0.1" if kind != "hashed" else "/root/testdata/sf0.01")
    if kind == "hashed":
        rows = embed.embed_texts(embed.embedding_text(inputs.clean), "embedding_text", 64)
    else:
        rows = inputs.planted if kind == "planted" else inputs.embedded
    rows = cut(rows.select(F.col("product_id").alias("id"), "embedding"))
    asked = rows.where("id % 50 = 0")
    lists = lambda df: {(r["query"], r["id"]) for r in df.collect() if r["query"] % 50 == 0}
    want = lists(knn.knn_join(asked, rows, 16).where("query <> id and rank <= 16"))
    ranks = {}
    for q, i in sorted(want):
        ranks.setdefault(q, []).append(i)
    got = lists(knn.descent(rows, 15))
    assert len(got) == 15 * len(ranks)
    assert len(got & want) >= 0.95 * len(got)


def test_descent_is_the_same_for_any_partitions_and_keeps_the_rules(spark):
    good, _ = copies_and_ties()
    rows = spark.createDataFrame(good + BAD, VECTORS)
    one, other = (found(knn.descent(rows.repartition(n), 6)) for n in (1, 5))
    assert one == other and set(one) == {i for i, _ in good}
    assert all(len(near) == 6 and q not in [i for i, _ in near] for q, near in one.items())
    exact = brute_force(good, good, 7)
    assert np.mean([d <= exact[q][6][1] + 1e-9 for q, near in one.items() for _, d in near]) > 0.9
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], VECTORS)
    assert found(knn.descent(few, 5)) == {1: [(2, 1.0)], 2: [(1, 1.0)]}
    assert knn.descent(few.where("id < 0"), 3).count() == 0


def test_vectors_sent_by_descent_stay_flat(spark, monkeypatch):
    """Vectors per row and round do not grow with the table, in 50 dimensions without structure."""
    sent = []

    def counted(df):
        out = cut(df)
        if "centre" in df.columns:
            sent.append(out.select("block", "member").distinct().count())
        return out

    monkeypatch.setattr(knn, "cut", counted)
    monkeypatch.setattr(knn, "CENTRES", 32)
    per_row = []
    for n in (2000, 20000):
        units = np.random.default_rng(1).normal(size=(n, 50))
        rows = cut(spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(units)], VECTORS))
        sent.clear()
        knn.descent(rows, 10, rounds=2).count()
        per_row.append([s / n for s in sent])
    assert len(per_row[0]) == len(per_row[1]) == 2
    for small, large in zip(*per_row):
        assert large < 1.5 * small and large <= 4 * knn.LISTED + 3 * knn.RANDOM


def test_descent_finds_neighbours_among_many_rows_and_sends_a_vector_to_few_tasks(spark, monkeypatch):
    """12 000 rows in 64 dimensions without structure, where lists of 20 entries find too few."""
    n, sent = 12000, []

    def counted(df):
        out = cut(df)
        if "centre" in df.columns:
            sent.append(out.select("block", "member").distinct().count())
        return out

    monkeypatch.setattr(knn, "cut", counted)
    monkeypatch.setattr(knn, "CENTRES", 64)
    units = np.random.default_rng(3).normal(size=(n, 64))
    rows = cut(spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(units)], VECTORS))
    got = {(r["query"], r["id"]) for r in knn.descent(rows, 15).where("query % 50 = 0").collect()}
    asked, unit = range(0, n, 50), units / np.linalg.norm(units, axis=1, keepdims=True)
    near = np.argsort(-(unit[::50] @ unit.T), axis=1)[:, 1:16]
    want = {(q, i) for q, row in zip(asked, near.tolist()) for i in row}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)
    assert sent and all(s <= 24 * n for s in sent)


def test_equal_texts_of_a_log_are_searched_once_and_all_answered(spark, monkeypatch):
    """Forty rows of three texts: two with the same vector but other prices, one without a price; one has no vector."""
    n, searched = 60, []
    clean = spark.range(n).select(
        F.col("id").alias("product_id"), F.lit("a").alias("name"), F.lit("b").alias("brand"), F.lit("c").alias("category"),
        F.lit("d").alias("department"), F.col("id").cast("double").alias("retail_price"),
    )
    # Twenty copies of three vectors; distances to the first grow with id % 3.
    vectors = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(n)], "product_id long, embedding array<double>")
    texts = [("shoes under 30", [1.0, 0.0]), ("shoes under 40", [1.0, 0.0]), ("hat", [1.0, 2.0]), ("none", None)]
    rows = [(q, *texts[q % 4]) for q in range(40)]
    asked = spark.createDataFrame(rows, "query_id long, query string, embedding array<double>").repartition(5)
    groups = clean.select("product_id", F.lit("e").alias("cluster_label"))
    told = clean.where("product_id = 0").select(
        "product_id", F.lit("f").alias("description_enriched"), F.lit(None).cast("timestamp").alias("description_created_at")
    )
    true = retrieval._nearest_batch

    def counted(vectors, asked, *others):
        searched.append(asked.count())
        return true(vectors, asked, *others)

    monkeypatch.setattr(retrieval, "_nearest_batch", counted)
    found = retrieval.search_log(asked, vectors, clean, groups, told, 4)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.product_id, r.max_price, r.cluster_label, r.description_enriched))
    near = {0: [0, 3, 6, 9], 1: [0, 3, 6, 9], 2: [2, 5, 8, 11]}
    limit = {0: 30.0, 1: 40.0, 2: None}
    assert got == {
        q: [(r + 1, p, limit[q % 4], "e", "f" if p == 0 else None) for r, p in enumerate(near[q % 4])]
        for q in range(40) if q % 4 < 3
    }
    assert searched == [4]


def test_copies_behind_enough_nearer_rows_are_not_told_apart(spark):
    """Rows of many copies come whole and in order, ties of distance between vectors by id."""
    points = [[1.0, 0.0], [1.0, 0.1], [1.0, -0.1], [1.0, 3.0]]
    base = [(i, points[(i * 7) % 4]) for i in range(80)]
    frame = spark.createDataFrame(base, VECTORS).repartition(5)
    asked = spark.createDataFrame([(1000, [2.0, 0.0]), (1001, [1.0, 0.1])], VECTORS)
    for k in (5, 21, 30, 70):
        want = brute_force([(1000, [2.0, 0.0]), (1001, [1.0, 0.1])], base, k)
        got = {}
        for r in knn.knn_join(asked, frame, k).orderBy("query", "rank").collect():
            got.setdefault(r["query"], []).append(r["id"])
        assert got == {q: [i for i, _ in rows] for q, rows in want.items()}


def test_many_queries_of_few_rows_are_dealt_to_few_blocks():
    assert knn.parts(60_000, knn.BLOCK_ROWS, 64) == 12 and knn.parts(60_000, knn.BLOCK_ROWS, 64, 2) == 2
    assert knn.parts(1_600_000, knn.CHUNK_ROWS, 64, 72) == 72 and knn.parts(20_000_000, knn.CHUNK_ROWS, 64, 72) == 204


def test_fewer_rows_than_k_and_empty_sides(spark):
    base = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], VECTORS)
    assert found(knn.knn_join(base, base, 5, exclude_self=True)) == {1: [(2, 1.0)], 2: [(1, 1.0)]}
    none = base.where("id < 0")
    assert knn.knn_join(base, none, 3).count() == 0
    assert knn.knn_join(none, base, 3).count() == 0
    assert knn.knn_join(none, none, 3).count() == 0


def planted(spark):
    return Inputs(spark, "/root/testdata/sf0.01").planted.select("product_id", "embedding")


def test_recall_grows_with_probes_and_ends_exact(spark):
    vectors = planted(spark)
    index = vector.ivf_build(vectors, lists=12)
    asked = vectors.select(F.col("product_id").alias("query_id"), "embedding")
    exact = {(r.query_id, r.product_id) for r in vector.vector_top_k_batch(vectors, asked, 10).collect()}
    recall = []
    for probes in (1, 3, 12):
        got = {(r.query_id, r.product_id) for r in vector.ivf_search_batch(index, asked, 10, probes).collect()}
        recall.append(len(got & exact) / len(exact))
    assert recall == sorted(recall) and recall[0] > 0.5 and recall[-1] == 1.0


@pytest.mark.parametrize("kind", ["raw", "planted", "hashed"])
def test_recall_of_the_production_lists_and_probes(spark, kind):
    """Lists and probes as the index chooses them, on ids divisible by 50 against brute force."""
    inputs = Inputs(spark, "/root/testdata/sf0.1")
    if kind == "hashed":
        rows = embed.embed_texts(embed.embedding_text(inputs.clean), "embedding_text", 256)
    else:
        rows = inputs.planted if kind == "planted" else inputs.embedded
    index = vector.ivf_build(cut(rows.select("product_id", "embedding")))
    rows = index.rows.toPandas()
    assert len(index.centroids) >= 0.9 * vector.lists_for(len(rows))
    ids, lists, parts = rows.product_id.to_numpy(), rows.list_id.to_numpy(), np.stack(rows.embedding.to_numpy())
    parts /= np.linalg.norm(parts, axis=1, keepdims=True)
    pools = {10: [], 10 * fixed.SEARCH_OVERFETCH: [], fixed.INTENT_POOL: [], 100 * fixed.SEARCH_OVERFETCH: []}
    for i in np.flatnonzero(ids % 50 == 0):
        nearest = np.lexsort((ids, np.round(1 - parts @ parts[i], 5)))
        probed = np.isin(lists, np.argsort(-(index.centroids @ parts[i]), kind="stable")[: index.nprobe])
        for pool, found in pools.items():
            found.append(probed[nearest[:pool]].mean())
    assert all(np.mean(found) >= 0.9 for found in pools.values()), {k: np.mean(v) for k, v in pools.items()}


def coded_top(index, rows, codes, query, k):
    """Plain numpy: candidates by the codes of the probed lists, then their exact order."""
    near = np.isin(codes.list_id, np.argsort(-(index.centroids @ query), kind="stable")[: index.nprobe])
    probed, books = codes[near], index.codebooks.books
    pieces = np.zeros(books.shape[0] * books.shape[2])
    pieces[: len(query)] = query
    table = np.einsum("pcx,px->pc", books, pieces.reshape(len(books), -1))
    coded = np.array([np.frombuffer(c, np.uint8) for c in probed.code])
    distance = np.round(1 - index.centroids[probed.list_id] @ query - table[np.arange(len(books)), coded].sum(1), 12)
    chosen = probed.product_id.to_numpy()[np.lexsort((probed.product_id, distance))[: int(np.ceil(k * index.codebooks.depth))]]
    exact = np.round(1 - np.stack(rows.embedding[chosen].to_numpy()) @ query, 5)
    return chosen[np.lexsort((chosen, exact))[:k]]


@pytest.mark.parametrize("kind", ["raw", "planted", "hashed"])
def test_recall_of_codes(spark, tmp_path, kind):
    """Codes, probes and candidates as the index chooses them, on ids divisible by 50 against brute force."""
    inputs = Inputs(spark, "/root/testdata/sf0.1")
    if kind == "hashed":
        rows = embed.embed_texts(embed.embedding_text(inputs.clean), "embedding_text", 64)
    else:
        rows = inputs.planted if kind == "planted" else inputs.embedded
    vector.write_index(vector.ivf_build(cut(rows.select("product_id", "embedding")), codes=True), str(tmp_path))
    index = vector.read_index(spark, str(tmp_path))
    rows, codes = index.rows.toPandas().set_index("product_id"), index.codes.toPandas()
    assert sorted(codes.product_id) == sorted(rows.index) and set(map(len, codes.code)) == {16}
    units = np.stack(rows.embedding.to_numpy())
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    rows["embedding"] = list(units)
    ids = rows.index.to_numpy()
    for k in (10, 50):
        share = []
        for i in np.flatnonzero(ids % 50 == 0):
            nearest = ids[np.lexsort((ids, np.round(1 - units @ units[i], 5)))[:k]]
            share.append(np.isin(coded_top(index, rows, codes, units[i], k), nearest).mean())
        assert np.mean(share) >= 0.9, (kind, k, np.mean(share), index.codebooks.depth)
    first = units[np.flatnonzero(ids % 50 == 0)[0]]
    got = [r.product_id for r in vector.ivf_search(index, first.tolist(), 10).collect()]
    assert len(set(got) & set(coded_top(index, rows, codes, first, 10).tolist())) >= 9


def bytes_read(spark):
    return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())


def test_codes_read_a_fraction_of_the_bytes(spark, tmp_path):
    """Vectors that vary in 16 directions mostly, as those of texts do, not evenly in all 256."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 256))
    inner = rng.normal(size=(30_000, 16)) @ rng.normal(size=(16, 256)) / 4
    units = centres[np.arange(30_000) % 40] + 0.5 * inner + 0.05 * rng.normal(size=inner.shape)
    table = pa.table({"product_id": pa.array(range(30_000), pa.int64()), "embedding": list_array(units)})
    frame, query = cut(spark.createDataFrame(table).repartition(8)), units[7].tolist()
    index = vector.ivf_build(frame, lists=12, codes=True)
    vector.write_index(index, str(tmp_path))
    index = vector.read_index(spark, str(tmp_path))
    plain = vector.read_index(spark, str(tmp_path))
    plain.codebooks = None
    cost, answers = [], []
    spark._jsc.hadoopConfiguration().set("parquet.hadoop.vectored.io.enabled", "false")  # such reads are not counted
    for one in (plain, index):
        start = bytes_read(spark)
        answers.append({r.product_id for r in vector.ivf_search(one, query, 10, nprobe=6).collect()})
        cost.append(bytes_read(spark) - start)
    spark._jsc.hadoopConfiguration().unset("parquet.hadoop.vectored.io.enabled")
    assert len(answers[0] & answers[1]) >= 9
    assert cost[1] * 7 <= cost[0], (cost, index.codebooks.depth, index.nprobe)
    whole = vector.ivf_search(index, query, 10, nprobe=len(index.centroids)).collect()
    assert whole == vector.vector_top_k(frame, query, 10).collect()


def test_appended_rows_get_codes(spark, tmp_path):
    """Rows added to a coded index are found; few rows, copies, an odd number of parts and bad vectors are no trouble."""
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=7).tolist()) for i in range(60)] + [(100 + i, [1.0] * 7) for i in range(40)]
    bad = [(900, None), (901, []), (902, [0.0] * 7), (903, [1.0] * 3), (904, [float("nan")] * 7)]
    schema = "product_id long, embedding array<double>"
    table = str(tmp_path / "table")
    spark.createDataFrame(good[:50] + bad, schema).coalesce(1).write.parquet(table)
    held = spark.read.schema(schema).parquet(table)
    vector.write_index(vector.ivf_build(held, lists=4, codes=True), str(tmp_path / "index"), held.inputFiles())
    spark.createDataFrame(good[50:] + bad, schema).coalesce(1).write.mode("append").parquet(table)
    index = vector.read_index(spark, str(tmp_path / "index"))
    vector.append_index(index, spark.read.schema(schema).parquet(table))
    index = vector.read_index(spark, str(tmp_path / "index"))
    assert index.codes.count() == index.rows.count() == len(good)
    for query in (good[55][1], good[70][1]):
        index.nprobe = 3
        index.codebooks.depth = 4.0
        near = [r.product_id for r in vector.ivf_search(index, query, 5).collect()]
        exact = [r.product_id for r in vector.vector_top_k(spark.read.schema(schema).parquet(table), query, 5).collect()]
        assert near[0] == exact[0] and len(near) == 5
    assert vector.ivf_search(index, good[3][1], 5, nprobe=1).count() == 5


def test_ranges_of_ids_are_bounded(spark):
    random = np.random.default_rng(6)
    places = sorted((int(i % 3), int(i)) for i in random.choice(10**6, 1000, replace=False))
    assert 0 < str(vector._id_ranges(places, "in_list")).count(">=") <= vector.ID_RANGES
    rows = spark.createDataFrame(places, "in_list int, product_id long")
    assert rows.where(vector._id_ranges(places, "in_list")).count() == len(places)
    assert rows.where(vector._id_ranges(places[:40], "in_list")).count() == 40
    assert rows.where(vector._id_ranges(places[-1:], "in_list")).count() == 1 and rows.where(vector._id_ranges([], "in_list")).count() == 0


def test_lists_stay_short_in_two_levels(spark):
    """Lists in proportion to the rows of a cell: a dense group does not end in one list."""
    rng = np.random.default_rng(2)
    vectors = np.r_[rng.normal(size=(1, 12)) + 0.1 * rng.normal(size=(4000, 12)), rng.normal(size=(2000, 12))]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "product_id long, embedding array<double>")
    one = vector.ivf_build(frame, lists=128)
    two = vector.ivf_build(frame, lists=300)
    sizes = [[r["count"] for r in i.rows.groupBy("list_id").count().collect()] for i in (one, two)]
    assert 250 <= len(two.centroids) <= 320 and max(sizes[1]) < max(sizes[0]) and max(sizes[1]) < 15 * 6000 / 300
    again = vector.ivf_build(frame.repartition(7), lists=300)
    assert sum(map(len, sizes)) > 300 and again.rows.count() == 6000


def test_written_index_reads_probed_folders_only(spark, tmp_path):
    vectors = planted(spark)
    vector.write_index(vector.ivf_build(vectors, lists=9), str(tmp_path))
    index = vector.read_index(spark, str(tmp_path))
    assert index.rows.count() == vectors.count()
    query = vectors.orderBy("product_id").first().embedding
    near = vector.ivf_search(index, query, 5, nprobe=2)
    assert len({f.split("list_id=")[1].split("/")[0] for f in index.rows.inputFiles()}) == len(index.centroids)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*list_id#\d+ IN \(\d+,\d+\)", plan)
    assert near.count() == 5
    everything = vector.ivf_search(index, query, 5, nprobe=len(index.centroids)).collect()
    assert everything == vector.vector_top_k(vectors, query, 5).collect()


PHRASES = {  # text: (min, max)
    "jean slim moins de 80$": (None, 80.0), "under $80": (None, 80.0), "max 50€": (None, 50.0), "80$ max": (None, 80.0),
    "jusqu'à 80": (None, 80.0), "plus de 30$": (30.0, None), "over $30": (30.0, None),
    "min 30": (30.0, None), "au moins 30": (30.0, None), "à partir de 30": (30.0, None), "entre 20 et 100": (20.0, 100.0),
    "between 20 and 100": (20.0, 100.0), "robe d'été": (None, None), "MAX 49,90 €": (None, 49.9),
    "80 € max": (None, 80.0), "moins de 80 €": (None, 80.0),
    "pas plus de 80": (80.0, 80.0), "au dessus de 40": (None, 40.0), "jusqu’à 80": (None, None),
    "max 90 entre 20 et 60": (20.0, 60.0),
}
STRICT = {"pas plus de 80": (None, 80.0), "au dessus de 40": (40.0, None), "jusqu’à 80": (None, 80.0)}


@pytest.mark.parametrize("strict", [False, True])
def test_price_phrases(spark, strict):
    rows = spark.createDataFrame([(t,) for t in PHRASES], "query string")
    low, high = price_limits(F.col("query"), strict)
    got = {r[0]: (r[1], r[2]) for r in rows.select("query", low, high).collect()}
    assert got == PHRASES | (STRICT if strict else {})


def test_filter_runs_after_the_search_unless_asked_otherwise(spark):
    n = 40
    clean = spark.createDataFrame(
        [(i, "n", "b", "c", "d", float(i)) for i in range(n)],
        "product_id long, name string, brand string, category string, department string, retail_price double",
    )
    embedded = spark.createDataFrame([(i, [1.0, i / 10]) for i in range(n)], "product_id long, embedding array<double>")
    clustered = spark.createDataFrame([(0, 1, "L")], "product_id long, cluster_id long, cluster_label string")
    texts = spark.createDataFrame([], "product_id long, description_enriched string, description_created_at timestamp")

    def ids(**options):
        rows = retrieval.search_products([1.0, 0.0], clean, embedded, clustered, texts, 3, **options)
        return [r.product_id for r in rows.collect()]

    assert ids() == [0, 1, 2]
    assert ids(min_price=13) == [13, 14]
    assert ids(min_price=13, prefilter=True) == [13, 14, 15]
    assert ids(min_price=2, max_price=3) == [2, 3]
    for wrong in ({"max_price": -1}, {"query": ""}, {"query": "x" * 501}):
        with pytest.raises(ValueError):
            ids(**wrong)
    with pytest.raises(ValueError):
        retrieval.check_search("q", 101, None, None)
    with pytest.raises(ValueError):
        retrieval.check_intent("ab", 5)
    with pytest.raises(ValueError):
        retrieval.check_intent("abc", 11)


def test_equal_hits_go_to_the_cluster_of_the_nearest(spark):
    hits = spark.createDataFrame(
        [(1, 5, 0.3), (2, 6, 0.1), (3, 5, 0.2), (4, 6, 0.4), (5, 7, 0.0)], "product_id long, cluster_id long, distance double"
    )
    assert [r.cluster_id for r in retrieval.intent_clusters(hits, 2).collect()] == [6, 5]


def test_replies_with_missing_or_broken_json(spark):
    rows = spark.createDataFrame([('{"positioning": "p"}',), ("no json",)], "reply string")
    got = [tuple(r)[1:] for r in retrieval.parse_brief(rows).collect()]
    assert got == [("p", "", ""), ("", "", "")]
    with pytest.raises(Exception):
        retrieval.parse_brief(rows, strict=True).collect()


def test_hashed_vectors(spark):
    rows = spark.createDataFrame(
        [(1, "Red ring, red"), (2, "RED RED RING"), (3, " .. "), (4, None), (5, ""), (6, "blue bolt")], "id long, t string"
    ).repartition(3)
    got = {r.id: r.embedding for r in embed.embed_texts(rows, "t", 32).collect()}
    assert got[1] == got[2] and got[3] is None and got[4] is None and got[5] is None
    assert len(got[1]) == 32 and abs(np.linalg.norm(got[1]) - 1) < 1e-12 and got[6] != got[1]


def test_rows_sent_by_an_exact_join_grow_with_the_table(spark, monkeypatch):
    """A row goes to GRID tasks on either side, however many blocks of least size the table has."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 4)
    monkeypatch.setattr(knn, "CHUNK_ROWS", 4)
    rng = np.random.default_rng(11)
    table = pa.table({"id": pa.array(range(480), pa.int64()), "embedding": list_array(rng.normal(size=(480, 5)))})
    base = cut(spark.createDataFrame(table))
    for side in knn._dealt(base.withColumnRenamed("id", "query"), base, 480, 5, None, None):
        assert side.count() == knn.GRID * 480
    assert knn.parts(600_000, 4096, 64) == knn.GRID and knn.parts(10, 4096, 64) == 1
    assert knn.parts(10**7, 4096, 64) * knn.BLOCK_BYTES >= 10**7 * 64 * 8


@pytest.mark.parametrize("spread", [1.0, 1e-6, 0.0])
def test_nearest_rows_in_tiles(monkeypatch, spread):
    """Short products only choose; near and equal copies, which they cannot tell apart, are ordered by the full ones."""
    monkeypatch.setattr(knn, "TILE", (7, 40))
    rng = np.random.default_rng(12)
    units = rng.normal(size=(1, 9)) + spread * rng.normal(size=(300, 9))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    ids = rng.permutation(300) * 3
    query, found, distance = knn.nearest_rows(np.arange(20), units[:20], ids, units, 6)
    d = np.round(np.maximum(0.0, 1.0 - units[:20] @ units.T), knn.DECIMALS)
    want = [sorted(zip(row.tolist(), ids.tolist()))[:6] for row in d]
    got = [list(zip(distance[query == q].tolist(), found[query == q].tolist())) for q in range(20)]
    assert sum(([w for w, _ in row] for row in got), []) == pytest.approx(sum(([w for w, _ in row] for row in want), []), abs=1.5e-10)
    assert spread < 1 and spread > 0 or got == want

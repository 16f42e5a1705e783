"""Components, level clusters and labels against plain Python and against planted groups."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assortment.functions.vectors import list_array
from assortment.operators import clusters, condense, knn, labels, spanning
from assortment.operators.components import connected_components
from assortment.sources.lineage import cut
from checks.queries import Inputs

EDGES = "a long, b long, weight double"


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


GRAPHS = {
    "path": [(i, i + 1) for i in range(60)],
    "shuffled path": [(a * 37 % 61, (a + 1) * 37 % 61) for a in range(60)],
    "star": [(0, i) for i in range(1, 61)],
    "star with a large centre": [(60, i) for i in range(60)],
    "sparse": [(random.Random(i).randrange(61), random.Random(i + 999).randrange(61)) for i in range(40)],
    "none": [],
}


@pytest.mark.parametrize("graph", GRAPHS)
def test_components(spark, graph):
    nodes = spark.createDataFrame([(i,) for i in range(61)], "node long")
    edges = spark.createDataFrame(GRAPHS[graph], "a long, b long").repartition(3)
    got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
    assert got == union_find(range(61), GRAPHS[graph])


def test_components_of_independent_graphs(spark):
    nodes = spark.createDataFrame([(g, i) for g in (1, 2) for i in range(5)], "level int, node long")
    edges = spark.createDataFrame([(1, 0, 1), (1, 3, 4), (2, 1, 2)], "level int, a long, b long")
    got = {(r.level, r.node): r.component for r in connected_components(nodes, edges, ("level",)).collect()}
    assert [got[1, i] for i in range(5)] == [0, 0, 2, 3, 3]
    assert [got[2, i] for i in range(5)] == [0, 1, 1, 3, 4]


def level_clusters(edges, nodes, size, allow_single=False):
    """The clustering rule at every weight there is, level by level, in plain Python."""
    limits = sorted({max(w, 1e-6) for _, _, w in edges})
    big, found, root = [], [], {n: n for n in nodes}
    rising = sorted((max(w, 1e-6), a, b) for a, b, w in edges)
    at = 0

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for limit in limits:
        while at < len(rising) and rising[at][0] <= limit:
            a, b = find(rising[at][1]), find(rising[at][2])
            root[max(a, b)] = min(a, b)
            at += 1
        members = {}
        for n in nodes:
            members.setdefault(find(n), []).append(n)
        found.append({n: c for c, m in members.items() for n in m if len(m) >= size})
        big.append({c: m for c, m in members.items() if len(m) >= size})
    last = len(limits) - 1
    top, children = {}, {}
    for level in range(last, -1, -1):
        for c in big[level]:
            up = (level + 1, found[level + 1][c]) if level < last else None
            alone = up and sum(found[level + 1][o] == up[1] for o in big[level]) == 1
            top[level, c] = top[up] if alone else (level, c)
            if not alone and up:
                children.setdefault(top[up], []).append((level, c))
    stability, tight = {}, {}
    for (level, c), head in top.items():
        gain = len(big[level][c]) * (1 / limits[level] - (1 / limits[level + 1] if level < last else 0))
        stability[head] = stability.get(head, 0.0) + gain
        tight[head] = min(tight.get(head, level), level)
    roots = [h for h in stability if h[0] == last]

    def best(head):
        """(total, chosen) below and including a cluster."""
        below = [best(c) for c in children.get(head, [])]
        total = sum(t for t, _ in below)
        lone = not allow_single and head in roots and len(roots) == 1
        if not lone and round(stability[head], 6) >= round(total, 6):
            return stability[head], [head]
        return max(total, stability[head]), [h for _, chosen in below for h in chosen]

    chosen = sorted((h for r in roots for h in best(r)[1]), key=lambda h: h[1])
    out = {}
    for number, head in enumerate(chosen):
        for (level, c), owner in sorted(top.items()):
            if owner == head:
                for n in big[level][c]:
                    out.setdefault(n, (number, round(limits[tight[head]] / limits[level], 6)))
    return out


def whole_tree(ids, vectors, k=15, min_samples=10):
    """Spanning edges of the mutual reachability distances between all vectors, by Prim's rule; and the cores."""
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    d = np.round(np.maximum(0, 1 - units @ units.T), 10)
    np.fill_diagonal(d, -1)
    cores = np.sort(d, axis=1)[:, min_samples]
    np.fill_diagonal(d, 0)
    d = np.maximum(d, np.maximum(cores[:, None], cores))
    best, near, left, at, edges = np.full(len(ids), np.inf), np.zeros(len(ids), int), np.ones(len(ids), bool), 0, []
    for _ in range(len(ids) - 1):
        left[at] = False
        closer = d[at] < best
        near[closer], best = at, np.minimum(best, d[at])
        at = int(np.where(left, best, np.inf).argmin())
        edges.append((ids[near[at]], ids[at], float(best[at])))
    return edges


def tables(spark, edges, cores):
    return (
        spark.createDataFrame(edges, EDGES).repartition(3),
        spark.createDataFrame(list(cores.items()), "product_id long, core double").repartition(2),
    )


def selected(rows):
    return {r.product_id: (r.cluster_id, round(r.cluster_probability, 6)) for r in rows.collect()}


def nested_groups(seed):
    """Groups in groups: close pairs have small weights, so the tree splits at several levels."""
    rng = random.Random(seed)
    place = {n: (n // 40) * 8 + (n // 20 % 2) * (2 + n // 40) + rng.random() for n in range(120)}
    ids = {n: (n * 71) % 1009 for n in place}
    edges, cores = [], {}
    for n in place:
        near = sorted((abs(place[n] - place[m]), m) for m in place if m != n)[:8]
        cores[ids[n]] = near[2][0] / 30
        edges += [(n, m, d / 30) for d, m in near]
    edges += [(39, 40, 0.2), (79, 80, 0.25)] if seed % 2 else []
    pairs = {}
    for n, m, d in edges:
        key = (min(ids[n], ids[m]), max(ids[n], ids[m]))
        pairs[key] = max(cores[key[0]], cores[key[1]], d) if key not in pairs else min(pairs[key], max(cores[key[0]], cores[key[1]], d))
    return [(a, b, w) for (a, b), w in pairs.items()], cores


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [4, 12])
def test_selection_equals_plain_python(spark, seed, size):
    edges, cores = nested_groups(seed)
    got = selected(clusters.select_clusters(*tables(spark, edges, cores), min_cluster_size=size))
    want = level_clusters(edges, cores, size)
    assert got == want and len({c for c, _ in want.values()}) > 1


def test_small_steps_give_the_same(spark, monkeypatch):
    """Rounds of contraction in Spark instead of one sort, and a hierarchy in many steps."""
    monkeypatch.setattr(spanning, "LOCAL_EDGES", 40)
    monkeypatch.setattr(condense, "STEP_EDGES", 45)
    edges, cores = nested_groups(1)
    assert selected(clusters.select_clusters(*tables(spark, edges, cores), min_cluster_size=4)) == level_clusters(edges, cores, 4)


def steps_of(monkeypatch, edges):
    """The sizes of the steps that the driver takes in, steps being of so many edges."""
    taken, merge = [], condense.merge
    monkeypatch.setattr(condense, "STEP_EDGES", edges)
    monkeypatch.setattr(condense, "merge", lambda table, *rest: taken.append(len(table)) or merge(table, *rest))
    return taken


@pytest.mark.parametrize("size", [4, 30])
def test_edges_of_one_weight_are_not_gathered(spark, monkeypatch, size):
    """Most edges have one of four weights: components grow, start as clusters and meet, many at once."""
    rng = random.Random(size)
    ids = rng.sample(range(10_000), 400)
    weights = [0.0, 0.1, 0.1, 0.2, 0.2, 0.3, 0.3, None]
    edges = [(ids[rng.randrange(max(0, n - 25), n)], ids[n], rng.choice(weights)) for n in range(1, len(ids)) if n % 90]
    edges = [(min(a, b), max(a, b), rng.random() if w is None else w) for a, b, w in edges]
    want = level_clusters(edges, ids, size)
    taken = steps_of(monkeypatch, 20)
    got = selected(clusters.select_clusters(*tables(spark, edges, dict.fromkeys(ids, 0.0)), min_cluster_size=size))
    assert got == want and len({c for c, _ in want.values()}) > 2
    assert taken and max(taken) <= 25


def test_copies_of_vectors_are_not_gathered(spark, monkeypatch):
    """Edges between copies have no length: those of 40 are a cluster at once, those of 12 wait for others."""
    rng = np.random.default_rng(2)
    knots = rng.standard_normal((6, 8))
    near = np.repeat(knots, 5, axis=0) + 0.05 * rng.standard_normal((30, 8))
    taken = steps_of(monkeypatch, 30)
    want = held_against_plain(spark, rng.permutation(np.r_[np.repeat(knots, [40, 40, 40, 12, 12, 12], axis=0), near]))
    assert len({c for c, _ in want.values()}) > 2 and max(taken) <= 37


def test_tables_of_rows_are_not_broadcast(spark):
    """Cores of few values make small files, whatever the number of rows."""
    rows = spark.range(3000).select(F.col("id").alias("product_id"), F.lit(0.0).alias("core"))
    graph = rows.select("product_id", ((F.col("product_id") + 1) % 3000).alias("neighbour_id"), F.lit(0.0).alias("distance"))
    edges = clusters.reachability_edges(cut(graph), cut(rows))
    assert "BroadcastHashJoin" not in edges._jdf.queryExecution().executedPlan().toString()
    assert edges.count() == 3000


def test_forest_has_the_least_weights(spark, monkeypatch):
    rng = random.Random(5)
    edges = {(min(a, b), max(a, b)): rng.randrange(9) / 10 for a, b in ((rng.randrange(300), rng.randrange(300)) for _ in range(900)) if a != b}
    frame = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], EDGES)
    nodes = {n for e in edges for n in e}
    root, total, kept = {n: n for n in nodes}, 0.0, 0
    for (a, b), w in sorted(edges.items(), key=lambda e: e[1]):
        ends = []
        for n in (a, b):
            while root[n] != n:
                n = root[n]
            ends.append(n)
        if ends[0] != ends[1]:
            root[max(ends)], total, kept = min(ends), total + w, kept + 1
    for local in (1 << 18, 10):
        monkeypatch.setattr(spanning, "LOCAL_EDGES", local)
        got = spanning.spanning_forest(frame).collect()
        assert len(got) == kept and abs(sum(r.weight for r in got) - total) < 1e-9
        assert len(set(union_find(nodes, [(r.u, r.v) for r in got]).values())) == len(nodes) - kept
    assert spanning.spanning_forest(frame.where("a < 0")).count() == 0


def uneven(n, seed):
    """Groups of very different densities and sizes, some in one another, with copies and scattered rows."""
    rng = np.random.default_rng(seed)
    parts = []
    for share, spread, groups in ((0.3, 0.02, 3), (0.3, 0.15, 5), (0.2, 0.4, 4)):
        centres = rng.standard_normal((groups, 12))
        rows = int(n * share)
        parts.append(centres[rng.integers(0, groups, rows)] + spread * rng.standard_normal((rows, 12)))
    parts.append(parts[0][:1] + 0.2 * rng.standard_normal((n // 20, 12)))
    parts.append(np.repeat(parts[1][:1], n // 20, axis=0))
    parts.append(rng.standard_normal((n - sum(map(len, parts)), 12)))
    return rng.permutation(np.concatenate(parts))


def held_against_plain(spark, vectors, size=15, **options):
    ids = [(i * 7919) % 100_003 for i in range(len(vectors))]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "product_id long, embedding array<double>")
    got = {r.product_id: (r.cluster_id, round(r.cluster_probability, 6)) for r in clusters.cluster_vectors(frame, size, **options).collect()}
    want = level_clusters(whole_tree(ids, vectors), ids, size)
    assert got == {i: want.get(i, (-1, 0.0)) for i in ids}
    return want


def test_whole_hierarchy_of_uneven_groups(spark):
    want = held_against_plain(spark, uneven(2000, 3))
    assert len({c for c, _ in want.values()}) > 6


def test_whole_hierarchy_in_small_parts(spark, monkeypatch):
    """Many blocks, short lists of components, rounds in Spark, many steps."""
    monkeypatch.setattr(spanning, "BLOCK_ROWS", 70)
    monkeypatch.setattr(spanning, "LISTED", 2)
    monkeypatch.setattr(spanning, "LOCAL_EDGES", 1500)
    monkeypatch.setattr(condense, "STEP_EDGES", 130)
    held_against_plain(spark, uneven(400, 4))


def test_dense_knots_joined_by_no_list(spark):
    """Two knots that lists keep apart, and a row between them and nothing: the knots meet before they meet the row."""
    rng = np.random.default_rng(9)
    base, other = rng.standard_normal((2, 10))
    knots = np.r_[base + 0.01 * rng.standard_normal((30, 10)), base + 0.3 * other + 0.01 * rng.standard_normal((30, 10))]
    far = -base + 0.02 * rng.standard_normal((40, 10))
    assert len({c for c, _ in held_against_plain(spark, np.r_[knots, far]).values()}) >= 2


@pytest.mark.parametrize("options", [{"nprobe": 4}, {"descent": True}, {"nprobe": 2, "descent": True}])
def test_probing_and_descent_find_separate_groups(spark, monkeypatch, options):
    monkeypatch.setattr(knn, "CELL_ROWS", 100)
    monkeypatch.setattr(knn, "CENTRES", 64)
    planted = cut(Inputs(spark, "/root/testdata/sf0.01").planted.select("product_id", "embedding", "label"))
    rows = clusters.cluster_vectors(planted.drop("label"), **options).join(planted, "product_id").toPandas()
    real = rows[rows.cluster_id >= 0]
    assert real.cluster_id.nunique() == 9 and real[real.label != 9].groupby("cluster_id").label.nunique().max() == 1


def test_one_blob_is_no_cluster_unless_allowed(spark):
    edges = [(i, i + 1, 0.1 + i / 1000) for i in range(30)]
    cores = {i: 0.1 for i in range(31)}
    args = tables(spark, edges, cores)
    assert clusters.select_clusters(*args, min_cluster_size=25).count() == 0
    assert clusters.select_clusters(*args, min_cluster_size=25, allow_single=True).count() == 31
    assert clusters.select_clusters(*tables(spark, edges[:3], {0: 0.1}), min_cluster_size=25).count() == 0


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_planted_groups_are_found(spark, scale):
    planted = cut(Inputs(spark, f"/root/testdata/{scale}").planted)
    rows = clusters.cluster_vectors(planted.select("product_id", "embedding"))
    rows = rows.join(planted.select("product_id", "label"), "product_id").toPandas()
    real = rows[rows.cluster_id >= 0]
    assert real.cluster_id.nunique() == 9
    assert real[real.label != 9].groupby("cluster_id").label.nunique().max() == 1
    assert (rows[rows.label != 9].cluster_id == -1).sum() == 0
    assert (rows[rows.label == 9].cluster_id >= 0).mean() <= 0.1
    assert (rows[rows.cluster_id == -1].cluster_probability == 0).all()
    assert real.cluster_probability.between(0, 1).all()
    assert (real.groupby("cluster_id").cluster_probability.max() == 1).all()
    first = real.groupby("cluster_id").product_id.min()
    assert list(first.sort_values().index) == sorted(first.index)


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_components_at_one_level_follow_the_labels(spark, scale):
    planted = cut(Inputs(spark, f"/root/testdata/{scale}").planted)
    graph = cut(clusters.knn_graph(planted.select("product_id", "embedding")))
    cores = clusters.core_distance(graph)
    found = clusters.components_at_level(clusters.reachability_edges(graph, cores), cores, 0.4)
    sizes = found.groupBy("component").count().where("count >= 15")
    rows = found.join(sizes, "component").join(planted.select("product_id", "label"), "product_id").toPandas()
    assert rows.component.nunique() == 9
    assert rows.groupby("component").label.nunique().max() == 1
    assert 9 not in set(rows.label)
    assert len(rows) == planted.where("label <> 9").count()


def test_result_does_not_depend_on_order_or_partitions(spark):
    planted = Inputs(spark, "/root/testdata/sf0.001").planted.select("product_id", "embedding")
    one = selected(clusters.cluster_vectors(planted.coalesce(1)))
    other = selected(clusters.cluster_vectors(planted.orderBy(F.desc("product_id")).repartition(7)))
    assert one == other


def test_too_few_rows(spark):
    planted = Inputs(spark, "/root/testdata/sf0.001").planted.where("product_id < 14")
    with pytest.raises(ValueError):
        clusters.cluster_vectors(planted)


def test_reduced_dimensions(spark):
    planted = Inputs(spark, "/root/testdata/sf0.001").planted.select("product_id", "embedding")
    reduced = clusters.reduce_dims(planted, 20)
    assert {r.n for r in reduced.select(F.size("embedding").alias("n")).distinct().collect()} == {20}
    assert clusters.reduce_dims(planted, 64) is not None and clusters.reduce_dims(planted, 64).count() == 500


def test_samples_and_labels(spark):
    clustered = spark.createDataFrame(
        [(i, 1) for i in range(40)] + [(100, 2), (101, 2), (200, -1)], "product_id long, cluster_id long"
    )
    clean = spark.createDataFrame(
        [(i, f"RED RING {i}", "GOLD") for i in range(40) if i != 3] + [(100, "RED BOLT", "IRON")],
        "product_id long, name string, category string",
    )
    got = {r.cluster_id: r.samples for r in labels.label_samples(clustered, clean).collect()}
    assert got[1] == [f"RED RING {i} (GOLD)" for i in range(16) if i != 3] and got[2] == ["RED BOLT (IRON)"]
    named = {r.cluster_id: r.cluster_label for r in labels.label_clusters(clustered, clean).collect()}
    assert named == {1: "Gold Ring Red", 2: "Bolt Iron Red"}

    def shout(prompts):
        return [(' "Soft Gold" ', len(p), 2) for p in prompts]

    named = labels.label_clusters(clustered, clean, shout)
    assert {r.cluster_label for r in named.collect()} == {"Soft Gold"}


def test_contrast_labels_name_what_sets_clusters_apart(spark):
    """Frequent words that all clusters share do not name them; labels of different clusters differ."""
    themes = {1: "thin gold ring", 2: "steel bolt", 3: "wool"}
    rows = [(10 * c + n, c, f"Best Shop {t} item {n}") for c, t in themes.items() for n in range(10)]
    rows += [(90, -1, "noise words"), (91, 4, ""), (92, 4, None)]
    clustered = spark.createDataFrame([r[:2] for r in rows], "product_id long, cluster_id long").repartition(3)
    clean = spark.createDataFrame([(r[0], r[2], "") for r in rows], "product_id long, name string, category string")
    named = {r.cluster_id: r.cluster_label for r in labels.label_clusters(clustered, clean, contrast=True).collect()}
    assert sorted(named) == [1, 2, 3] and len(set(named.values())) == 3
    assert named[1].startswith("Thin Gold Ring") and "Steel Bolt" in named[2] and "Wool" in named[3]
    assert all(1 <= len(label.split()) <= 5 for label in named.values())
    found = {(r.cluster_id, r.phrase): (r.n, r.contrast) for r in labels.phrase_contrast(clustered, clean).collect()}
    inside, outside, cluster, every = 10, 0, 10, 32
    cells = [(inside, 10, cluster), (outside, 10, every - cluster), (0, every - 10, cluster), (every - cluster, every - 10, every - cluster)]
    ratio = 2 * sum(k * np.log(k * every / (a * b)) for k, a, b in cells if k)
    assert found[1, "gold ring"] == (10, round(ratio, 6)) and (-1, "noise") not in found
    assert abs(found[2, "best shop"][1]) < found[2, "steel"][1]
    assert labels.contrast_labels(clustered.where("cluster_id < 0"), clean).count() == 0
    alone = labels.contrast_labels(clustered.where("cluster_id = 3"), clean).collect()
    assert [r.cluster_label.split()[0] for r in alone] == ["Best"]


def test_reduced_vectors_keep_the_largest_directions(spark):
    """The projection equals that of another decomposition, up to the sign of each direction."""
    rows = Inputs(spark, "/root/testdata/sf0.001").planted.select("product_id", "embedding").orderBy("product_id").collect()
    whole = np.array([r.embedding for r in rows])
    frame = spark.createDataFrame([(r.product_id, r.embedding) for r in rows], "product_id long, embedding array<double>")
    short = np.array([r.embedding for r in clusters.reduce_dims(frame, 50).orderBy("product_id").collect()])
    _, _, directions = np.linalg.svd(whole - whole.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(short), np.abs(whole @ directions[:50].T), atol=1e-6)


def test_search_of_components_takes_equal_vectors_once(spark, monkeypatch):
    """Sixty copies of each of eight vectors, one component each: eight rows search, each sent to few tasks."""
    monkeypatch.setattr(spanning, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(13)
    rows = pa.table({
        "id": pa.array(range(480), pa.int64()), "embedding": list_array(np.repeat(rng.normal(size=(8, 5)), 60, axis=0)),
        "core": np.tile(np.r_[0.2, np.full(59, 0.3)], 8),
    })
    labels = pa.table({"node": pa.array(range(480), pa.int64()), "a": np.repeat(np.arange(8) * 60, 60)})
    rows, labels = spark.createDataFrame(rows), spark.createDataFrame(labels)
    search = spanning._Search(rows, labels, None)
    assert sorted(r.id for r in search.stored.collect()) == [60 * i for i in range(8)]
    assert search.nearest(labels).count() == 8 * 7
    left, right = search._sides(labels)
    assert left.count() + right.count() == 8 * (search.blocks + 1) and search.blocks == 2


@pytest.mark.parametrize("components", [3, 12, 200])
def test_components_by_tiles(monkeypatch, components):
    """The nearest others of each component of a block pair, against all pairs."""
    monkeypatch.setattr(spanning, "TILE_ROWS", 16)
    monkeypatch.setattr(spanning, "LISTED", 5)
    rng = np.random.default_rng(components)
    sides, parts = [], []
    for first, n in ((0, 90), (1000, 70)):
        vectors, cores = rng.normal(size=(n, 6)), np.round(0.3 * rng.random(n), 10)
        labels = 7 * rng.integers(0, components, n)
        sides.append(pa.table({"id": first + np.arange(n), "embedding": list_array(vectors), "core": cores, "a": labels}))
        parts.append((vectors / np.linalg.norm(vectors, axis=1, keepdims=True), cores, labels))
    (x, core_x, a), (y, core_y, b) = parts
    weight = np.maximum(np.maximum(np.round(np.maximum(0.0, 1.0 - x @ y.T), 10), core_x[:, None]), core_y)
    best = {}
    for i, j in zip(*np.nonzero(a[:, None] != b)):
        for pair in ((a[i], b[j]), (b[j], a[i])):
            best[pair] = min(best.get(pair, 9.0), weight[i, j])
    want = {c: sorted((w, d) for (e, d), w in best.items() if e == c)[:5] for c in {e for e, _ in best}}
    got = {}
    for r in spanning._component_distances(*sides).to_pylist():
        assert weight[r["u"], r["v"] - 1000] == pytest.approx(r["weight"], abs=1e-9)
        got.setdefault(r["a"], []).append((r["weight"], r["b"]))
    assert {c: [d for _, d in sorted(v)] for c, v in got.items()} == {c: [d for _, d in v] for c, v in want.items()}

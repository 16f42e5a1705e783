"""Hard negatives against brute force, the tree's ranges and pruning, hard rows."""

import numpy as np
import pytest

from assortment.llm import hard_negatives
from assortment.llm.hard_negatives import FAR, Tree
from assortment.llm.queries import ORACLES, QUERIES
from checks.compare import difference, in_duckdb, in_spark

DATA = "/root/testdata/sf0.01"


def brute(rows, positives=5, negatives=5, least=80):
    """All (anchor, positive, rank, negative, scores) rows by comparing everything; `rows` are (id, label, x, anchor)."""
    width = max((len(x) for _, _, x, _ in rows), default=0)
    x = np.array([list(v) + [0] * (width - len(v)) for _, _, v, _ in rows], object).reshape(len(rows), width)
    order = lambda s: sorted(s, key=lambda p: (-p[0], p[1] is None, p[1] or 0))
    out = []
    for a, (anchor, label, _, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        scores = [int(s) for s in x @ x[a]] if width else [0] * len(rows)
        best = order([(scores[i], r[0]) for i, r in enumerate(rows) if i != a and r[1] == label])[:positives]
        others = order([(scores[i], r[0]) for i, r in enumerate(rows) if r[1] != label])
        for score, positive in best:
            fits = [(s, i) for s, i in others if least * score <= 100 * s <= 100 * score][:negatives]
            out += [(anchor, positive, n, i, score, s) for n, (s, i) in enumerate(fits, 1)]
    return out


def mined(spark, rows, partitions=3, **options):
    schema = "id long, label int, x array<long>, anchor boolean, row string, window int, low long, found_id int"
    df = spark.createDataFrame([(*r, "r", 1, 2, 3) for r in rows], schema).repartition(partitions)
    return [tuple(r) for r in hard_negatives.mined(df, **options).collect()]


def same(got, want):
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_query_equals_its_sql(spark):
    got = in_spark(spark, QUERIES["op11_hard_negatives"], DATA)
    assert len(got[1]) > 50 and difference(got, in_duckdb(ORACLES["op11_hard_negatives"], DATA)) is None


@pytest.fixture
def small_parts(monkeypatch):
    """A deep tree, several blocks per leaf, several chunks per block."""
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "FANOUT", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK_BYTES", 600)
    monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", 5)


def grouped(n, d=5, groups=6, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (groups, d))
    x = centres[rng.integers(0, groups, n)] + rng.integers(-6, 7, (n, d))
    return [(i, int(rng.integers(0, 3)), x[i].tolist(), i % 7 == 0) for i in range(n)]


@pytest.mark.parametrize("seed", [0, 1])
def test_brute_force_through_a_deep_tree(spark, small_parts, seed):
    rows = grouped(150, seed=seed)
    want = brute(rows)
    assert len(want) > 50
    same(mined(spark, rows), want)


def test_any_partitions_and_options(spark, small_parts):
    rows = grouped(90, seed=4)
    for partitions in (1, 7):
        same(mined(spark, rows, partitions, positives=2, negatives=3, least_percent=50), brute(rows, 2, 3, 50))


def test_ties_copies_and_a_hot_vector(spark, small_parts):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(0, 2)), [3, 1, 2], i % 9 == 0) for i in range(40)]
    rows += [(100 + i, i % 2, [int(v) for v in rng.integers(0, 3, 3)], i % 5 == 0) for i in range(40)]
    rows += [rows[3], rows[9], rows[50]]
    same(mined(spark, rows), brute(rows))


def test_hard_rows(spark):
    rows = [
        (1, 0, [1, 2], True), (2, 0, [2, 1], False), (3, 1, [1, 1], None), (None, 1, [2, 2], True), (4, 1, [], True), (5, 0, [4], True),
        (-7, 2, [-1, -2], True), (6, 2, [3, 3], False), (8, 0, [0, 0], True),
    ]
    out_of_it = [(9, None, [1, 2], True), (10, 0, None, True), (11, 1, [1, None], True)]
    want = brute([(i, g, x, bool(a)) for i, g, x, a in rows])
    assert want
    same(mined(spark, rows + out_of_it), want)
    assert mined(spark, out_of_it) == [] and mined(spark, rows[:1]) == [] and mined(spark, [r for r in rows if r[1] == 0]) == []


def test_rows_of_vectors(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame(
        [(1, [0.5, -0.001], 1), (2, [nan, 0.0], 1), (3, [inf, 0.0], 1), (4, [None, 0.0], 1), (5, None, 1), (6, [0.1, 0.2], None)],
        "vec_id long, embedding array<float>, label int",
    )
    import pyspark.sql.functions as F

    got = hard_negatives.rows_of_vectors(df, "vec_id", F.col("label"), "embedding", F.lit(True), 256).collect()
    assert [(r.id, r.x) for r in got] == [(1, [128, -1]), (6, [25, 51])]
    none = spark.createDataFrame([], df.schema)
    assert hard_negatives.mined(hard_negatives.rows_of_vectors(none, "vec_id", F.col("label"), "embedding", F.lit(True), 256)).count() == 0


def test_scores_that_are_not_exact_are_refused(spark):
    with pytest.raises(ValueError):
        mined(spark, [(1, 0, [1 << 27], True), (2, 1, [1], False)])


def test_ranges_hold_their_rows_and_prune():
    rng = np.random.default_rng(7)
    centres = rng.integers(-200, 200, (12, 6))
    rows = (centres[rng.integers(0, 12, 4000)] + rng.integers(-5, 6, (4000, 6))).astype(float)
    top = float(np.square(rows).sum(1).max())
    tree = Tree.built(rows[:500], top, 2)
    halves = [Tree.built(rows[:500], top, 2) for _ in range(2)]
    for half, part in zip(halves, (rows[:1000], rows[1000:])):
        half.routed(part, ranges=True)
    tree.set_ranges(np.minimum(halves[0].ranges(), halves[1].ranges()))
    leaf = tree.routed(rows)
    assert len(np.unique(leaf)) > 20
    anchors = rows[::200]
    scores = anchors @ rows.T
    low = np.sort(scores, axis=1)[:, -20:-19].astype(np.int64)
    high = np.full_like(low, FAR)
    visited = tree.visits(anchors, low, high)
    for a in range(len(anchors)):
        assert visited[a, np.unique(leaf[scores[a] >= low[a]])].all()
    assert visited.mean() < 0.3  # an annulus leaves most subtrees out
    # Only the band below: what lies above `high` may be left out as well.
    band = tree.visits(anchors, low - 3000, low - 2000)
    for a in range(len(anchors)):
        inside = (scores[a] >= low[a] - 3000) & (scores[a] <= low[a] - 2000)
        assert band[a, np.unique(leaf[inside])].all()
    assert not tree.visits(anchors, high, low).any()

"""Whitening against a dense eigendecomposition, exact sums, hard rows."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from assortment.llm import whitening
from assortment.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, n long, component string"


def dense(x):
    """Eigenvalues, falling, vectors and centred rows of integer rows."""
    centred = x - x.sum(0) / len(x)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return values[::-1], axes[:, ::-1], centred


def integers(vectors):
    return np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000


def held(found, ids, x, components):
    """Compare collected rows with the dense form, up to the sign of each component."""
    values, axes, centred = dense(x)
    want = centred @ axes[:, :components] / np.sqrt(values[:components])
    got = found.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < 1e-8
    share = found.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, values[:components] / values.sum(), rtol=1e-10)
    n, sums = len(x), [int(s) for s in x.sum(0)]
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    got = found[found["component"] == 1].set_index("vec_id")["deviation"].loc[ids]
    assert [int(v) for v in got] == exact
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


def test_query(spark):
    rows = pq.read_table(f"{DATA}/embeddings.parquet").to_pydict()
    found = QUERIES["op13_whitening"](spark, DATA).toPandas()
    assert list(found.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(found) == 32 * len(rows["vec_id"]) and set(found["n"]) == {len(rows["vec_id"])}
    held(found, rows["vec_id"], integers(rows["embedding"]), 32)


@pytest.mark.parametrize("partitions", [1, 9])
def test_wide_vectors_with_a_steep_spectrum(spark, partitions):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((400, 90)) * np.geomspace(4, 0.05, 90) + 2
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = whitening.whitened(df.repartition(partitions), components=12).toPandas()
    held(found, list(range(400)), integers(vectors), 12)


def test_filter_damps_the_lower_spectrum():
    values = np.r_[10.0, 8.0, np.linspace(5, 0, 20)]
    block = np.eye(22)[:, [0, 1, 2, 12]]
    product = lambda q: values[:, None] * q
    out = np.diag(whitening._filtered(product, block, product(block), 0.0, 5.0, 10.0)[[0, 1, 2, 12]])
    assert np.isclose(out[0], 1) and abs(out[1]) > 1e-3 and (np.abs(out[2:]) < 1e-5).all()


def test_a_start_without_the_first_direction_finds_it(monkeypatch):
    """The columns drawn anew bring in a direction that the start block has no part of."""
    d, values = 60, np.r_[9.0, np.linspace(5, 1, 59)]

    class Start:
        def __init__(self, seed):
            self.rng, self.first = np.random.Generator(np.random.PCG64(seed)), True

        def standard_normal(self, shape):
            out = self.rng.standard_normal(shape)
            if self.first:
                out[0], self.first = 0, False
            return out

    monkeypatch.setattr(whitening.np.random, "default_rng", Start)
    found, axes, residual = whitening._pairs(lambda q: values[:, None] * q, d, 4, values.sum())
    assert np.allclose(found, [9, 5, values[2], values[3]]) and residual < 1e-9


def test_hard_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [0.5, 0.25, -0.1]), (1, [0.5, 0.25, -0.1]), (2, None), (3, [0.1, None, 0.2]), (4, [nan, 0.0, 0.0]), (5, [0.0, inf, 0.0]),
        (6, [0.3]), (7, []), (None, [0.9, -0.4, 0.7]), (8, [-0.6, 0.1, 0.2]), (8, [0.6, 0.7, 0.2]),
    ]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], SCHEMA)
    found = whitening.whitened(df).toPandas()
    kept = [v + [0.0] * (3 - len(v)) for i, v in rows if v is not None and all(p is not None and np.isfinite(p) for p in v)]
    assert len(found) == 3 * len(kept) and set(found["n"]) == {len(kept)} and found["vec_id"].isna().sum() == 3
    x = integers(np.array(kept, np.float32))
    values, axes, centred = dense(x)
    want = np.abs(centred @ axes / np.sqrt(values))
    for c in range(3):
        assert np.allclose(sorted(found[found["component"] == c + 1]["whitened"].abs()), sorted(want[:, c]))
    for few in (df.where("false"), df.where("vec_id = 2"), df.where("vec_id = 1"), df.where("vec_id = 7"), df.where("vec_id = 6")):
        assert whitening.whitened(few).count() == 0


def test_fewer_vectors_than_parts(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((6, 40))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = whitening.whitened(df).toPandas()
    assert sorted(set(found["component"])) == [1, 2, 3, 4, 5]
    held(found, list(range(6)), integers(vectors), 5)


def test_deviations_beyond_64_bits():
    model = whitening.Whitening(3_000_000_000, [3_000_000_000 * 7 + 11, 5])
    x = np.array([[7_000_123, -4], [7, 0]], np.int64)
    got = whitening._deviations(model)(x).to_pylist()
    assert [int(v) for v in got] == [sum((int(a) * model.n - s) ** 2 for a, s in zip(row, model.sums)) for row in x]


def test_a_third_of_equal_rows(spark):
    rng = np.random.default_rng(6)
    vectors = np.r_[rng.standard_normal((200, 8)), np.repeat(rng.standard_normal((1, 8)), 100, 0)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    held(whitening.whitened(df).toPandas(), list(range(300)), integers(vectors), 8)

"""The quality model: held-out accuracy, tables by hand, hard rows."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from assortment.llm import quality_gam
from assortment.llm.queries import QUERIES

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.01"


def test_query_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_quality"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert len(got) == docs
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    labels = [r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in labels]
    good = [got[r["doc_id"]]["predicted"] for r in labels if r["quality"] == 1]
    assert np.mean(right) > 0.95 and np.mean(good) > 0.97


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(0)
    rows = rng.random((4000, len(quality_gam.FEATURES)))
    labels = ((rows[:, 2] > 0.5) ^ (rows[:, 7] > 0.5)).astype(float)
    model = quality_gam.train(rows[:3000], labels[:3000])
    assert (2, 7) in model.pairs
    assert np.mean((model.scores(rows[3000:]) > 0.5) == labels[3000:]) > 0.9


def test_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(1)
    rows = rng.random((500, len(quality_gam.FEATURES)))
    model = quality_gam.train(rows, (rows[:, 0] > 0.3).astype(float))
    row = rows[7]
    total = model.intercept
    for j, table in enumerate(model.tables):
        total += table[sum(e < row[j] for e in model.edges[j])]
    for (a, b), table in model.pairs.items():
        total += table[sum(e < row[a] for e in model.coarse[a]), sum(e < row[b] for e in model.coarse[b])]
    assert np.isclose(model.logits(rows)[7], total)


def test_held_out_labels_are_never_learned(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(string(doc_id) as binary)) % 4 = 2 then 1 - quality else quality end quality")
    a, b = (quality_gam.fit(docs, x) for x in (labels, turned))
    assert a.intercept == b.intercept and all((x == y).all() for x, y in zip(a.tables, b.tables))


def test_hard_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (5, 1), (8, None), (None, 1), (7, 0), (77, 1)], "doc_id long, quality int")
    model = quality_gam.fit(docs, labels)
    got = docs.select("doc_id", quality_gam.score(docs["text"], model).alias("s")).collect()
    assert len(got) == len(HARD_TEXTS) and all(0 <= r["s"] <= 1 for r in got)
    none = labels.where("false")
    assert {r["s"] for r in docs.select(quality_gam.score(docs["text"], quality_gam.fit(docs, none)).alias("s")).collect()} == {0.5}
    one_class = quality_gam.fit(docs, labels.where("quality = 1"))
    assert 0.5 < docs.select(quality_gam.score(docs["text"], one_class).alias("s")).first()["s"] < 1
    assert documents(spark, []).select(quality_gam.score(F.col("text"), model)).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    small = quality_gam.fit(docs, labels, max_rows=40)
    assert max(len(e) for e in small.edges) <= quality_gam.BINS


def test_empty_text_has_zeros():
    assert quality_gam.features_of(b"") == [0.0] * len(quality_gam.FEATURES)
    assert len(quality_gam.features_of("é |\n".encode())) == len(quality_gam.FEATURES)


def plain_features(text):
    """Second version of the numbers, from characters and words one by one."""
    body = text.encode()
    if not body:
        return [0.0] * 18
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", body) if w]
    blank = b" \t\n\r\v\f"
    lines = [x.strip(blank) for x in body.split(b"\n") if x.strip(blank)]
    share = lambda characters: sum(c in characters for c in body) / len(body)
    capitals = sum(65 <= c <= 90 for c in body)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c > 127 for c in body)
    each = max(1, len(words))
    return [
        math.log(1 + len(body)), math.log(1 + len(words)), sum(c not in blank for c in body) / each, len(set(words)) / each,
        max((words.count(w) for w in set(words)), default=0) / each, capitals / max(1, letters), share(b"0123456789"),
        share(b"#$%&*+<=>@\\^_~{}[]"), share(b"!?"), share(b"|"), share(b".,;:'\"()-"), sum(c > 127 for c in body) / len(body),
        share(blank), math.log(1 + len(words) / max(1, len(lines))), 1 - len(set(lines)) / len(lines) if lines else 0.0,
        sum(x[-1:] in (b".", b"!", b"?", b'"', b"'") for x in lines) / max(1, len(lines)),
        sum(w[-1:] in [bytes([c]) for c in b"#$%&*+<=>@\\^_~|!"] for w in words) / each, math.log(1 + max(map(len, words), default=0)),
    ]


def test_features_against_a_second_version(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in texts[:80] + [t or "" for _, t in HARD_TEXTS] + ["A!! b|\n\n  c? \x85 x\x0b", "|", "é", "\n \n"]:
        if len(text) < 8000:
            assert np.allclose(quality_gam.features_of(text.encode()), plain_features(text)), text[:60]


def test_first_round_against_a_second_version(monkeypatch):
    """One feature, one round: the best tree of three leaves grown greedily, cut by cut."""
    monkeypatch.setattr(quality_gam, "ROUNDS", 1)
    monkeypatch.setattr(quality_gam, "PAIR_ROUNDS", 0)
    rng = np.random.default_rng(8)
    x = rng.random((300, 1))
    y = (rng.random(300) < np.where(x[:, 0] < 0.3, 0.9, np.where(x[:, 0] < 0.7, 0.2, 0.6))).astype(float)
    model = quality_gam.train(x, y)
    start = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    p = 1 / (1 + math.exp(-start))
    bins = [sum(e < v for e in model.edges[0]) for v in x[:, 0]]
    size = len(model.edges[0]) + 1
    g = [sum(yi - p for b, yi in zip(bins, y) if b == i) for i in range(size)]
    h = [sum(p * (1 - p) for b in bins if b == i) for i in range(size)]
    worth = lambda a, b: sum(g[a:b]) ** 2 / (sum(h[a:b]) + 1)
    parts = [(0, size)]
    for _ in range(2):
        gain, (a, b), at = max((worth(a, c) + worth(c, b) - worth(a, b), (a, b), c) for a, b in parts for c in range(a + 1, b))
        parts.remove((a, b))
        parts += [(a, at), (at, b)]
    want = np.zeros(size)
    for a, b in parts:
        want[a:b] = 0.2 * sum(g[a:b]) / (sum(h[a:b]) + 1)
    assert model.intercept == start and np.allclose(model.tables[0], want)


def test_a_key_with_several_texts_gives_one_model(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i) % 30, " ".join(map(str, rng.integers(0, 99, int(rng.integers(5, 60)))))) for i in range(240)] + [(3, None), (4, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    one, other = (quality_gam.fit(documents(spark, rows).repartition(n), labels) for n in (1, 9))
    assert one.intercept == other.intercept and all(np.array_equal(a, b) for a, b in zip(one.tables, other.tables))
    assert one.pairs.keys() == other.pairs.keys()

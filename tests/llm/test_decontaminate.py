"""Decontamination against comparing every span."""

import hashlib
import random

import numpy as np

from assortment.llm import decontaminate
from assortment.llm.queries import QUERIES

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.001"


def plain(text, items, window=13):
    """(n_words, n_hit, item ids) by comparing every span."""
    tokens, hit, ids = decontaminate.words_of((text or "").encode()), set(), set()
    for item, own in items:
        theirs = decontaminate.words_of((own or "").encode())
        size = min(window, len(theirs))
        spans = {tuple(theirs[i: i + size]) for i in range(len(theirs) - size + 1)} if size else set()
        for at in range(len(tokens) - size + 1 if size else 0):
            if tuple(tokens[at: at + size]) in spans:
                hit.update(range(at, at + size))
                ids.add(item)
    return len(tokens), len(hit), sorted(ids)


def test_random_texts_with_short_items(spark):
    rng = random.Random(3)
    draw = lambda n: [rng.choice(["a", "b", "C", "é", "9x"]) for _ in range(n)]
    items = [(i, " ".join(draw(rng.choice([0, 1, 4, 7, 13, 14, 30])))) for i in range(20)] + [(90, None), (91, "!?"), (92, "solo")]
    docs = []
    for i in range(60):
        words = draw(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            own = rng.choice(items)[1]
            at = rng.randint(0, len(words))
            words[at:at] = (own or "").split()
        docs.append((i, ", ".join(words)))
    docs += HARD_TEXTS
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, docs), frame).collect()
    expected = sorted(((k, *plain(t, items)) for k, t in docs), key=repr)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got), key=repr) == expected
    assert all(r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"]) for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(documents(spark), none).collect()} == {0}
    assert decontaminate.contamination(documents(spark, []), none).count() == 0


def test_query_against_brute_force(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for key, text in docs:
        n, hit, ids = plain(text, items)
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        expected.add((key, n, hit, len(ids), digest, hit > 0 and 20 * hit >= n))
    assert {tuple(r) for r in QUERIES["op9_decontamination"](spark, DATA).collect()} == expected


def test_every_shared_span_shows_a_fingerprint():
    rng = np.random.default_rng(5)
    for _ in range(50):
        shared = rng.integers(0, 4, 13).astype(np.uint64)
        left, right = (np.r_[rng.integers(0, 4, 20), shared, rng.integers(0, 4, 9)].astype(np.uint64) for _ in range(2))
        prints = [set(g[decontaminate.winnowed(g, 9)].tolist()) for g in (decontaminate.gram_hashes(x, 5) for x in (left, right))]
        inside = decontaminate.gram_hashes(shared, 5).min()
        assert inside in prints[0] and inside in prints[1]


def test_word_hashes_do_not_depend_on_pieces():
    text = ("Some wörds, AND ünïcode; " * 500 + "z" * 3000).encode()
    whole = decontaminate.word_hashes(text)
    assert (whole == decontaminate.word_hashes(text, 64)).all()
    assert len(whole) == len(decontaminate.words_of(text))

"""SimHash near duplicates against plain hashing and all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from assortment.llm import simhash
from assortment.llm.queries import QUERIES

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints, radius):
    """Smallest key reachable, by all pairs."""
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    found = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            found[top(i)] = min(key, found.get(top(i), key))
    return [found.get(top(i)) for i in range(len(prints))]


def test_whole_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs]
    expected = {(k, f"{p:016x}", c) for (k, p), c in zip(prints, plain_components(prints, 2))}
    assert {tuple(r) for r in QUERIES["op4_simhash"](spark, DATA).collect()} == expected


def test_hard_rows(spark):
    got = simhash.near_duplicates(documents(spark)).collect()
    prints = [(k, plain_fingerprint(t)) for k, t in HARD_TEXTS]
    expected = sorted(((k, p, c) for (k, p), c in zip(prints, plain_components(prints, 2))), key=repr)
    assert sorted(((r["doc_id"], r["fingerprint"] % 2**64, r["component"]) for r in got), key=repr) == expected
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_long_texts_in_pieces():
    words = [random.Random(1).choice("abcdefgh") * (i % 5 + 1) for i in range(700_000)]
    text = " ".join(words).encode()
    whole = np.zeros(64, np.int64)
    hashes = simhash._shingle_hashes(words=[w.encode() for w in words], shingle=3)
    whole += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    assert len(text) > 2 * (1 << 20)
    assert simhash.simhash(text) == sum(1 << b for b in range(64) if 2 * whole[b] > len(hashes))


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_forest_joins_what_all_pairs_join(radius):
    rng = random.Random(radius)
    values, runs = [], []
    for run, size in enumerate([1, 2, 3, 70, 300, 1, 129]):
        base = rng.getrandbits(64)
        for _ in range(size):
            value = base
            for _ in range(rng.randint(0, 6)):
                value ^= 1 << rng.randrange(64)
            values.append(value)
            runs.append(run)
    a, b = simhash.forest(np.array(runs), np.array(values, np.uint64), list(range(64)), radius)
    for run in set(runs):
        own = sorted({v for v, r in zip(values, runs) if r == run})
        parent = {v: v for v in own}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            assert (x ^ y).bit_count() <= radius
            if x in parent and y in parent:
                parent[max(top(x), top(y))] = min(top(x), top(y))
        assert [top(v) for v in own] == plain_components([(v, v) for v in own], radius)


@pytest.mark.parametrize("radius,blocks", [(2, 4), (2, 6), (3, 5), (0, 1)])
def test_links_reach_all(spark, radius, blocks):
    rng = random.Random(7)
    values = set()
    for _ in range(120):
        value = rng.getrandbits(64)
        for _ in range(6):
            values.add(value)
            value ^= 1 << rng.randrange(64)
            value ^= 1 << rng.randrange(64)
    values = sorted(values)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    found = simhash.links(frame, radius, blocks).collect()
    parent = {v: v for v in values}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        x, y = top(r["a"] % 2**64), top(r["b"] % 2**64)
        parent[max(x, y)] = min(x, y)
    assert [top(v) for v in values] == plain_components([(v, v) for v in values], radius)

"""Packing against a plain search over all open bins, and its invariants."""

import random

import numpy as np

from assortment.llm import packing
from assortment.llm.queries import QUERIES

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.01"


def plain_pack(sizes, lengths):
    bins = []
    for i, size in enumerate(sizes):
        fitting = [b for b in bins if b["length"] - b["used"] >= size]
        if fitting:
            best = min(fitting, key=lambda b: b["length"] - b["used"])
            same = [b for b in fitting if b["length"] - b["used"] == best["length"] - best["used"]]
            chosen = max(same, key=lambda b: b["touched"])
        else:
            later, options = sizes[i + 1:], []
            for length in lengths:
                if length >= size:
                    fill = size
                    for other in sorted(s for s in later if s <= length - size):
                        fill += other
                    content = min(length, fill)
                    options.append((packing.cost(length) / content, length))
            chosen = {"length": min(options)[1], "used": 0, "items": []}
            bins.append(chosen)
        chosen["items"].append((i, chosen["used"]))
        chosen["used"] += size
        chosen["touched"] = i
    return bins


def test_pack_against_plain_search():
    rng = random.Random(1)
    for _ in range(60):
        lengths = tuple(sorted(rng.sample(range(20, 400), 3)))
        sizes = sorted((rng.randint(1, lengths[-1]) for _ in range(rng.randint(1, 80))), reverse=True)
        bins, offsets, finals = packing.pack(np.array(sizes), lengths)
        expected = plain_pack(sizes, lengths)
        assert len(finals) == len(expected)
        for number, own in enumerate(expected):
            assert [(i, int(offsets[i])) for i in range(len(sizes)) if bins[i] == number] == own["items"]
            assert finals[number] == min(x for x in lengths if x >= own["used"])


def check(rows, docs, lengths=packing.LENGTHS):
    """Every byte and end mark of every text once; bins not overfull, as short as they can be, without overlap."""
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["begin"], r["size"]))
        bins.setdefault(r["bin"], []).append((r["bin_offset"], r["size"], r["bin_length"]))
    sizes = {}
    for key, text in docs:
        sizes.setdefault(key, []).append(len((text or "").encode()) + 1)
    assert {k: sum(s for _, s in v) for k, v in pieces.items()} == {k: sum(v) for k, v in sizes.items()}
    for own in bins.values():
        at = 0
        for offset, size, _ in sorted(own):
            assert offset == at
            at += size
        assert {length for _, _, length in own} == {min(x for x in lengths if x >= at)}
    return sum(own[0][2] for own in bins.values()), sum(r["size"] for r in rows)


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    room, used = check(QUERIES["op8_packing"](spark, DATA).collect(), docs)
    assert used / room > 0.97


def test_hard_rows(spark):
    rows = packing.packed(documents(spark)).collect()
    check(rows, HARD_TEXTS)
    check(packing.packed(documents(spark), lengths=(64, 8), group=3).collect(), HARD_TEXTS, (8, 64))
    assert packing.packed(documents(spark, [])).count() == 0


def test_same_result_for_any_partitions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    hot = docs.limit(300).select(docs["doc_id"], docs["text"]).unionByName(spark.range(400).selectExpr("cast(null as long) doc_id", "'same' text"))
    for rows, group in ((docs, packing.GROUP), (docs, 100), (hot, 50)):
        rows = spark.createDataFrame(rows.select("doc_id", "text").collect(), "doc_id long, text string")
        a, b = (sorted(map(repr, packing.packed(rows.repartition(n), group=group).collect())) for n in (1, 7))
        assert a == b and len(a) >= rows.count()


def test_copies_are_written_out_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "COPIES", 7)
    docs = documents(spark, [(1, "a")] * 50 + [(2, "b")] + [(None, None)] * 7 + [(3, "c")] * 8)
    found = packing.numbered(packing.pieces(docs)).groupBy("key").agg({"number": "collect_set"}).collect()
    assert {r["key"]: sorted(r[1]) for r in found} == {1: list(range(50)), 2: [0], None: list(range(7)), 3: list(range(8))}


def test_equal_rows_are_dealt_over_groups(spark):
    docs = [(None, "")] * 600 + [(7, "the same text")] * 600 + [(i, f"text {i}") for i in range(600)]
    rows = packing.packed(documents(spark, docs), group=100).collect()
    check(rows, docs)
    sizes = {}
    for r in rows:
        sizes[r["bin"] >> 32] = sizes.get(r["bin"] >> 32, 0) + 1
    assert len(sizes) == 18 and max(sizes.values()) < 200

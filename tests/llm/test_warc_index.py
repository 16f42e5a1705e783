"""Archives and index: round trips, and lookups against a scan."""

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assortment.llm import warc_index
from assortment.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
KIND = "page_id long, url string, html string, page long, digest string"


def expected(pages):
    first, out = {}, []
    body = lambda html: (html or "").encode()
    for key, _, html in pages:
        if len(body(html)) >= 100 and key is not None:
            first[body(html)] = min(key, first.get(body(html), key))
    for key, _, html in pages:
        whose = first.get(body(html))
        other = whose is not None and whose != key
        out.append((key, len(body(html)), hashlib.sha256(body(html)).hexdigest(), "revisit" if other else "response", whose if other else None))
    return sorted(out, key=repr)


def all_of(archive, pages):
    keys = pages.select(warc_index.url_key(F.col("url")).alias("url_key"))
    return [r for r in archive.find(keys).collect()]


def test_query(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in QUERIES["op2_warc"](spark, DATA).collect()), key=repr) == expected(pages)


HARD = [
    (1, None, None), (2, "no scheme\n", ""), (3, "http://A.b/x y\r\nWARC-Type: x", "é" * 60), (4, "http://a.b/é", "é" * 60),
    (4, "http://a.b/é", "é" * 60), (None, "http://a.b/q?x#y", "é" * 60), (9, "https://a.b/q?x#z", "x" * 99), (8, "http://a.b", "x" * 99),
    (5, "http://a.b/\r\n\r\n", "\r\n\r\nWARC/1.1\r\n" * 9000), (None, "http://n.n/", "only null pages " * 9),
]


def test_hard_rows(spark, tmp_path):
    pages = spark.createDataFrame([(*r, 1, "x") for r in HARD], KIND).repartition(3)
    archive = warc_index.archived(pages, str(tmp_path / "w"))
    got = all_of(archive, pages)
    rows = sorted(((r["page"], r["payload_bytes"], r["digest"], r["kind"], r["refers_to"]) for r in got), key=repr)
    assert rows == expected(HARD)
    bodies = {r["page"]: r["payload"] for r in got if r["kind"] == "response"}
    assert bodies[5].decode() == HARD[8][2] and bodies[1] == b""
    records = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "w").glob("*.warc.gz"))
    assert records.count(b"WARC/1.1\r\nWARC-Type: ") == len(HARD)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], KIND)
    assert all_of(warc_index.archived(pages, str(tmp_path / "w")), pages) == []


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_lookup_against_scan(spark, tmp_path, lines):
    rows = [(i, f"http://h{i % 7}.org/{i % 50}" if i % 3 else "http://hot.org/", f"text {i} " * 20, 0, "") for i in range(600)]
    pages = spark.createDataFrame(rows, KIND).repartition(4)
    folder = str(tmp_path / "w")
    captures = warc_index.write_archives(pages, folder)
    ranges = warc_index.write_index(captures, folder, lines)
    assert sum(r["captures"] for r in ranges.collect()) == 600
    asked = spark.createDataFrame([("org,hot)/",), ("org,h1)/1",), ("org,h1)/1",), ("org,h2)/none",), ("",), (None,), ("zzz",)], "url_key string")
    found = warc_index.lookup(asked, ranges, folder)
    expected_pages = sorted(r[0] for r in rows if r[1] in ("http://hot.org/", "http://h1.org/1"))
    assert sorted(r["page"] for r in found.collect()) == expected_pages
    payloads = {r["page"]: r["payload"].decode() for r in warc_index.fetch(found, folder).collect()}
    assert payloads == {r[0]: r[2] for r in rows if r[0] in set(expected_pages)}


def test_damage_is_seen():
    member = warc_index.record_bytes(1, "u", b"abc", "0" * 64, None)
    with pytest.raises(ValueError, match="page 1"):
        warc_index.parsed(member)


def test_reading_tasks_follow_the_archive_bytes(spark, monkeypatch):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    archive = warc_index.archived(pages)
    captures = warc_index.lookup(pages.select(warc_index.url_key(F.col("url")).alias("url_key")), archive.ranges, archive.folder)
    total = captures.agg(F.sum("size")).first()[0]
    monkeypatch.setattr(warc_index, "TASK_BYTES", 1000)
    monkeypatch.setattr(warc_index, "NEAR_BYTES", 500)
    read = warc_index.fetch(captures, archive.folder).withColumn("task", F.spark_partition_id())
    sizes = [r["n"] for r in read.groupBy("task").agg(F.count("*").alias("n")).collect()]
    assert total > 20_000 and len(sizes) > 20 and max(sizes) < sum(sizes) / 4


def test_payloads_do_not_cross_a_shuffle(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    plan = warc_index.with_types(pages, "page_id", "url", "html")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan

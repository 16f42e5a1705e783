"""Shards against ranking in plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from assortment.llm import shards
from assortment.llm.queries import QUERIES
from assortment.sources.lineage import cut

from .helpers import documents

DATA = "/root/testdata/sf0.001"


def plain(rows, count, seed=shards.SEED):
    """rows of (key, text, source) to {(key, size, crc, shard, slot)}."""
    own = []
    for key, text, source in rows:
        body = (text or "").encode()
        mixed = hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
        own.append(("" if source is None else "=" + source, mixed, key if key is not None else -(2**63), zlib.crc32(body), len(body) + 16, key))
    by_source = defaultdict(list)
    for row in sorted(own, key=lambda r: r[:5]):
        by_source[row[0]].append(row)
    line = [((2 * i + 1) / (2 * len(g)), *row) for g in by_source.values() for i, row in enumerate(g)]
    out, slots = [], Counter()
    for place, row in enumerate(sorted(line, key=lambda r: r[:6])):
        shard = place * count // len(line)
        out.append((row[6], row[5], row[4], shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=repr)


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = [tuple(r) for r in QUERIES["op6_shards"](spark, DATA).select("doc_id", "size", "text_crc32", "shard", "slot").collect()]
    assert sorted(got, key=repr) == plain(rows, 40)


def test_hot_source_matches_the_mixture_in_every_shard(spark):
    docs = spark.range(10_000).selectExpr(
        "id doc_id", "string(id) text", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else 's' || (id % 5) end source",
        "id shard", "id place", "id slot",
    )
    got = shards.sharded(docs, shards=13).toPandas()
    sizes = got.groupby("shard").size()
    assert len(sizes) == 13 and sizes.max() - sizes.min() <= 1
    mix = got.assign(source=got["source"].fillna("-")).groupby(["source", "shard"]).size().unstack()
    assert (mix.max(axis=1) - mix.min(axis=1) <= 2).all()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


def test_hard_rows(spark):
    rows = [(None, None, None), (None, None, None), (1, "", "a"), (1, "", "a"), (1, "é", "a"), (2, "x", "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = shards.sharded(frame, shards=4).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain(rows, 4)
    assert shards.sharded(documents(spark, [])).count() == 0


def test_equal_rows_spread_over_tasks(spark, monkeypatch):
    """A third of all rows equal in everything: no range partition holds much more than the others."""
    sizes = []

    def counted(df):
        out = cut(df)
        if "_at" in df.columns:
            sizes.append([r["n"] for r in out.groupBy(F.shiftright("_at", 33)).agg(F.count("*").alias("n")).collect()])
        return out

    monkeypatch.setattr(shards, "cut", counted)
    docs = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then null else id end doc_id", "case when id % 3 = 0 then 'same' else string(id) end text", "'s' source"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = shards.sharded(docs, shards=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got.groupBy("shard").count().select("count").distinct().count() == 1
    assert len(sizes) == 2
    for own in sizes:
        assert max(own) < 2 * sum(own) / len(own) and len(own) >= 4

"""Sharding by proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash and ranked; the rank as a fraction of the source's rows
is a position on one line on which all sources are spread evenly. The line is cut into shards of equal counts,
so each shard holds every source in proportion, give or take a row. Ranks come from range partitions and their
counts: no window and no task holds a source or the table, however hot a source is. The figures of the sources,
one row each, are counted and go to the tasks up to BROADCAST_SOURCES of them; more are joined by a shuffle.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assortment.sources.lineage import cut

SHARDS = 40
SEED = 17
BROADCAST_SOURCES = 100_000
_INSIDE = (1 << 33) - 1


def positions(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add the 0-based position of each row in `order`; rows equal in `order` in any order.

    Rows are range partitioned and sorted; a row's number inside its written partition and the counts of the
    partitions before make the position. There is one count per partition, which is broadcast.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("_at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(F.col("_part").alias("_own"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = dealt.join(F.broadcast(starts), F.col("_part") == F.col("_own"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit(_INSIDE))
    return placed.withColumn(name, place).drop("_at", "_part", "_own", "_start")


def sharded(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """(key, size, text_crc32, source, shard, slot): slots are gapless from 0 in every shard, counts of shards
    differ by one row at most and, for each source, by little more.

    `size` is the UTF-8 bytes of the text plus 16; a null text counts as empty. A null source is a source of its
    own, rows with a null key are kept. Equal rows take neighbouring places, which of them takes which does not
    show. An empty table gives no rows. Other columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    stratum = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    shuffle = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    own = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("print"), F.col(source).alias("source"),
        stratum.alias("stratum"), shuffle.alias("shuffle"),
    )
    # The number lets the range partitions split rows that are equal in all else.
    own = cut(own.withColumn("number", F.monotonically_increasing_id()))
    ties = ["shuffle", "key", "print", "size", "number"]
    total = own.count()
    ranked = positions(own, ["stratum", *ties], "place")
    strata = cut(ranked.groupBy("stratum").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows")))
    if strata.count() <= BROADCAST_SOURCES:
        strata = F.broadcast(strata)
    rank = (F.col("place") - F.col("first")).cast("double")
    line = ranked.join(strata, "stratum").select(
        "key", "size", "print", "source", "stratum", "shuffle", "number", ((2 * rank + 1) / (2 * F.col("rows"))).alias("fraction")
    )
    placed = positions(cut(line), ["fraction", "stratum", *ties], "place")
    shard = F.expr(f"(place * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("key").alias(key), "size", F.col("print").alias("text_crc32"), F.col("source").alias(source),
        F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"),
    )

"""Best-fit packing into sequences of several permitted lengths.

Texts are cut into pieces no longer than the largest permitted length. Pieces are dealt by hash into groups of
bounded expected size and each group is packed on its own, longest piece first: a piece goes where it leaves the
least space; where it fits nowhere, the permitted length with the least cost per filled slot is opened, judged by
what is left to fill it. At the end each bin is downsized to the least permitted length that holds its contents.
"""

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assortment.sources.lineage import cut

LENGTHS = (2048, 4096, 8192, 16384, 32768)
COPIES = 1 << 16
START_COST = 64
EVEN_AT = 65536
GROUP = 8192


def cost(length: int) -> int:
    """Work of a sequence: a fixed start, a part in proportion to its length and, for attention, one to its square."""
    return (START_COST + length) * EVEN_AT + length * length


def pack(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the final length of each bin. `sizes` is sorted downwards."""
    lengths = tuple(sorted(lengths))
    upward = np.asarray(sizes)[::-1]
    total = np.r_[0, np.cumsum(upward)]
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    used: list[int] = []
    spaces: list[int] = []
    by_space: dict[int, list[int]] = defaultdict(list)
    for i, size in enumerate(np.asarray(sizes).tolist()):
        at = bisect_left(spaces, size)
        if at < len(spaces):
            space = spaces.pop(at)
            chosen = by_space[space].pop()
        else:
            later = len(sizes) - 1 - i
            space = _opened(size, later, upward, total, lengths)
            chosen = len(used)
            used.append(0)
        bins[i], offsets[i] = chosen, used[chosen]
        used[chosen] += size
        if space > size:
            insort(spaces, space - size)
            by_space[space - size].append(chosen)
    return bins, offsets, [lengths[bisect_left(lengths, content)] for content in used]


def _opened(size: int, later: int, upward: np.ndarray, total: np.ndarray, lengths: tuple[int, ...]) -> int:
    """The permitted length with the least cost per slot that this piece and the `later` ones can fill."""
    best, price, filled = 0, 0, 0
    for length in lengths[bisect_left(lengths, size):]:
        fitting = min(later, int(np.searchsorted(upward, length - size, side="right")))
        content = min(length, size + int(total[fitting]))
        if not best or cost(length) * filled < price * content:
            best, price, filled = length, cost(length), content
    return best


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: int = LENGTHS[-1]) -> DataFrame:
    """(key, print, piece, begin, size): UTF-8 bytes [begin, begin + size) of each text and its end mark."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    own = docs.select(F.col(key).alias("key"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("print"), size.alias("all"))
    count = F.ceil(F.col("all") / largest)
    many = own.select("key", "print", "all", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("piece"))
    begin = F.col("piece") * largest
    return many.select("key", "print", "piece", begin.alias("begin"), F.least(F.col("all") - begin, F.lit(largest)).alias("size"))


def numbered(all_pieces: DataFrame) -> DataFrame:
    """Add `number`, which counts the pieces that are equal in all columns from 0.

    Equal pieces are counted and written out again, COPIES of them in a task at most, so neither the numbers nor
    the work hang on how the rows were dealt.
    """
    own = all_pieces.columns
    counted = all_pieces.groupBy(*own).agg(F.count(F.lit(1)).alias("copies"))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("first")
    parts = counted.select(*own, "copies", first).repartition(*own, "first")
    last = F.least(F.col("copies"), F.col("first") + COPIES) - 1
    return parts.select(*own, F.explode(F.sequence("first", last)).alias("number"))


def packed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lengths: tuple[int, ...] = LENGTHS, group: int = GROUP,
) -> DataFrame:
    """(key, piece, begin, size, bin, bin_length, bin_offset): where each piece of each text goes.

    A token is a byte of the text's UTF-8 form or its end mark, so a null or empty text is one token. Every
    row is packed, repeated ones too, and rows with a null key; ties go by key, text checksum and piece. An empty
    table gives no rows. Other columns are ignored. Very long texts are cut into pieces of the largest length; their
    bytes are not read. `group` is the expected number of pieces in a group: pieces are dealt by what they are and by a
    number among those equal to them, so equal pieces spread over groups, and the bins are the same for any partitions.
    """
    all_pieces = cut(numbered(pieces(docs, key, text, max(lengths))))
    groups = max(1, -(-all_pieces.count() // group))
    own = F.pmod(F.xxhash64("key", "print", "piece", "size", "number"), F.lit(groups))

    def fill(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by([("size", "descending"), ("key", "ascending"), ("print", "ascending"), ("piece", "ascending")])
        bins, offsets, finals = pack(batch["size"].to_numpy(), lengths)
        number = batch["group"].to_numpy() * (1 << 32) + bins
        return pa.table({
            "key": batch["key"], "piece": batch["piece"], "begin": batch["begin"], "size": batch["size"],
            "bin": number, "bin_length": np.array(finals, np.int64)[bins], "bin_offset": offsets,
        })

    kind = docs.select(key).schema[0].dataType.simpleString()
    out = all_pieces.withColumn("group", own).groupBy("group").applyInArrow(
        fill, f"key {kind}, piece long, begin long, size long, bin long, bin_length long, bin_offset long"
    )
    return out.withColumnRenamed("key", key)

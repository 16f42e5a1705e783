"""SimHash near duplicates by bit-sliced comparison.

Distinct fingerprints are dealt into buckets that agree on some of their bit blocks: with m blocks and
radius r, two fingerprints within r bits agree on at least m - r blocks, so every such pair meets in one
of the C(m, m - r) tables. A bucket is compared vertically: one plane per bit, one lane per fingerprint.
The lanes are shifted against themselves, plane after plane is added to carry-save counters for all
lanes at once, and a shift is abandoned as soon as every lane has exceeded the radius. Only the links that
join two parts of a bucket leave the task, so a dense group sends fewer links than it has members; what is
reachable stays the same. No bucket is capped.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.llm.texts import rows_of, word_pieces
from assortment.operators.components import connected_components
from assortment.sources.lineage import cut

SHINGLE = 3
RADIUS = 2
BLOCKS = 4
SEED = 42
_PLANES_PER_LOOK = 4


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits; bit i is set if it is set in over half of the shingle hashes, 0 for a text without words."""
    counts, total, held = np.zeros(64, np.int64), 0, []
    for words in word_pieces(text.lower()):
        words = held + words
        if len(words) >= shingle:
            hashes = _shingle_hashes(words, shingle)
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64
            )
            total += len(hashes)
        held = words[-(shingle - 1):] if shingle > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(held), SEED) if held else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.dtype("<u8"), len(starts)
    )


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text as a long; null counts as an empty text."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        found = np.fromiter((simhash(t or b"", shingle) for t in rows_of(texts)), np.uint64, len(texts))
        return pa.array(found.view(np.int64))

    return of(text)


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _block_masks(blocks: int, radius: int) -> list[int]:
    """One mask per table: the bits of the blocks that its buckets agree on."""
    if not radius < blocks <= 64:
        raise ValueError("blocks must be over the radius and at most 64")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words): plane b holds bit b of every lane."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return _packed(bits)


def _packed(bits: np.ndarray) -> np.ndarray:
    lanes = np.packbits(bits, axis=-1, bitorder="little")
    short = -lanes.shape[-1] % 8
    lanes = np.pad(lanes, [(0, 0)] * (lanes.ndim - 1) + [(0, short)])
    return np.ascontiguousarray(lanes).view("<u8")


def _shifted(plane: np.ndarray, by: int) -> np.ndarray:
    """Lane i of the result is lane i + `by` of the plane."""
    words, bits = divmod(by, 64)
    out = plane[words:]
    if bits:
        out = out >> np.uint64(bits)
        out[:-1] |= plane[words + 1:] << np.uint64(64 - bits)
    return out


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    over, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal = equal & counters[j]
        else:
            over = over | (equal & counters[j])
            equal = equal & ~counters[j]
    return over


def close_lanes(planes: np.ndarray, valid: np.ndarray, by: int, order: list[int], radius: int) -> np.ndarray:
    """Lanes i, as a packed mask, whose distance to lane i + `by` is at most `radius`.

    `valid` masks the lanes that count; `order` lists the planes that may differ.
    """
    width = len(valid)
    counters = [np.zeros(width, np.uint64) for _ in range((radius + 1).bit_length())]
    over = ~valid
    for at, b in enumerate(order, 1):
        add = planes[b][:width] ^ _shifted(planes[b], by)
        for j, counter in enumerate(counters):
            counters[j], add = counter ^ add, counter & add
        over = over | add
        if at % _PLANES_PER_LOOK == 0 or at == len(order):
            over = over | _exceeds(counters, radius)
            if not (~over).any():
                return np.zeros(width, np.uint64)
    return ~over


def forest(runs: np.ndarray, values: np.ndarray, order: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within `radius` inside each run of equal `runs`, as many as join all that is reachable there."""
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    sizes = np.diff(np.r_[starts, len(runs)])
    by_size = np.argsort(-sizes, kind="stable")  # long runs first: those that are done fall off the end
    lanes = np.concatenate([np.arange(starts[r], starts[r] + sizes[r]) for r in by_size]) if len(runs) else starts
    left = np.repeat(sizes[by_size], sizes[by_size])
    root, links = np.arange(len(values)), []
    by, packed_for, planes = 1, 0, None
    while True:
        alive = int(np.searchsorted(-left, -by, side="left"))  # lanes in runs of more than `by`
        if alive <= by:
            break
        if planes is None or alive <= packed_for // 2:
            lanes, left, packed_for = lanes[:alive], left[:alive], alive
            planes, own = _planes(values[lanes]), runs[lanes]
        width = len(planes[0]) - by // 64
        same = np.zeros(width * 64, np.uint8)
        same[: len(own) - by] = own[:-by] == own[by:]
        close = close_lanes(planes, _packed(same), by, order, radius)
        if close.any():
            at = np.flatnonzero(np.unpackbits(close.view(np.uint8), bitorder="little"))
            links += _joined(root, lanes[at], lanes[at + by])
        by += 1
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return values[pairs[:, 0]], values[pairs[:, 1]]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Unite the ends of links; those links that joined two parts."""
    kept = []
    apart = root[a] != root[b]
    for x, y in zip(a[apart].tolist(), b[apart].tolist()):
        p, q = int(root[x]), int(root[y])
        while root[p] != p:
            p = int(root[p])
        while root[q] != q:
            q = int(root[q])
        if p != q:
            root[max(p, q)] = min(p, q)
            kept.append((x, y))
    if kept:
        while not np.array_equal(up := root[root], root):
            root[:] = up
    return kept


def links(fingerprints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(a, b): links between distinct fingerprints at most `radius` bits apart, enough to reach all that is
    reachable. `fingerprints` has one distinct long column `fingerprint`."""
    masks = _block_masks(blocks, radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    orders = [[b for b in range(64) if not m >> b & 1] for m in masks]
    dealt = fingerprints.select(F.posexplode(F.array(*map(F.lit, signed))).alias("table", "mask"), "fingerprint")
    dealt = dealt.select("table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"), "fingerprint")
    dealt = dealt.repartition("table", "key").sortWithinPartitions("table", "key", "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, key, value in _whole_buckets(batches):
            alike = np.r_[False, (key[1:] == key[:-1]) & (table[1:] == table[:-1])]
            inside = alike | np.r_[alike[1:], False]
            run = np.cumsum(~alike)[inside]
            table, value = table[inside], value[inside]
            for t in np.unique(table):
                rows = table == t
                a, b = forest(run[rows], value[rows], orders[t], radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(compare, "a long, b long")


def _whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sorted (table, key, fingerprint) columns; no bucket is spread over two results."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
        last = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
        split = int(last[-1]) + 1 if len(last) else 0
        if split or held and (held[-1][0][-1], held[-1][1][-1]) != (part[0][-1], part[1][-1]):
            yield tuple(np.concatenate(c) for c in zip(*held, [c[:split] for c in part]))
            held = []
        held.append([c[split:] for c in part])
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS,
) -> DataFrame:
    """(key, fingerprint long, component): component = the smallest key reachable over links of at most
    `radius` differing bits.

    One row per input row, repeated rows included. Null and empty texts have fingerprint zero and are linked
    like any other. A null key is never a component's smallest unless no other key is reachable (then the
    component is null). An empty table gives no rows. Other columns are ignored whatever their names.
    """
    marked = cut(docs.select(F.col(key).alias("key"), fingerprint(F.col(text), shingle).alias("fingerprint")))
    firsts = cut(marked.groupBy("fingerprint").agg(F.min("key").alias("first")))
    found = cut(links(firsts.select("fingerprint"), radius, blocks))
    nodes = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    reached = connected_components(nodes, found)
    linked = firsts.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    linked = linked.withColumn("root", F.coalesce("component", "fingerprint")).drop("component")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component"))
    named = linked.join(smallest, "root").select(F.col("fingerprint").alias("own"), "component")
    return marked.join(named, F.col("fingerprint") == F.col("own")).select(
        F.col("key").alias(key), "fingerprint", "component"
    )

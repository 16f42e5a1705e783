"""Benchmark decontamination by winnowing.

Words are hashed by numpy over whole batches, k-grams by prefix sums over the word hashes. From each sliding
window of w k-grams the smallest hash is kept as a fingerprint, so two texts that share k + w - 1 words in a
row share a fingerprint from inside them. The benchmark's fingerprints go to the tasks as a bit table of fixed
size, whatever the benchmark's size; a document's fingerprint that is set there is a hit. A hit is extended to
the spans of the full window length around it that a second bit table lets pass, and neighbouring spans become
one run of words. Distinct runs, as text, are cut into windows and joined with the benchmark's windows, so
that the result is exact whatever the hashes did, and a passage in very many documents is looked up once.

Benchmark items shorter than the window are windows of their own length; for each such length, documents look
up all their spans of that length in the same way. The tables have 2^24 bits each, good for about a million
benchmark windows; more windows want more bits, which changes the cost and never the result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assortment.llm.texts import let, rows_of
from assortment.sources.lineage import cut

WINDOW = 13
GRAM = 5
SHARE = 20
BITS = 24
PIECE = 1 << 20

_FOLD = np.zeros(256, np.uint8)
for _c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _FOLD[_c] = _c
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_TABLE = bytes(v or 0x20 for v in _FOLD)

_SEEDS = np.random.default_rng(1).integers(1, 1 << 63, 258, dtype=np.uint64) | np.uint64(1)
_MIX, _BYTE_BASE, _WORD_BASE = np.r_[np.uint64(0), _SEEDS[1:256]], _SEEDS[256], _SEEDS[257]
_INVERSE = np.uint64(pow(int(_WORD_BASE), -1, 1 << 64))


def words_of(text: bytes) -> list[bytes]:
    """A-Z lowered; words are runs of digits, letters and bytes over 0x7F."""
    return text.translate(_TABLE).split()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: bytes, piece: int = PIECE) -> np.ndarray:
    """A 64-bit hash per word of `text`, in order."""
    found, at = [], 0
    while at < len(text):
        end = min(at + piece, len(text))
        while end < len(text) and _FOLD[text[end]]:
            end += 1
        found.append(_piece_hashes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    folded = _FOLD[raw]
    inside = folded != 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.r_[0, edges]
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = ends if len(ends) == len(starts) else np.r_[ends, len(raw)]
    own = np.flatnonzero(inside)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(own)) - np.repeat(first, lengths)
    parts = _MIX[folded[own]] * _powers(_BYTE_BASE, int(lengths.max()))[place]
    mixed = np.add.reduceat(parts, first) * _MIX[255] + lengths.astype(np.uint64)
    return mixed ^ (mixed >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of `k` words by prefix sums."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    sums = np.r_[np.uint64(0), np.cumsum(words * _powers(_WORD_BASE, len(words)))]
    grams = (sums[k:] - sums[:-k]) * _powers(_INVERSE, len(words) - k + 1)
    grams = (grams ^ (grams >> np.uint64(29))) * _MIX[254]
    return grams ^ (grams >> np.uint64(32))


def winnowed(grams: np.ndarray, w: int) -> np.ndarray:
    """Positions whose hash is the least of some window of `w` grams (all of them when it occurs again).

    Fewer than `w` grams give none: such a text has no span of full length.
    """
    n = len(grams) - w + 1
    if n < 1:
        return np.zeros(0, np.int64)
    least = grams[:n].copy()
    for j in range(1, w):
        np.minimum(least, grams[j: j + n], out=least)
    chosen = np.zeros(len(grams), bool)
    for j in range(w):
        chosen[j: j + n] |= grams[j: j + n] == least
    return np.flatnonzero(chosen)


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def windows(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """(item, words, size, print, whole): each window of each item once, with the fingerprint that a document
    sharing the window would show and the hash of the whole window (the same for a short item)."""
    gram = min(GRAM, window)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), rows_of(batch.column(1))):
                tokens = words_of(raw or b"")
                size = min(window, len(tokens))
                if not size:
                    continue
                hashes = word_hashes(raw)
                wholes = gram_hashes(hashes, size)
                grams = gram_hashes(hashes, gram) if size == window else wholes
                rows = {}
                for at, whole in enumerate(wholes):
                    least = grams[at: at + max(1, size - gram + 1)].min() if size == window else whole
                    rows.setdefault(b" ".join(tokens[at: at + size]), (least, whole))
                both = np.array(list(rows.values()), np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([item] * len(rows), pa.int64()), pa.array([k.decode() for k in rows]),
                    pa.array([size] * len(rows), pa.int32()), pa.array(both[:, 0]), pa.array(both[:, 1]),
                ], ["item", "words", "size", "print", "whole"])

    return items.select(F.col(key).cast("long"), text).mapInArrow(
        cut_up, "item long, words string, size int, print long, whole long"
    )


def bit_tables(known: DataFrame, bits: int) -> dict[tuple[str, int], bytes]:
    """By ("print" or "whole", window size), 2^bits bits that are set at the leading bits of the hashes.

    Spark builds them as bitmaps; what reaches the driver is bounded by the size of the tables, of which there
    are two at most for each window size, and not by the benchmark.
    """
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("hash")) for k in ("print", "whole"))))
    hashes = known.select("size", kinds.alias("at")).select("size", "at.kind", "at.hash")
    slot = F.shiftrightunsigned("hash", 64 - bits)
    marked = hashes.groupBy("kind", "size", F.shiftright(slot, 15).alias("bucket")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("map")
    )
    tables: dict[tuple[str, int], bytearray] = {}
    for row in marked.toLocalIterator():
        table = tables.setdefault((row["kind"], row["size"]), bytearray(1 << (bits - 3)))
        table[row["bucket"] << 12: (row["bucket"] + 1) << 12] = row["map"]
    return {at: bytes(table) for at, table in tables.items()}


def _set(table: bytes, slots: np.ndarray) -> np.ndarray:
    bytes_ = np.frombuffer(table, np.uint8)
    return (bytes_[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def candidate_runs(words: np.ndarray, tables: dict[tuple[str, int], bytes], window: int, bits: int) -> list[tuple[int, int, int]]:
    """(first start, last start, size) of neighbouring spans of `size` words that may be benchmark windows."""
    found, gram = [], min(GRAM, window)
    for size in sorted({size for _, size in tables}):
        if len(words) < size:
            continue
        wholes = None
        if size < window:
            starts = np.arange(len(words) - size + 1)
        else:
            grams = gram_hashes(words, gram)
            chosen = winnowed(grams, window - gram + 1)
            chosen = chosen[_set(tables["print", size], _slot(grams[chosen], bits))]
            around = (chosen[:, None] - np.arange(window - gram + 1)).ravel()
            starts = np.unique(around[(around >= 0) & (around <= len(words) - window)])
        if len(starts):
            wholes = gram_hashes(words, size)
            starts = starts[_set(tables["whole", size], _slot(wholes[starts], bits))]
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) if len(starts) else ():
            found.append((int(run[0]), int(run[-1]), size))
    return found


def scan(docs: DataFrame, key: str, text: str, tables: dict[tuple[str, int], bytes], window: int, bits: int = BITS) -> DataFrame:
    """(row, key, n_words, start, size, words): a row per document (start null) and one per candidate run."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    kinds = {"row": pa.int64(), "key": pa.int64(), "n_words": pa.int64(), "start": pa.int64(), "size": pa.int32(), "words": pa.string()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), rows_of(batch.column(2))):
                hashes = word_hashes(raw or b"")
                out.append((row, name, len(hashes), None, None, None))
                runs = candidate_runs(hashes, shared.value, window, bits)
                tokens = words_of(raw) if runs else []
                out += [(row, name, None, a, size, b" ".join(tokens[a: b + size]).decode()) for a, b, size in runs]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    rows = docs.select(F.monotonically_increasing_id(), F.col(key).cast("long"), text)
    return rows.mapInArrow(look, "row long, key long, n_words long, start long, size int, words string")


def _islands(starts: Column, size: Column) -> Column:
    """Covered stretches [begin, end) of sorted starts of spans of `size` words."""
    begin = F.array().cast("array<struct<begin:bigint,end:bigint>>")

    def grown(done: Column, at: Column) -> Column:
        last = F.element_at(done, -1)
        own = F.struct(at.cast("long").alias("begin"), (at + size).cast("long").alias("end"))
        longer = F.struct(last["begin"].alias("begin"), (at + size).cast("long").alias("end"))
        meets = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= at)
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(own))
        )

    return F.aggregate(starts, begin, grown)


def contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, share: int = SHARE, bits: int = BITS,
) -> DataFrame:
    """(key, n_words, n_hit, item_ids, contaminated): per document the words that lie in any occurrence of a
    benchmark window, the items with occurring windows (sorted), and whether hits reach one in `share` words.

    One row per input row, repeated rows included; keys are whole numbers and may be null. Null and empty
    texts have no words and no hits; items without words have no windows; items with equal windows are all
    named; a null item id makes hits but is not named. An empty document table gives no rows, an empty
    benchmark no hits. Other columns are ignored.
    """
    known = cut(windows(items, item_key, item_text, window))
    seen = cut(scan(docs, key, text, bit_tables(known, bits), window, bits))
    spans = seen.where(F.col("start").isNotNull()).select("row", "start", "size", "words")
    pieces = let(F.split("words", " "), lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - F.col("size")), lambda i: F.array_join(F.slice(w, i + 1, F.col("size")), " ")
    ))
    runs = spans.select("size", "words").distinct().select("size", "words", F.posexplode(pieces).alias("at", "piece"))
    named = known.select("size", F.col("words").alias("piece"), "item")
    hits = runs.join(named, ["size", "piece"]).groupBy("size", "words").agg(
        F.array_sort(F.collect_set("at")).alias("starts"), F.collect_set("item").alias("items")
    )
    hits = cut(hits.select("size", "words", _islands(F.col("starts"), F.col("size")).alias("islands"), "items"))

    held = spans.join(hits, ["size", "words"]).select("row", "start", "islands", "items")
    covers = held.select("row", "start", F.explode("islands").alias("i")).select(
        "row", (F.col("start") + F.col("i.begin")).alias("begin"), (F.col("start") + F.col("i.end")).alias("end")
    )
    before = Window.partitionBy("row").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(F.max("end").over(before), F.lit(0))))
    lengths = covers.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    ids = held.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("item_ids"))
    totals = seen.where(F.col("start").isNull()).select("row", "key", "n_words")
    out = totals.join(lengths.join(ids, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        F.col("key").alias(key), "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def item_digest(ids: Column) -> Column:
    """SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(ids, lambda i: i.cast("string"))), ","), 256)

"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a few numbers (shares of characters, words and lines), each number a bin. Training goes round and
round over the features; each visit grows a tree of a few leaves over one feature's bins and adds a small part
of it to that feature's lookup table. The pairs of features that explain most of what is left get tables of
their own, grown in the same way by trees of two levels. A score adds one table entry per feature and pair.

Training reads at most `max_rows` labelled rows (those with the least hash of their key), so that what reaches
the driver has a bound; scoring is one pass over the texts, without a shuffle.
"""

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.llm.texts import rows_of, word_pieces

MAX_ROWS = 50_000
BINS = 32
ROUNDS = 80
RATE = 0.2
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 30
SHRINK = 1.0
KEEP_FROM = 0.7

FEATURES = (
    "log_bytes log_words word_bytes distinct_words top_word capitals digits symbols marks bars punctuation "
    "beyond_ascii blanks log_line_words repeated_lines ended_lines symbol_words longest_word"
).split()


def _class_of(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_CLASSES = np.array([
    _class_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class_of("0123456789"), _class_of("#$%&*+<=>@\\^_~{}[]"),
    _class_of("!?"), _class_of("|"), _class_of(".,;:'\"()-"), np.arange(256) > 0x7F, _class_of(" \t\n\r\v\f"),
], float).T
_LETTERS = _class_of("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | (np.arange(256) > 0x7F)
_SYMBOL_ENDS = frozenset(b"#$%&*+<=>@\\^_~|!")


def features_of(text: bytes) -> list[float]:
    """One number per name in FEATURES; an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    capitals, *shares = (counts @ _CLASSES).tolist()
    words, odd, longest = Counter(), 0, 0
    for piece in word_pieces(text):
        words.update(piece)
    for word, n in words.items():
        longest = max(longest, len(word))
        if word[-1] in _SYMBOL_ENDS:
            odd += n
    total = sum(words.values())
    lines = [line for line in (part.strip() for part in text.split(b"\n")) if line]
    per_word, per_line = 1 / max(1, total), 1 / max(1, len(lines))
    return [
        math.log1p(len(text)), math.log1p(total), (len(text) - shares[-1]) * per_word, len(words) * per_word,
        max(words.values(), default=0) * per_word, capitals / max(1, int(counts[_LETTERS].sum())),
        *(s / len(text) for s in shares), math.log1p(total * per_line), 1 - len(set(lines)) * per_line if lines else 0.0,
        sum(line[-1] in b".!?\"'" for line in lines) * per_line, odd * per_word, math.log1p(longest),
    ]


def features(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([features_of(t or b"") for t in rows_of(texts)], pa.list_(pa.float64()))

    return of(text)


@dataclass
class Model:
    """Bin edges, a table per feature, and a coarse table per chosen pair of features."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.intercept)
        if not self.tables:
            return out
        coarse = [_binned(rows[:, j], e) for j, e in enumerate(self.coarse)]
        for j, table in enumerate(self.tables):
            out += table[_binned(rows[:, j], self.edges[j])]
        for (a, b), table in self.pairs.items():
            out += table[coarse[a], coarse[b]]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="left")


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SHRINK)


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + SHRINK)


def _line_tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Per bin the value of a tree with up to `leaves` leaves over the sums of gradients and curvatures."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            all_g, all_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            at = int(gains.argmax())
            best = max(best, (float(gains[at]), (a, b), a + at + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        (a, b), at = best[1], best[2]
        parts.remove((a, b))
        parts += [(a, at), (at, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _cell_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Two levels: a cut of the first axis, then of the second on either side; and the gain."""
    best, out = 0.0, np.zeros_like(g)
    for cut in range(1, len(g)):
        value, gain = np.zeros_like(g), -float(_gain(g.sum(), h.sum()))
        for side in (slice(0, cut), slice(cut, None)):
            row_g, row_h = g[side].sum(0), h[side].sum(0)
            left_g, left_h = np.cumsum(row_g)[:-1], np.cumsum(row_h)[:-1]
            gains = _gain(left_g, left_h) + _gain(row_g.sum() - left_g, row_h.sum() - left_h)
            if not len(gains):
                return out, 0.0
            at = int(gains.argmax())
            gain += float(gains[at])
            value[side, : at + 1] = _leaf(left_g[at], left_h[at])
            value[side, at + 1:] = _leaf(row_g.sum() - left_g[at], row_h.sum() - left_h[at])
        if gain > best:
            best, out = gain, value
    return out, best


def train(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the tables on feature rows and 0/1 labels. Without both classes only the intercept is set."""
    ones = float(labels.sum())
    model = Model(math.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    if ones in (0, len(labels)):
        return model
    n = rows.shape[1]
    model.edges = [_edges(rows[:, j], BINS) for j in range(n)]
    model.coarse = [_edges(rows[:, j], PAIR_BINS) for j in range(n)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [_binned(rows[:, j], e) for j, e in enumerate(model.edges)]
    coarse = [_binned(rows[:, j], e) for j, e in enumerate(model.coarse)]
    logits = np.full(len(rows), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, bins in enumerate(fine):
            g, h = slopes()
            size = len(model.tables[j])
            step = RATE * _line_tree(np.bincount(bins, g, size), np.bincount(bins, h, size))
            model.tables[j] += step
            logits += step[bins]

    def cells(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        at, (g, h) = coarse[a] * shape[1] + coarse[b], slopes()
        return tuple(np.bincount(at, x, shape[0] * shape[1]).reshape(shape) for x in (g, h))

    ranked = sorted(combinations(range(n), 2), key=lambda ab: -_cell_tree(*cells(*ab))[1])
    model.pairs = {(a, b): np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)) for a, b in ranked[:PAIRS]}
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in model.pairs.items():
            step = RATE * _cell_tree(*cells(a, b))[0]
            table += step
            logits += step[coarse[a], coarse[b]]
    return model


def held_out(key: Column) -> Column:
    """Rows that are never learned from: CRC-32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Model:
    """Train on at most `max_rows` labelled rows that are not held out.

    Rows without key or label, and labels of unknown documents, are left out; a key labelled twice counts with
    each label once, a key with several texts with the one of the least hash. Without any label the score of every text
    is a half. Null and empty texts have zeros as features; very long ones are read whole. Other columns are not read.
    The labelled keys are broadcast: at most `max_rows` of them.
    """
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).dropna()
    known = known.where(~held_out(F.col("_key"))).orderBy(F.xxhash64("_key"), "_key", "_label").limit(max_rows)
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    print_of = F.struct(F.xxhash64("_text"), F.crc32(F.coalesce("_text", F.lit("")).cast("binary"))).alias("_print")
    rows = own.join(F.broadcast(known), "_key").select("_key", "_label", print_of, features(F.col("_text")).alias("_row"))
    rows = rows.groupBy("_key", "_label").agg(F.min_by("_row", "_print").alias("_row"))
    got = rows.orderBy("_key", "_label").select("_label", "_row").toArrow()
    if not got.num_rows:
        return Model(0.0)
    matrix = got["_row"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
    return train(matrix, got["_label"].to_numpy().astype(float))


def score(text: Column, model: Model) -> Column:
    """Between 0 and 1, higher for better texts; null counts as an empty text."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(_matrix(rows_of(texts))))

    return of(text)


def _matrix(texts: Iterable[bytes | None]) -> np.ndarray:
    return np.array([features_of(t or b"") for t in texts], float).reshape(-1, len(FEATURES))

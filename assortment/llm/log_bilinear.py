"""Language-model scores by a log-bilinear model, trained in numpy by noise-contrastive estimation.

The words before a token, each scaled part by part for its place, add up to one context vector; its product with a
token's vector, plus a bias, is the token's logit. Training never normalises: it tells the tokens of the corpus
from noise tokens of the unigram distribution; the noise is taken in expectation, not drawn, so that every step is
exact and the same for any partitions. Scores are normalised: for every distinct context of a batch one matrix
product gives all logits, and their log-sum-exp is taken off.

The model's tokens are the most frequent words of the training texts, the end of a text, and a few kinds of all other
words (by how they end). A word beyond the model's gets the probability of its kind times its smoothed
share of that kind, (c + 1) / (N + V + 1) by counts inside the kind, so the model is a distribution over all words.

How the work is spread: words are counted over all training texts, and their counts are a table. Texts are encoded
once, by a bounded list of frequent words that tasks carry; the words beyond it go to their counts by a join. The
model learns from the counts of all (context, token) triples of the training texts, packed into SHARDS rows by their
context; a training step is one pass over these, and each shard hands the driver one gradient of the model's size.
Gradients are added in the order of the shards, and equal counts give equal models.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assortment.llm.texts import rows_of, word_pieces
from assortment.sources.lineage import cut

#: Words of the model, words whose counts the tasks carry, and words of a context.
WORDS = 500
FREQUENT = 200_000
CONTEXT = 2
#: Parts of a vector and their spread at the start, training steps, their size and decays, and noise tokens per token.
DIM = 16
START = 0.1
STEPS = 16
RATE = 0.2
FIRST, SECOND = 0.9, 0.95
NOISE = 16
SHARDS = 64
KINDS = 64
#: Tokens that a task works on at a time, whose vectors it holds at once, contexts per matrix product, and distinct words
#: held while counting.
TOKENS = 2_000_000
VECTORS = 1 << 16
CONTEXTS = 4096
HELD_WORDS = 300_000


def kind_of(word: bytes) -> int:
    """0 to KINDS - 1, by the last two characters: endings tell languages and parts of speech apart."""
    return zlib.crc32(word.decode()[-2:].encode()) % KINDS


def kind_column(word: Column) -> Column:
    """`kind_of` for a column of strings."""
    return (F.crc32(F.substring(word, -2, 2).cast("binary")) % KINDS).cast("int")


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts, lower-cased in A-Z; the empty word stands for the end of a text."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for value in rows_of(batch.column(0)):
                counts[b""] += 1
                for words in word_pieces((value or b"").lower()):
                    counts.update(words)
                    if len(counts) > HELD_WORDS:
                        yield batch_of(counts)
                        counts = Counter()
        yield batch_of(counts)

    return texts.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Frequent words by falling count, the first `words` of them tokens of the model, and totals of the training texts.

    Token numbers: words, then kinds, then the end of a text; a start mark stands before a text, in contexts only.
    """

    frequent: list[bytes]
    counts: np.ndarray
    words: int
    tokens: int
    distinct: int
    ends: int
    in_kind: np.ndarray
    of_kind: np.ndarray

    @property
    def end(self) -> int:
        return self.words + KINDS

    @property
    def size(self) -> int:
        """Tokens that can follow."""
        return self.words + KINDS + 1

    @property
    def start(self) -> int:
        return self.size

    @property
    def base(self) -> int:
        """Numbers of a context."""
        return self.size + 1

    def kind_logs(self) -> np.ndarray:
        """log10 of what a count in a kind is divided by."""
        return np.log10(self.in_kind + self.of_kind + 1.0)

    def unigram(self) -> np.ndarray:
        """Share of each token in the training texts, never 0."""
        n = np.concatenate([self.counts[: self.words], self.in_kind, [self.ends]]) + 0.5
        return n / n.sum()


def vocabulary(counts: DataFrame, words: int = WORDS, frequent: int = FREQUENT) -> Vocabulary:
    """From (word, n) rows; the driver receives `frequent` words at most."""
    own = counts.where("word <> ''")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.where("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    top = own.orderBy(F.desc("n"), "word").limit(max(words, frequent)).toArrow()
    listed, held = [w.encode() for w in top["word"].to_pylist()], top["n"].to_numpy().astype(np.int64)
    kept = min(words, len(listed))
    in_kind, of_kind = np.zeros(KINDS), np.zeros(KINDS)
    kinds = own.groupBy(kind_column(F.col("word")).alias("kind")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    for row in kinds.collect():  # one row per kind
        in_kind[row.kind], of_kind[row.kind] = row.n, row.v
    for word, n in zip(listed[:kept], held[:kept]):
        in_kind[kind_of(word)] -= n
        of_kind[kind_of(word)] -= 1
    return Vocabulary(listed, held, kept, int(total[0]), int(total[1]), int(ends), in_kind, of_kind)


PIECES = (
    "held_out boolean, n_tokens long, n_known long, count_log double, kind_log double, ids binary, "
    "rare array<struct<word: string, n: long>>"
)


def encoded(texts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The texts of (row, key, held_out, text) as rows of up to a megabyte of text each, in PIECES.

    `ids` holds the token numbers as 16-bit integers, after the CONTEXT numbers before them. `count_log` adds the
    log10(c + 1) of the frequent words and the end, `kind_log` what a score has beside the model's tokens: the same
    for words beyond the model, less the log of the total of their kind. Words beyond the frequent ones are in `rare`.
    """
    place = {word: i for i, word in enumerate(vocab.frequent)}
    k, end, start, ends = vocab.words, vocab.end, vocab.start, vocab.ends
    logs, kind_logs, end_log = np.log10(vocab.counts + 1.0), vocab.kind_logs(), math.log10(vocab.ends + 1)
    kinds = np.fromiter(map(kind_of, vocab.frequent), np.int64, len(place))
    of_model = np.arange(len(place)) < k
    number = np.where(of_model, np.arange(len(place)), k + kinds)
    beyond = np.where(of_model, 0.0, logs - kind_logs[kinds])
    rare_type = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
    kinds_of_columns = {
        "n_tokens": pa.int64(), "n_known": pa.int64(), "count_log": pa.float64(), "kind_log": pa.float64(),
        "ids": pa.binary(), "rare": rare_type,
    }

    def piece(words: list[bytes], before: np.ndarray, last: bool) -> tuple:
        at = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
        known = at >= 0
        found, ids = at[known], np.full(len(words) + last, end, np.int16)
        others = [words[i] for i in np.flatnonzero(~known).tolist()]
        kind = np.fromiter(map(kind_of, others), np.int64, len(others))
        ids[: len(words)][known] = number[found]
        ids[: len(words)][~known] = k + kind
        count_log = float(logs[found].sum()) + last * end_log
        kind_log = float(beyond[found].sum() - kind_logs[kind].sum())
        rare = [{"word": w.decode(), "n": n} for w, n in Counter(others).items()]
        return len(ids), len(found) + (last and ends > 0), count_log, kind_log, np.concatenate([before, ids]), rare

    def pieces_of(text: bytes) -> Iterator[tuple]:
        before, words = np.full(CONTEXT, start, np.int16), []
        for following in word_pieces(text.lower()):
            if words:
                found = piece(words, before, False)
                before = found[4][-CONTEXT:]
                yield found
            words = following
        yield piece(words, before, True)

    def packed(batch: pa.RecordBatch, rows: list[int], parts: list[tuple]) -> pa.RecordBatch:
        *figures, ids, rare = zip(*parts)
        columns = [*figures, [x.tobytes() for x in ids], rare]
        own = batch.select(["row", "key", "held_out"]).take(pa.array(rows))
        made = [pa.array(c, t) for c, t in zip(columns, kinds_of_columns.values())]
        return pa.RecordBatch.from_arrays([*own.columns, *made], [*own.schema.names, *kinds_of_columns])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, size = [], [], 0
            for row, value in enumerate(rows_of(batch.column("text"))):
                for part in pieces_of(value or b""):
                    rows.append(row)
                    parts.append(part)
                    size += part[0]
                    if size > TOKENS:
                        yield packed(batch, rows, parts)
                        rows, parts, size = [], [], 0
            if parts:
                yield packed(batch, rows, parts)

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("row", "key", "held_out", "text").mapInArrow(encode, f"row long, key {kind}, {PIECES}")


def _token_runs(column: pa.Array, base: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(context number, token, tokens of each row) of rows of `ids`, some TOKENS at a time."""
    sizes = np.array([len(v) // 2 - CONTEXT for v in column.to_pylist()])
    first = 0
    while first < len(column):
        last = max(first + 1, first + int(np.searchsorted(np.cumsum(sizes[first:]), TOKENS, side="right")))
        contexts, tokens = [], []
        for value in column.slice(first, last - first):
            ids = np.frombuffer(value.as_py(), np.int16).astype(np.int64)
            number = np.zeros(len(ids) - CONTEXT, np.int64)
            for i in range(CONTEXT):
                number = number * base + ids[i:len(ids) - CONTEXT + i]
            contexts.append(number)
            tokens.append(ids[CONTEXT:])
        yield np.concatenate(contexts), np.concatenate(tokens), sizes[first:last]
        first = last


def triples(pieces: DataFrame, base: int) -> DataFrame:
    """(shard, keys, counts): the (context, token) triples of the pieces, one row per shard, sorted by key.

    A key is context number * base + token; both columns hold 64-bit integers.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for context, token, _ in _token_runs(batch.column("ids"), base):
                keys, n = np.unique(context * base + token, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    def pack(group: pa.Table) -> pa.Table:
        keys, n = group["key"].to_numpy(), group["n"].to_numpy()
        order = np.argsort(keys)
        return pa.table({
            "shard": group["shard"][:1], "keys": pa.array([keys[order].tobytes()], pa.binary()),
            "counts": pa.array([n[order].tobytes()], pa.binary()),
        })

    found = pieces.select("ids").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    shard = F.pmod(F.xxhash64(F.expr(f"key div {base}")), F.lit(SHARDS)).cast("int")
    return found.withColumn("shard", shard).groupBy("shard").applyInArrow(pack, "shard int, keys binary, counts binary")


@dataclass
class Model:
    """Vectors of context words (size + 1 rows, with the start mark) and of tokens, scales per place, biases."""

    context: np.ndarray
    token: np.ndarray
    place: np.ndarray
    bias: np.ndarray

    @classmethod
    def started(cls, unigram: np.ndarray, dim: int = DIM) -> "Model":
        rng = np.random.default_rng(0)
        size = len(unigram)
        return cls(
            rng.normal(0, START, (size + 1, dim)), rng.normal(0, START, (size, dim)), np.ones((CONTEXT, dim)), np.log(unigram)
        )

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.token, self.place, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def with_flat(self, flat: np.ndarray) -> "Model":
        at, out = 0, []
        for part in self.parts():
            out.append(flat[at:at + part.size].reshape(part.shape))
            at += part.size
        return Model(*out)

    def words_of(self, contexts: np.ndarray) -> list[np.ndarray]:
        """The word at each place of context numbers, the farthest first."""
        base = len(self.context)
        return [contexts // base ** (CONTEXT - 1 - i) % base for i in range(CONTEXT)]

    def vectors(self, contexts: np.ndarray) -> np.ndarray:
        return sum(self.context[word] * scale for word, scale in zip(self.words_of(contexts), self.place))

    def log_totals(self, contexts: np.ndarray) -> np.ndarray:
        """Log of the sum over all tokens of exp(logit), by a matrix product per CONTEXTS contexts."""
        out, tokens, bias = np.empty(len(contexts)), self.token.T.astype(np.float32), self.bias.astype(np.float32)
        for start in range(0, len(contexts), CONTEXTS):
            logits = self.vectors(contexts[start:start + CONTEXTS]).astype(np.float32) @ tokens
            logits += bias
            most = logits.max(1, keepdims=True)
            logits -= most
            np.exp(logits, out=logits)
            out[start:start + CONTEXTS] = most[:, 0] + np.log(logits.sum(1, dtype=np.float64))
        return out

    def log_probabilities(self, contexts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Natural log of each token's probability after its context number."""
        distinct, at = np.unique(contexts, return_inverse=True)
        vectors, totals = self.vectors(distinct), self.log_totals(distinct)
        out = self.bias[tokens]
        for start in range(0, len(tokens), VECTORS):
            part = slice(start, start + VECTORS)
            out[part] += np.einsum("ij,ij->i", vectors[at[part]], self.token[tokens[part]])
        return out - totals[at]


def _chance(x: np.ndarray) -> np.ndarray:
    """Logistic function, in place."""
    np.negative(x, out=x)
    np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def gradient(model: Model, noise: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Model:
    """Gradient of the noise-contrastive objective over sorted triples.

    Every token of the corpus is told from NOISE noise tokens in its context; `noise` is their distribution, over
    which the noise term is taken in full. `model.bias` less log(NOISE * noise) is what a token has for itself.
    """
    base, size = len(model.context), len(model.token)
    context, token = keys // base, keys % base
    starts = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
    distinct, own = context[starts], np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(context)]))
    weight = np.add.reduceat(counts, starts).astype(np.float32)
    vectors, tokens = model.vectors(distinct).astype(np.float32), model.token.astype(np.float32)
    lead = (model.bias - np.log(NOISE * noise)).astype(np.float32)

    mine, theirs = vectors[own], tokens[token]
    pull = counts * _chance(-np.einsum("ij,ij->i", mine, theirs) - lead[token])
    to_vectors = np.add.reduceat(theirs * pull[:, None].astype(np.float32), starts)
    to_token = np.stack([np.bincount(token, pull * mine[:, j], size) for j in range(mine.shape[1])], axis=1)
    to_bias = np.bincount(token, pull, size)

    share = (NOISE * noise).astype(np.float32)
    for start in range(0, len(distinct), CONTEXTS):
        part = slice(start, start + CONTEXTS)
        push = _chance(vectors[part] @ tokens.T + lead)
        push *= share
        push *= -weight[part, None]
        to_vectors[part] += push @ tokens
        to_token += push.T @ vectors[part]
        to_bias += push.sum(0, dtype=np.float64)

    to_context, to_place = np.zeros_like(model.context), np.zeros_like(model.place)
    for i, word in enumerate(model.words_of(distinct)):
        step = to_vectors * model.place[i]
        to_context += np.stack([np.bincount(word, step[:, j], base) for j in range(step.shape[1])], axis=1)
        to_place[i] = (to_vectors * model.context[word]).sum(0)
    return Model(to_context, to_token, to_place, to_bias)


def train(shards: DataFrame, unigram: np.ndarray, dim: int = DIM, steps: int = STEPS) -> Model:
    """Fit the model on the rows of `triples`: a pass per step, Adam on the driver."""
    model = Model.started(unigram, dim)
    flat = model.flat()
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        current = model.with_flat(flat)

        def work(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, keys, counts in zip(*batch.columns):
                    n = np.frombuffer(counts.as_py(), np.int64)
                    found = gradient(current, unigram, np.frombuffer(keys.as_py(), np.int64), n)
                    slope = pa.array([found.flat().astype(np.float32).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()], pa.int32()), slope, pa.array([int(n.sum())])], ["shard", "slope", "n"])

        found = sorted(shards.mapInArrow(work, "shard int, slope binary, n long").collect())  # SHARDS rows at most
        if not found:
            break
        slope = sum(np.frombuffer(row.slope, np.float32).astype(float) for row in found) / sum(row.n for row in found)
        mean, square = FIRST * mean + (1 - FIRST) * slope, SECOND * square + (1 - SECOND) * slope * slope
        rate = RATE * (1 - (step - 1) / steps)
        flat = flat + rate * (mean / (1 - FIRST ** step)) / (np.sqrt(square / (1 - SECOND ** step)) + 1e-8)
    return model.with_flat(flat)


def model_logs(pieces: DataFrame, model: Model) -> DataFrame:
    """Replace `ids` by `model_log`, the log10 probability of the tokens of each row."""
    base = len(model.context)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0)]
            for context, token, sizes in _token_runs(batch.column("ids"), base):
                logs = model.log_probabilities(context, token) / math.log(10)
                found.append(np.add.reduceat(logs, np.r_[0, np.cumsum(sizes)[:-1]]))
            rest = batch.drop_columns(["ids"])
            yield rest.append_column("model_log", pa.array(np.concatenate(found)))

    names = [c for c in pieces.columns if c != "ids"]
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names)
    return pieces.mapInArrow(work, f"{schema}, model_log double")


def scored(
    docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", words: int = WORDS, frequent: int = FREQUENT,
    steps: int = STEPS,
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per document.

    Learns from the rows whose `held_out` is false; null counts as false. Scores are log10 probabilities of a text:
    its words between ASCII blanks, lower-cased in A-Z, and its end. A null or empty text is its end alone. Every row
    of a repeated or null key is scored by itself, and learned from as often as it appears. Without training rows
    nothing is known: base scores are 0, scores those of the untrained model over kinds. An empty table gives no rows.
    Very long texts are worked on in pieces of a megabyte. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"),
    )
    counts = cut(word_counts(own.where(~F.col("held_out")), "text"))
    vocab = vocabulary(counts, words, frequent)
    pieces = cut(encoded(own, vocab))
    shards = cut(triples(pieces.where(~F.col("held_out")), vocab.base))
    model = train(shards, vocab.unigram(), steps=steps)

    rare = pieces.select("row", F.explode("rare").alias("one")).select("row", "one.word", "one.n")
    known = rare.join(counts.withColumnRenamed("n", "c"), "word").groupBy("row").agg(
        F.sum("n").alias("n_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("count_log")
    )
    nothing = {"key": F.lit(None).cast(kind), "held_out": F.lit(None).cast("boolean"), "n_tokens": F.lit(0), "model_log": F.lit(0.0)}
    beside = known.withColumns(nothing).withColumn("kind_log", F.col("count_log"))
    each = model_logs(pieces.drop("rare"), model).unionByName(beside).groupBy("row").agg(
        F.max("key").alias("key"), F.max("held_out").alias("held_out"),
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "count_log", "kind_log", "model_log")),
    )
    total = math.log10(vocab.tokens + vocab.distinct + 1)
    return each.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("count_log") - F.col("n_tokens") * total).alias("base_score"),
        (F.col("model_log") + F.col("kind_log")).alias("score"),
    )


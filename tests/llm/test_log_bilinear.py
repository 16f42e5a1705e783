"""The log-bilinear model: counts and scores by plain Python, the gradient by differences, hard rows."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assortment.llm import log_bilinear as lb
from assortment.llm.queries import QUERIES

from .helpers import HARD_TEXTS, documents

DATA = "/root/testdata/sf0.001"


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [""]


def base_scores(texts, held):
    """n_tokens, n_known, N and base score per text."""
    counts = Counter(t for text, h in zip(texts, held) if not h for t in tokens_of(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        tokens = tokens_of(text)
        score = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        out.append((len(tokens), sum(counts[t] > 0 for t in tokens), total, score))
    return out


def model_score(text, model, vocab, counts):
    """Plain form: one token at a time, the whole softmax each time."""
    place = {w: i for i, w in enumerate(vocab.frequent[: vocab.words])}
    in_kind, of_kind = defaultdict(int), defaultdict(int)
    for word, n in counts.items():
        if word and word.encode() not in place:
            in_kind[lb.kind_of(word.encode())] += n
            of_kind[lb.kind_of(word.encode())] += 1
    before, score = [vocab.start] * lb.CONTEXT, 0.0
    for token in tokens_of(text):
        word = token.encode()
        kind = lb.kind_of(word)
        number = vocab.end if not word else place.get(word, vocab.words + kind)
        vector = sum(model.context[b] * model.place[i] for i, b in enumerate(before))
        logits = [float(vector @ t + b) for t, b in zip(model.token, model.bias)]
        most = max(logits)
        score += (logits[number] - most - math.log(sum(math.exp(x - most) for x in logits))) / math.log(10)
        if word and word not in place:
            score += math.log10((counts[token] + 1) / (in_kind[kind] + of_kind[kind] + 1))
        before = [*before[1:], number]
    return score


def fitted(spark, docs, held, **options):
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").alias("key"), held.alias("held_out"), "text")
    vocab = lb.vocabulary(lb.word_counts(own.where("not held_out"), "text"), **options)
    pieces = lb.encoded(own, vocab)
    return vocab, lb.train(lb.triples(pieces.where("not held_out"), vocab.base), vocab.unigram())


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op12_language_model"](spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    held = [zlib.crc32(str(d.doc_id).encode()) % 7 == 2 for d in docs]
    assert len(got) == len(docs)
    for d, h, (n, known, total, base) in zip(docs, held, base_scores([d.text for d in docs], held)):
        r = got[d.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    vocab, model = fitted(spark, frame, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    counts = Counter(t for d, h in zip(docs, held) if not h for t in tokens_of(d.text))
    for d in docs[:25]:
        if len(d.text or "") < 3000:
            assert math.isclose(got[d.doc_id].score, model_score(d.text, model, vocab, counts), rel_tol=1e-4)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) and all(r.score < 0 for r in got.values())


def small_model(size=7, dim=3, seed=1):
    rng = np.random.default_rng(seed)
    share = rng.random(size) + 0.1
    model = lb.Model.started(share / share.sum(), dim)
    return model.with_flat(model.flat() + rng.normal(0, 0.5, len(model.flat()))), share / share.sum()


def test_gradient_by_differences():
    model, noise = small_model()
    base = len(model.context)
    rng = np.random.default_rng(2)
    keys, counts = np.unique(rng.integers(0, base * base, 40) * base + rng.integers(0, base - 1, 40), return_counts=True)

    def objective(m):
        out, weight = 0.0, Counter()
        for key, n in zip(keys.tolist(), counts.tolist()):
            context, token = divmod(key, base)
            vector = m.vectors(np.array([context]))[0]
            x = vector @ m.token[token] + m.bias[token] - math.log(lb.NOISE * noise[token])
            out -= n * math.log1p(math.exp(-x))
            weight[context] += n
        for context, n in weight.items():
            x = m.token @ m.vectors(np.array([context]))[0] + m.bias - np.log(lb.NOISE * noise)
            out -= n * lb.NOISE * float(noise @ np.log1p(np.exp(x)))
        return out

    found, flat = lb.gradient(model, noise, keys, counts).flat(), model.flat()
    for at in range(len(flat)):
        step = np.zeros_like(flat)
        step[at] = 1e-5
        slope = (objective(model.with_flat(flat + step)) - objective(model.with_flat(flat - step))) / 2e-5
        assert math.isclose(found[at], slope, rel_tol=2e-3, abs_tol=2e-3)


def test_probabilities_add_up_to_one(monkeypatch):
    monkeypatch.setattr(lb, "CONTEXTS", 5)
    model, _ = small_model()
    contexts = np.arange(len(model.context) ** lb.CONTEXT)
    for token_sum in sum(np.exp(model.log_probabilities(contexts, np.full(len(contexts), t))) for t in range(len(model.token))):
        assert math.isclose(token_sum, 1, rel_tol=1e-5)


def test_kinds_in_both_forms(spark):
    words = ["a", "the", "Ünï", "x9", "naïve", "\U0001f600", "eau", "é", "--", "z\U0001f600"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert [r[0] for r in df.select(lb.kind_column(F.col("word"))).collect()] == [lb.kind_of(w.encode()) for w in words]


def test_same_for_any_partitions_and_pieces(spark, monkeypatch):
    docs, held = spark.read.parquet(f"{DATA}/documents.parquet"), F.col("doc_id") % 5 == 0
    want = {r.doc_id: r for r in lb.scored(docs, held, words=60, frequent=200, steps=3).collect()}
    monkeypatch.setattr(lb, "TOKENS", 500)
    monkeypatch.setattr(lb, "HELD_WORDS", 100)
    got = lb.scored(docs.repartition(7), held, words=60, frequent=90, steps=3).collect()
    for r in got:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known) == (w.n_tokens, w.n_known)
        assert math.isclose(r.score, w.score, rel_tol=1e-6) and math.isclose(r.base_score, w.base_score, rel_tol=1e-9)


def test_long_texts_in_pieces(spark, monkeypatch):
    from assortment.llm import texts

    docs, held = documents(spark), F.lit(False)
    want = sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 4)) for r in lb.scored(docs, held, steps=2).collect())
    pieces = texts.word_pieces
    monkeypatch.setattr(lb, "word_pieces", lambda text: pieces(text, 50))
    got = sorted((r.n_tokens, round(r.base_score, 6), round(r.score, 4)) for r in lb.scored(docs, held, steps=2).collect())
    assert got == want


def test_hard_rows(spark):
    docs = documents(spark)
    got = lb.scored(docs, F.col("doc_id") == 4, words=5, frequent=8, steps=2).collect()
    texts, held = [t for _, t in HARD_TEXTS], [i == 4 for i, _ in HARD_TEXTS]
    want = sorted((i is None, i or 0, n, k, round(b, 6)) for (i, _), (n, k, _, b) in zip(HARD_TEXTS, base_scores(texts, held)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_without_training_rows(spark):
    got = lb.scored(documents(spark), F.lit(True)).collect()
    assert len(got) == len(HARD_TEXTS)
    assert all((r.n_known, r.train_tokens, r.base_score) == (0, 0, 0) and math.isfinite(r.score) for r in got)
    assert lb.scored(documents(spark, []), F.lit(False)).collect() == []


@pytest.mark.parametrize("null", [None])
def test_null_marks_are_learned_from(spark, null):
    got = lb.scored(documents(spark), F.lit(null).cast("boolean"), steps=1).collect()
    assert got[0].train_tokens == sum(len(tokens_of(t)) for _, t in HARD_TEXTS) and not any(r.held_out for r in got)


def test_probabilities_hold_few_vectors_at_once():
    """Many tokens in few contexts: vectors are looked up VECTORS tokens at a time, with the same results."""
    rng = np.random.default_rng(3)
    model = lb.Model.started(np.full(50, 0.02))
    contexts, tokens = rng.integers(0, 51 ** 2, 600_000), rng.integers(0, 50, 600_000)
    tracemalloc.start()
    found = model.log_probabilities(contexts, tokens)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80_000_000  # 128 bytes a token and side at once would be 154 MB
    some = slice(0, 600_000, 5_000)
    logits = model.vectors(contexts[some]) @ model.token.T + model.bias
    want = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    assert found[some] == pytest.approx(want[np.arange(len(want)), tokens[some]], abs=1e-5)

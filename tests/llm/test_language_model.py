"""The scores of the language model against counts in dictionaries and weights learned without blocks or buckets."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanlake.llm import language_model

STEP, R = language_model.STEP, random.Random(8)


def brute(rows, train, order):
    """{row number: (n_tokens, n_known, base_score, score)} and the training tokens."""
    counts = [{} for _ in range(order + 1)]
    grams = []
    for _, text in rows:
        padded = [None] * (order - 1) + (text or "").lower().split() + [0]
        grams.append([[tuple(padded[i - n + 1 : i + 1]) for n in range(order + 1)] for i in range(order - 1, len(padded))])
    for own, learn in zip(grams, train, strict=True):
        for token in own if learn else []:
            for n in range(1, order + 1):
                counts[n][token[n]] = counts[n].get(token[n], 0) + 1
    total, texts = sum(counts[1].values()), counts[1].get((0,), 0)
    distinct = len(counts[1])

    def history(gram):
        h = gram[:-1]
        return total if not h else texts if set(h) == {None} else counts[len(h)].get(h, 0)

    def bucket(token):
        return tuple(int(math.log2(history(token[n]) + 1)) for n in range(2, order + 1))

    bins = {}
    for own, learn in zip(grams, train, strict=True):
        for token in own if learn else []:
            p = []
            for n in range(1, order + 1):
                c, h = counts[n][token[n]] - 1, max(1, history(token[n]) - 1)
                p.append(2 ** ((math.floor(STEP * math.log2(c / h)) + 0.5) / STEP) if c else 0.0)
            for seen in range(order):  # where longer contexts are unseen, the weights are those of a shorter model
                bins.setdefault(bucket(token)[:seen], []).append([1 / (distinct + 1), *p[: seen + 1]])
    start, weights = np.array([0.1] + [0.9 / order] * order), {}
    for k, p in bins.items():
        w = start[: len(k) + 2] / start[: len(k) + 2].sum()
        for _ in range(200):
            share = np.array(p) * w
            new = (share / share.sum(axis=1, keepdims=True)).sum(axis=0) + 1e-3
            new /= new.sum()
            done, w = np.abs(new - w).max() < 1e-7, new
            if done:
                break
        weights[k] = w

    def probability(t):
        known = tuple(x for x in bucket(t) if x)
        w = weights[known]
        return w[0] / (distinct + 1) + sum(w[n] * counts[n].get(t[n], 0) / history(t[n]) for n in range(1, len(known) + 2))

    vocabulary = [k for (k,) in counts[1]] + ["never seen"]
    for own in R.sample([t for own in grams for t in own], 40):
        assert sum(probability([own[n][:-1] + (v,) if n else () for n in range(order + 1)]) for v in vocabulary) == pytest.approx(1)
    out = []
    for own in grams:
        c1 = [counts[1].get(t[1], 0) for t in own]
        score = sum(math.log10(probability(t)) for t in own)
        out.append((len(own), sum(c > 0 for c in c1), sum(math.log10((c + 1) / (total + distinct + 1)) for c in c1), score))
    return out, total


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 4000)  # several buckets
    r = random.Random(order)
    vocabulary = [f"W{i}" for i in range(300)]
    texts = [" ".join(r.choice(vocabulary[: r.choice((5, 40, 300))]) for _ in range(r.randrange(60))) for _ in range(150)]
    texts += [texts[0]] * 5 + ["the end " * 400, "", None, " \t\n", "the  END", "x" * 5000]
    rows = [(i % 140 if i % 50 else None, t) for i, t in enumerate(texts)]  # repeated and null ids
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, block int, train string").repartition(3)
    got = language_model.score_texts(docs, F.col("doc_id") % 3 != 1, order=order).collect()
    want, total = brute(rows, [i is not None and i % 3 != 1 for i, _ in rows], order)
    assert {x.train_tokens for x in got} == {total}
    line = lambda i, n, known, base, score: (i is None, i or 0, n, known, round(base, 6), round(score, 6))
    assert sorted(line(x.doc_id, x.n_tokens, x.n_known, x.base_score, x.score) for x in got) == sorted(line(i, *w) for (i, _), w in zip(rows, want, strict=True))


def test_many_words_each_have_their_own_counts(spark):
    """More word types than any fixed table of words would hold, each a context that is followed by one word only."""
    pairs = 70_000
    docs = spark.range(0, pairs, 500).select(F.col("id").alias("doc_id"), F.expr("array_join(flatten(transform(sequence(id, id + 499), x -> array(concat('a', x), concat('b', x)))), ' ')").alias("text"))
    docs = docs.unionAll(docs.select(F.col("doc_id") + 1, "text"))
    got = language_model.score_texts(docs, F.lit(True)).collect()
    assert len(got) == 2 * pairs // 500 and all(x.n_tokens == 1001 and x.n_known == 1001 for x in got)
    assert all(x.score > 0.6 * x.base_score for x in got)  # b follows a in every second place: about half of the tokens are sure


def test_no_rows_and_no_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert language_model.score_texts(docs.limit(0), F.lit(True)).count() == 0
    got = language_model.score_texts(docs, F.lit(None).cast("boolean")).collect()
    assert all(x.n_known == 0 and x.train_tokens == 0 and x.score < 0 for x in got)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one(order):
    """The model's own probabilities over all words and an unknown one, after frequent, rare and unseen contexts."""
    model = language_model.Model(1000, 50, 30, order)
    r = np.random.default_rng(order)
    contexts = [np.full(400, 1000)] + [r.integers(1, 40, 400) for _ in range(order - 1)]
    counts = [np.minimum(c, r.integers(1, 9, 400)) for c in contexts]
    model.learn_weights(*model.histogram(counts, contexts, np.ones(400, bool)))
    for seen in ([0] * (order - 1), [7] + [0] * (order - 2), [39] * (order - 1), [1] * (order - 1)):
        shares = [r.multinomial(1000, np.ones(50) / 50), *(r.multinomial(h, np.ones(50) / 50) for h in seen)]
        given = [np.append(x, 0) for x in shares]  # the last word is unknown
        total = (10 ** model.log_p(given, [np.full(51, 1000), *(np.full(51, h) for h in seen)])).sum()
        assert total == pytest.approx(1), seen

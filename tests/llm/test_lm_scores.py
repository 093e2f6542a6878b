"""Scores against a plain version that works from the same parameters, and the edges of what numbers hold."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from smeltery.llm import lm_scoring as lm


def statistics(texts, model_words):
    counts = Counter(w for t in texts for w in lm.tokens(t)).most_common()
    return lm.Statistics([w for w, _ in counts], [n for _, n in counts], sum(n for _, n in counts), len(counts), model_words)


def plain_log10(scores, chosen):
    top = max(scores)
    return (scores[chosen] - top - math.log(math.fsum(math.exp(s - top) for s in scores))) / math.log(10)


def plain_scores(model, known, text):
    """Token by token, in Python's own numbers."""
    number = {w: i for i, w in enumerate(known.words[: known.model_words])}
    words = [number.get(w, model.n_words) for w in lm.tokens(text)]
    found = []
    for at, word in enumerate(words):
        vector = [0.0] * lm.WIDTH
        for j in range(lm.CONTEXT):
            before = words[at - 1 - j] if at - 1 - j >= 0 else model.n_words + 1
            vector = [v + float(a) * float(b) for v, a, b in zip(vector, model.seen[before], model.place[j])]

        def scores(rows, bias):
            return [float(b) + math.fsum(v * float(x) for v, x in zip(vector, row)) for row, b in zip(rows, bias)]

        of_class = model.n_classes - 1 if word == model.n_words else word // lm.CLASS_WORDS
        total = plain_log10(scores(model.classes, model.class_bias), of_class)
        if word < model.n_words:
            block = slice(of_class * lm.CLASS_WORDS, (of_class + 1) * lm.CLASS_WORDS)
            total += plain_log10(scores(model.words[block], model.word_bias[block]), word % lm.CLASS_WORDS)
        found.append(total)
    return found


@pytest.mark.parametrize("size", [1.0, 60.0])
def test_scores_of_given_parameters(size):
    draw = random.Random(4)
    texts = [" ".join(f"w{int(draw.paretovariate(0.6)) % 300}" for _ in range(40)).encode() for _ in range(30)] + [b""]
    known = statistics(texts, 150)
    model = lm.Model(known)
    random_numbers = np.random.default_rng(2)
    model.parameters += random_numbers.normal(0, size, len(model.parameters)).astype(np.float32)
    _, _, words, context, ends = lm.Reader(known, True).read(texts)
    got = model.log10_probabilities(context, words)
    want = [s for t in texts for s in plain_scores(model, known, t)]
    assert np.all(np.isfinite(got))
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_scores_beyond_what_exp_holds():
    scores = np.array([[0.0, 500.0, 499.0], [-900.0, -901.0, -2000.0]], dtype=np.float32)
    got = lm._normalised(scores, np.array([2, 0]))
    assert np.allclose(got, [-1 - math.log1p(math.exp(-1)), -math.log1p(math.exp(-1))], atol=1e-6)


def test_more_words_than_small_numbers_hold(spark):
    texts = [" ".join(f"w{i}" for i in range(a, a + 4000)) for a in range(0, 40000, 2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    rows = {r["doc_id"]: r for r in lm.score_texts(docs, model_words=40000).collect()}
    assert len(rows) == len(texts)
    for row in rows.values():
        assert row["n_tokens"] == 4001 and math.isfinite(row["score"]) and row["score"] < 0
    _, _, words, context, _ = lm.Reader(statistics([t.encode() for t in texts], 40000), False).read([texts[0].encode()])
    # 40000 stands for the rare words, one more for no word.
    assert context.max() == 40001 and context.min() >= 0 and words.max() == 40000

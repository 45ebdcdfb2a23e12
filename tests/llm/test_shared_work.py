"""Training and scoring of texts of different lengths side by side, and word counts added up in tasks."""

import tracemalloc
from collections import Counter

import numpy as np

from creditloom.llm import hmm_lm


def test_steps_over_texts_of_different_lengths():
    rnd, k, c = np.random.RandomState(5), 4, 9
    start, move, emit = (x / x.sum(-1, keepdims=True) for x in (rnd.rand(k), rnd.rand(k, k), rnd.rand(k, c) ** 9 + 1e-12))
    texts = [rnd.randint(0, c, n).astype("<u2") for n in (1, 7, 8, 9, 16, 16, 100, 3, 1, 33)]
    alone = [hmm_lm.expected(start, move, emit, [x]) for x in texts]
    for found, wanted in zip(hmm_lm.expected(start, move, emit, texts), map(sum, zip(*alone))):
        assert np.allclose(found, wanted)
    assert np.allclose(hmm_lm.forward(start, move, emit, texts), [x[3] for x in alone])


def test_short_texts_are_not_padded_to_the_longest():
    start, move, emit = np.full(4, 0.25), np.full((4, 4), 0.25), np.full((4, 8), 0.125)
    texts = [np.zeros(20_000, dtype="<u2"), *(np.zeros(4, dtype="<u2") for _ in range(200))]
    for run in (hmm_lm.expected, hmm_lm.forward):
        tracemalloc.start()
        run(start, move, emit, texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 15_000_000  # padded they have 4 million places


def test_word_counts_beyond_what_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(hmm_lm, "KEPT_WORDS", 3)
    texts = ["B a\x1fa b\tc d e É é", None, "", "c c C   x"]
    wanted = Counter("b|a\x1fa|b|c|d|e|É|é||||c|c|c| |x|".split("|"))
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r["word"]: r["c"] for r in hmm_lm.count_words(docs).collect()} == wanted

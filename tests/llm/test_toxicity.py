"""The toxicity network against a plain version, word by word and window by window."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from fallowlens.llm import toxicity as tx


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=12).filter(lambda w: "\0" not in w), min_size=1, max_size=6))
def test_features_of_many_words_equal_those_of_each(words):
    p = tx.Params(word_buckets=97, gram_buckets=89)
    f = tx.Features(words, p)
    for k, w in enumerate(words):
        word, grams = tx.features(w, p)
        assert f.word[k] == word and f.gram[f.starts[k] : f.starts[k] + f.sizes[k]].tolist() == grams


def plain_logit(net, words):
    """One window: both directions, attention and output in doubles, a step at a time."""
    p, w = net.p, {k: v.astype(float) for k, v in net.weights.items()}
    h, logistic = p.hidden, lambda x: 1 / (1 + np.exp(-x))
    inputs = []
    for word in words:
        bucket, grams = tx.features(word, p)
        embedded = np.concatenate([w["word"][bucket], np.mean([w["gram"][g] for g in grams], axis=0)])
        inputs.append(embedded @ w["inputs"] + w["bias"])

    def read(columns, recur, order):
        state, states = np.zeros(h), {}
        for t in order:
            x, hu = inputs[t][columns], state @ recur
            z, r = logistic(x[:h] + hu[:h]), logistic(x[h : 2 * h] + hu[h : 2 * h])
            new = np.tanh(x[2 * h :] + r * hu[2 * h :])
            state = new + z * (state - new)
            states[t] = state
        return states

    forth = read(slice(0, 3 * h), w["forth"], range(len(words)))
    back = read(slice(3 * h, 6 * h), w["back"], reversed(range(len(words))))
    states = [np.concatenate([forth[t], back[t]]) for t in range(len(words))]
    weights = np.array([math.exp(np.tanh(s @ w["look"]) @ w["weigh"]) for s in states])
    pooled = sum(a * s for a, s in zip(weights / weights.sum(), states))
    return pooled @ w["out"] + w["offset"][0]


def test_scores_equal_plain_ones_over_all_windows():
    rng = np.random.default_rng(0)
    vocabulary = [f"{a}{b}{c}" for a in ("foul", "kind", "stone") for b in "aeiou" for c in ("", "s", "ly")]
    texts = [" ".join(rng.choice(vocabulary[15:], n)) for n in rng.integers(1, 90, 80)]
    bad = [" ".join(rng.permutation([*rng.choice(vocabulary[15:], n), *rng.choice(vocabulary[:15], 4)])) for n in rng.integers(1, 90, 40)]
    p = tx.Params(window=8, stride=4, word_buckets=64, gram_buckets=128, dim=3, hidden=4, attention=3, rounds=2)
    model = tx.fit(texts + bad, np.array([0] * 80 + [1] * 40), 0.3, p)
    tested = ["one word", "foula", *texts[:15], *bad[:15], " ".join(texts[:4])]
    got = model.scores(tested, tx.Lexicon(model.net))
    for text, score in zip(tested, got):
        words = tx.split_words(text)
        starts = range(0, max(1, len(words) - p.window + p.stride), p.stride)
        assert {i for s in starts for i in range(s, min(len(words), s + p.window))} == set(range(len(words)))
        best = max(plain_logit(model.net, words[s : s + p.window]) for s in starts)
        want = 1 / (1 + math.exp(-model.slope * (best - model.cut)))
        assert math.isclose(score, want, abs_tol=2e-4)


def test_sample_has_one_text_an_id_and_does_not_depend_on_order(spark):
    rows = [(i % 7, f"text {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, int(i == 3)) for i in range(7)], "id long, toxic int")
    found = [tx.sample(spark.createDataFrame(r, "id long, text string"), labels, tx.Params())[0] for r in (rows, rows[::-1])]
    assert found[0] == found[1] and len(found[0]) == 7

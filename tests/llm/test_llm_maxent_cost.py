"""The check's finding on the language model's CPU: sums and softmax in few array steps, with the same results."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tillbook.llm import maxent


@pytest.fixture
def model():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 1023).astype(np.uint64)
    rare = np.full(maxent.CLASSES, 10.0)
    start = maxent.Model.start(maxent.Corpus(5000, 1100, 7, keys, np.arange(1023, 0, -1.0), rare, rare))
    weights = (x + rng.normal(size=x.shape).astype(np.float32) for x in (start.classes, start.within))
    return maxent.Model(start.corpus, *weights)


def _examples(n):
    rng = np.random.default_rng(4)
    return np.minimum(rng.zipf(1.3, (n, 5)) - 1, maxent.NOTHING - 1).astype("<u2")


def test_slopes_equal_those_of_plain_softmax(model):
    examples = _examples(3000)
    rows = maxent.features(examples[:, :4].astype(np.int64))
    target = examples[:, 4].astype(np.int64)
    common = target < maxent.FREQUENT
    of_class = np.where(common, target // maxent.WIDTH, target - maxent.FREQUENT + maxent.CLASSES)
    inner = maxent.within_rows(rows[common], of_class[common])
    found = maxent.gradient(model, examples)
    parts = ((model.classes, rows, of_class), (model.within, inner, target[common] % maxent.WIDTH))
    for slope, (weights, its_rows, own) in zip(found, parts, strict=True):
        scores = weights.astype(np.float64)[its_rows].sum(axis=1)
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        wanted = np.zeros(weights.shape)
        np.add.at(wanted, its_rows, (np.eye(weights.shape[1])[own] - p)[:, None])
        assert np.allclose(slope, wanted, atol=2e-3)
        log_p = maxent._log_softmax_at(maxent._factors(weights), its_rows, own)
        assert np.allclose(log_p, np.log(p[np.arange(len(own)), own]), atol=1e-4)


def test_exponentials_do_not_grow_with_examples(model, monkeypatch):
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, *args, **more: taken.append(np.size(x)) or exp(x, *args, **more))
    maxent.gradient(model, _examples(50_000))
    assert sum(taken) <= model.classes.size + model.within.size


def test_steps_do_not_grow_with_rows_named_often(monkeypatch):
    rows = np.random.default_rng(5).integers(0, 300, (maxent.BATCH, 3))  # each about 330 times
    slope, steps, take = np.ones((len(rows), 4), np.float32), [], np.take
    monkeypatch.setattr(np, "take", lambda *args, **more: steps.append(1) or take(*args, **more))
    found = np.zeros((300, 4), np.float32)
    maxent._add(found, rows, slope)
    assert (found == np.bincount(rows.ravel(), minlength=300)[:, None]).all()
    assert len(steps) < 150


def test_runs_of_all_lengths_add_up():
    rng = np.random.default_rng(6)
    run = maxent.RUN
    size = np.array([1, 2, run - 1, run, run + 1, 2 * run, run**2 - 1, run**2, run**2 + 1, 5 * run**2, 1])
    first = np.cumsum(size) - size
    values, source = rng.integers(-9, 9, (700, 3)).astype(np.float32), rng.integers(0, 700, size.sum())
    wanted = [values[source[a : a + n]].sum(axis=0) for a, n in zip(first, size, strict=True)]
    assert (maxent._run_sums(values, source, first, size) == wanted).all()


def test_weights_moved_as_far_as_they_can_stay_finite(model):
    start = maxent.Model.start(model.corpus)
    most = maxent.RATE * maxent.EPOCHS * maxent.PARTS
    weights = [np.where(np.arange(x.shape[1]) % 2, x + most, x - most).astype(np.float32) for x in (start.classes, start.within)]
    big = np.log(np.array([1e12, 0.5] * maxent.CLASSES)).astype(np.float32)
    weights[0][0] = big + np.where(np.arange(len(big)) % 2, -most, most)
    extreme = maxent.Model(start.corpus, *weights)
    examples = _examples(2000)
    assert all(np.isfinite(x).all() for x in maxent.gradient(extreme, examples))
    history, symbols = examples[:, :4].astype(np.int64), examples[:, 4].astype(np.int64)
    assert np.isfinite(maxent.log_probabilities(extreme, history, symbols, np.ones(len(symbols)))).all()


def test_words_are_those_of_bytes_split():
    rng = random.Random(8)
    letters = ["a", "B", "Z", "é", "İ", "\x00", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "　", "😀"]
    for _ in range(300):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices(letters, k=rng.randrange(12))) for _ in range(5)]
        found = maxent.Tokens.of(pa.chunked_array([pa.array(texts[:2], pa.string()), pa.array(texts[2:], pa.string())]))
        words = [(text or "").encode().lower().split() for text in texts]
        assert found.bounds.tolist() == np.cumsum([0, *map(len, words)]).tolist()
        hashes = [xxhash.xxh64_intdigest(w) >> 4 for own in words for w in own]
        assert (found.keys[found.tokens] & maxent._HASH).tolist() == hashes
        assert len(found.keys) == len({w for own in words for w in own})

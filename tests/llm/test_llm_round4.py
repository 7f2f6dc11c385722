"""Findings of round 3 on the language model."""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

from tillbook.llm import maxent


def test_words_are_numbered_once_a_chunk(spark):
    texts = {1: "A b  c a", 2: None, 3: "", None: "b d\tD é", 5: "a" * 40}
    rows = [(i, text, i is not None) for i, text in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learns boolean").selectExpr("0L AS chunk", "*")
    found = maxent._tokenized(docs).toArrow()
    tokens, ids, learns = maxent._tokens_in(found, 0)
    assert found.num_rows == 1 and dict(zip(ids.to_pylist(), learns.tolist(), strict=True)) == {i: i is not None for i in texts}
    assert (np.diff(tokens.keys.view(np.uint64)) > 0).all()
    for k, i in enumerate(ids.to_pylist()):
        words = (texts[i] or "").encode().lower().split()
        own = tokens.keys[tokens.tokens[tokens.bounds[k] : tokens.bounds[k + 1]]]
        assert own.tolist() == [xxhash.xxh64_intdigest(w) >> 4 | (zlib.crc32(w[-2:]) & 15) << 60 for w in words]


def test_slopes_are_added_to_those_there():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 1023).astype(np.uint64)
    rare = np.full(maxent.CLASSES, 10.0)
    model = maxent.Model.start(maxent.Corpus(5000, 1100, 7, keys, np.arange(1023, 0, -1.0), rare, rare))
    examples = rng.integers(0, maxent.NOTHING, (500, 5)).astype("<u2")
    whole = maxent.gradient(model, examples)
    total = maxent.gradient(model, examples[:200])
    maxent.add_gradient(*total, model, examples[200:])
    assert all(np.allclose(a, b, atol=1e-3) for a, b in zip(total, whole, strict=True))
    assert abs(whole[0].sum()) < 0.1  # what happened less what was expected

"""The rule cascade, whitening and the manifest against brute force, and on odd and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import feast, merkle, rules, whitening
from tillbook.llm.rules import Rule

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, base int, words int"
LINE = "the same eight words again and again here"
ROWS = [
    (1, "One Text about nothing much. " * 3, "en", "a", 87),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "word " * 30_000, "en", "b", 150_000),
    (5, "ÄÖ Ünit words, with a tail", "en", "b", 26),
    (5, "ÄÖ Ünit words, with a tail", "en", "b", 26),
    (6, " \t\n\x0b", "de", "c", 4),
    (None, f"{LINE}\nsome other line of words\n{LINE}\n\n \n{LINE}", "fr", "a", 1),
    (None, "no id here", None, "a", 10),
    (7, "a b c d e f g h a b c d e f g h i", "", "a", None),
    (10, "| x | y | z " * 9, "é", "a", 3),
    (11, "Fine words of a plain text that goes on for more than twenty words, so that no rule on length says a thing about it.", "en", "z", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, "t", 5, 6, 7) for row in ROWS], DOCS)


def counts(text):
    text = text or ""
    words = [word for word in re.split("[\x20\x09-\x0d]+", text) if word]
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(8)}
    symbols = len(re.findall("[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_and_base_rules(docs):
    found = rules.verdicts(docs).collect()
    assert sorted(map(repr, (tuple(row)[1:6] for row in found))) == sorted(repr(counts(row[1])) for row in ROWS)
    for row in found:
        assert row["base_failed"] == (row["n_words"] < 20 or 100 * row["n_repeat_words"] > 30 * row["n_words"])
        assert not (row["kept"] and row["base_failed"])
    assert [row["doc_id"] for row in found if row["kept"]] == [11]


def test_accepted_agrees_with_verdicts(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("row", F.lit(1))
    kept = {row["doc_id"] for row in rules.verdicts(table).filter("kept").collect()}
    accepted = rules.accepted(table)
    assert accepted.columns == table.columns
    assert {row["doc_id"] for row in accepted.collect()} == kept and 0 < len(kept) < table.count()


def test_order_of_the_cascade():
    of = lambda name, *needs: Rule(name, needs, lambda m: None)
    given = [of("dear"), of("cheap"), of("double of dear"), of("never"), of("shares", "words")]
    # dear rejects 6 of 10, cheap 4 (2 of them dear's), double the same as dear, shares 1 of its own
    patterns = {0b00000: 1, 0b00101: 4, 0b00111: 2, 0b00010: 2, 0b10000: 1}
    order = rules.ranked(given, [6.0, 1.0, 9.0, 0.5, 0.5], {"words": 8.0}, patterns)
    assert [e.rule.name for e in order] == ["cheap", "dear", "shares", "never", "double of dear"]
    assert [e.rejection for e in order][:3] == [0.4, 4 / 6, 0.5] and order[2].cost == 8.5
    assert rules.ranked(given, [1.0] * 5, {}, {})[0].rule.name == "dear"


def test_the_order_never_changes_the_verdict(docs):
    expected = {True: 1, False: len(ROWS) - 1}
    for order in (rules.RULES, rules.RULES[::-1]):
        cascade = [rules.Estimate(rule, 1.0, 0.0) for rule in order]
        kept = rules.broken_rule(cascade).isNull()
        assert {row["kept"]: row["count"] for row in docs.groupBy(kept.alias("kept")).count().collect()} == expected


def test_plans_of_the_cascade_have_no_python(docs):
    plan = rules.verdicts(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def spectrum(values, seed=0):
    turned = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    made = (turned * np.asarray(values, float)) @ turned.T
    return (made + made.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 24, 24),
        [5, 5, 5] + [1] * 13,
        [3, 2, 1] + [0] * 7,
        [1e9, *np.linspace(1, 2, 15)],
        2.0 ** -np.arange(20),
        [1.0],
        [0.0, 0.0],
    ],
)
def test_eigenpairs(spark, monkeypatch, values):
    monkeypatch.setattr(feast, "spread", lambda _, work, count: [np.ravel(work(i)) for i in range(count)])
    matrix = spectrum(values)
    expected = [value for value in sorted(values, reverse=True)[:8] if value > 0]
    found, vectors = feast.largest(spark, matrix, 8)
    assert np.allclose(found, expected, rtol=1e-7 if max(values) > 1e6 else 1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(expected)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) <= 1e-13 * max(values)


def test_inertia():
    matrix = spectrum(np.arange(-10, 11), 4)
    assert [feast.above(matrix, shift) for shift in (-11, -0.5, 0.5, 9.5, 10.5)] == [21, 11, 10, 1, 0]
    assert feast.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_whitening_against_a_full_decomposition(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = sorted(table.select("vec_id", "embedding").collect(), key=lambda row: row["vec_id"])
    x = np.floor(1024 * np.array([row["embedding"] for row in rows], np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    apart = (n * x - sums) / n
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    found = whitening.whitened(table).orderBy("vec_id", "component").collect()
    assert len(found) == 8 * n
    given = np.array([row["whitened"] for row in found]).reshape(n, 8)
    expected = apart @ vectors / np.sqrt(values)
    expected *= np.sign((expected * given).sum(axis=0))
    assert np.allclose(given, expected, rtol=1e-9, atol=1e-9)
    assert [row["deviation"] for row in found[::8]] == ((n * x - sums) ** 2).sum(axis=1).tolist()
    assert np.allclose([row["explained"] for row in found[:8]], values / np.trace(apart.T @ apart / n), rtol=1e-12)
    assert {row["n"] for row in found} == {n} and found[0]["identity_error"] < 1e-12


def test_whitening_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1e30, 0.0]), (7, [1.0, 2.0, 3.0])]
    good = [(10, [0.0, 0.0]), (11, [1.0, 0.5]), (11, [1.0, 0.5]), (12, [2.0, -1.0]), (None, [3.0, 0.25])]
    schema = "vec_id long, embedding array<double>, label int, n long, component string"
    table = spark.createDataFrame([(i, v, 0, 1, "c") for i, v in odd + good], schema)
    found = whitening.whitened(table).collect()
    assert Counter(row["vec_id"] for row in found) == {10: 2, 11: 4, 12: 2, None: 2}
    assert {row["n"] for row in found} == {5} and found[0]["identity_error"] < 1e-9
    for none in (table.limit(0), table.filter("vec_id = 11"), table.filter("vec_id < 7")):
        assert whitening.whitened(none).collect() == []


def test_deviations_beyond_a_long():
    x = np.array([[100_000, 1 << 40], [100_000, 0]])
    assert whitening.deviations(x, 2, x.sum(axis=0)) == [None, None]
    assert whitening.deviations(x[:, :1], 2, x[:, :1].sum(axis=0)) == [0, 0]
    big, sums = np.array([[1 << 41]]), np.array([0])
    assert whitening._multiples(big, 1 << 30, sums)[0, 0] == 1 << 71


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest(rows):
    """The result by plain recursion: a row's values are (doc_id, text, lang, source, n_chars)."""

    def leaf(row, text):
        values = (row[0], row[3], row[2], row[4], text)
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def built(nodes):
        paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            for start in range(0, len(nodes), 8):
                run = nodes[start : start + 8]
                for k in range(len(run)):
                    for i in members[start + k]:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            nodes, members = (
                [sha("".join(nodes[s : s + 8])) for s in range(0, len(nodes), 8)],
                [sum(members[s : s + 8], []) for s in range(0, len(nodes), 8)],
            )
        return nodes[0], paths

    trees, out = {}, []
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is None, row[0], leaf(row, row[1]), row))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    made = {}
    for name in names:
        trees[name].sort(key=lambda node: (node[0], node[1] or 0, node[2]))
        made[name] = built([node[2] for node in trees[name]])
    root, upper = built([made[name][0] for name in names])
    for name, above in zip(names, upper, strict=True):
        for (_, doc_id, own, row), path in zip(trees[name], made[name][1], strict=True):
            text, steps = row[1], path + above
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = leaf(row, text)
            for left, right in steps:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in steps))
            out.append((doc_id, own, made[name][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def test_manifest(docs):
    found = sorted((tuple(row) for row in merkle.verified(docs).collect()), key=repr)
    assert found == manifest([row[:5] for row in ROWS])


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (8, 9), (65, 1, 64), (513, 3), (1,) * 9])
def test_manifest_of_trees_of_all_heights(spark, sizes):
    rows = [(i, f"Text {i}", f"l{lang}", "s", i) for lang, n in enumerate(sizes) for i in range(lang * 1000, lang * 1000 + n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((tuple(row) for row in merkle.verified(table).collect()), key=repr) == manifest(rows)


def test_empty_tables(docs):
    assert merkle.verified(docs.limit(0)).collect() == rules.verdicts(docs.limit(0)).collect() == []
    assert rules.accepted(docs.limit(0)).collect() == []

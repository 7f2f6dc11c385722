"""Long vectors and many shards, long documents and rare languages, sites of known rates."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm import ann, embedding_dedup, language, quality


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)


def recall(spark, ids, vectors):
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)],
                                  "vec_id long, embedding array<double>")
    found: dict[int, set] = {}
    for row in ann.nearest(table).collect():
        found.setdefault(row["query_id"], set()).add(row["vec_id"])
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[at]
        best = [int(ids[k]) for k in np.lexsort((ids, -score)) if k != at][:20]
        hits, total = hits + len(found[int(ids[at])] & set(best)), total + 20
    return hits / total


@pytest.mark.parametrize("factor", [100.0, 1e4, 1e12])
def test_one_very_long_vector(spark, given, factor):
    ids, vectors = given
    vectors = vectors.copy()
    vectors[7] *= factor
    assert recall(spark, ids, vectors) >= 0.95


def test_many_shards(spark, given, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 256)
    assert recall(spark, *given) >= 0.95


@pytest.mark.parametrize("copies", [1, 25, 125])
def test_rows_sent_do_not_grow_with_the_table(spark, copies):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    noise = lambda x, k: x + (F.pmod(F.xxhash64("vec_id", "copy", k), F.lit(1000)) / 500 - 1) * 0.02
    rows = table.select((F.col("vec_id") * 1000 + F.col("copy")).alias("rep"), F.transform("embedding", noise).alias("embedding"),
                        "label", F.lit(1).cast("long").alias("copies"))
    placed = embedding_dedup._cells(rows, embedding_dedup.rotation(rows), 0.2 + 1e-6)
    sent = embedding_dedup._sent(placed).drop("embedding").groupBy("visits").count().collect()
    counts = {row["visits"]: row["count"] for row in sent}
    assert counts[False] == 2000 * copies
    assert sum(counts.values()) < 8 * counts[False]


def _text(rng, letters, words):
    return " ".join("".join(rng.choice(list(letters), rng.integers(3, 9))) for _ in range(words))


def test_long_documents_are_learned_from(spark):
    rng = np.random.default_rng(3)
    languages = {"aa": "abcdefg", "bb": "stuvwxyz"}
    rows = [(k, _text(rng, languages[lang], 40_000), lang) for k in range(24) for lang in [("aa", "bb")[k % 2]]]
    rows += [(100 + k, _text(rng, letters, 30), None) for k, letters in enumerate(languages.values())]
    assert len(rows[0][1]) > 200_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    found = {row["doc_id"]: row["lang_pred"] for row in language.predictions(docs).collect()}
    assert found == {**{k: ("aa", "bb")[k % 2] for k in range(24)}, 100: "aa", 101: "bb"}


def test_a_language_of_one_document_in_thousands(spark):
    rng = np.random.default_rng(4)
    rows = [(k, _text(rng, "abcdefg", 12), "aa") for k in range(12_000)]
    learned = [k for k in range(12_000, 12_020) if k not in _held_out(spark, range(12_000, 12_020))][:3]
    rows += [(k, _text(rng, "stuvwxyz", 60), "nl") for k in learned]
    rows += [(20_000 + k, _text(rng, "stuvwxyz", 30), None) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    found = language.predictions(docs).filter("doc_id >= 12000").collect()
    assert {row["lang_pred"] for row in found} == {"nl"}
    assert len(found) == 8


def _held_out(spark, ids):
    rows = spark.createDataFrame([(k,) for k in ids], "doc_id long")
    return {r[0] for r in rows.filter(language.fold("doc_id", language.FOLDS) == language.HELD_OUT).collect()}


def test_the_sample_is_bounded():
    sizes = {f"l{k}": (1, 100) for k in range(500)} | {"big": (10**9, 10**13)}
    shares = language._shares(sizes)
    pieces = sum(n * shares[lang] / (1 << 30) for lang, (n, _) in sizes.items())
    assert pieces <= 2 * language.MOST_PIECES
    assert language._shares({}) == {}


def test_traits_see_a_whole_word():
    start = "abcd" * 10
    assert set(language.traits(start + "xyzxyz" + "abc")) - set(language.traits(start + "abc"))


def test_scoring_finds_the_marginals():
    rng = np.random.default_rng(5)
    emissions, lengths = rng.random((6, 4, 3)).astype(np.float32) + 0.01, np.array([6, 5, 3, 1])
    field = language.Field(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)))
    tagger = language.Tagger(field)
    wanted = language.marginals(emissions.copy(), np.exp(field.transitions), lengths)
    found = tagger.backwards(emissions.copy(), lengths)
    for (t, one, _), (at, other, _) in zip(wanted, found, strict=True):
        assert t == at and np.allclose(one, other, atol=1e-5)


def _sites(rng):
    """(host, path, log odds) of documents in hosts and paths whose rates differ."""
    rows = []
    for host in range(12):
        host_rate = rng.beta(4, 4)
        for path in range(8):
            rate = rng.beta(30 * host_rate, 30 * (1 - host_rate))
            for _ in range(int(rng.integers(1, 120))):
                odds = 4.0 if rng.random() < rate else -4.0
                rows.append((f"h{host}", f"p{path}", odds + float(rng.normal())))
    return rows


def test_site_posteriors_against_the_closed_form(spark):
    rows = _sites(np.random.default_rng(6))
    scored = spark.createDataFrame(rows, "host string, path string, text_log_odds double")
    sites, prior = quality.counted(scored)
    good = 1 / (1 + np.exp(-np.array([r[2] for r in rows])))
    hosts, paths = np.array([r[0] for r in rows]), np.array([r[0] + r[1] for r in rows])
    rate = good.mean()

    def moments(groups, parents):
        beyond = whole = 0.0
        for parent in set(parents):
            own, inside = groups[parents == parent], good[parents == parent]
            m, counts = inside.mean(), np.array([(own == g).sum() for g in set(own)])
            rates = np.array([inside[own == g].mean() for g in set(own)])
            beyond += (counts * (rates - m) ** 2).sum() - m * (1 - m) * (len(counts) - 1)
            whole += m * (1 - m) * (counts.sum() - (counts**2).sum() / counts.sum() - len(counts) + 1)
        return whole / beyond - 1

    assert prior.rate == pytest.approx(rate)
    assert prior.host_strength == pytest.approx(moments(hosts, np.zeros(len(hosts))), rel=1e-6)
    assert prior.path_strength == pytest.approx(moments(paths, hosts), rel=1e-6)
    found = {(r["host"], r["path"], r["text_log_odds"]): r for r in quality.sited(scored, sites, prior).collect()}
    for (host, path, odds), own in zip(rows, good, strict=True):
        of_host, of_path = good[hosts == host], good[paths == host + path]
        host_rate = (of_host.sum() - own + prior.host_strength * rate) / (len(of_host) - 1 + prior.host_strength)
        p = (of_path.sum() - own + prior.path_strength * host_rate) / (len(of_path) - 1 + prior.path_strength)
        shift = np.clip(np.log(p / (1 - p)) - np.log(rate / (1 - rate)), -quality.SITE_LIMIT, quality.SITE_LIMIT)
        row = found[host, path, odds]
        assert row["site_log_odds"] == pytest.approx(shift, abs=1e-9)
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-odds - shift)))


def test_strength_of_planted_paths(spark):
    """Paths drawn around their host with a strength of 30, hosts far apart: hosts do not count as spread of paths."""
    rng, found = np.random.default_rng(7), []
    for host in range(300):
        host_rate = 0.15 if host % 2 else 0.85
        for path in range(10):
            n = int(rng.integers(20, 200))
            found.append((host, path, float(n), float(rng.binomial(n, rng.beta(30 * host_rate, 30 * (1 - host_rate))))))
    paths = spark.createDataFrame(found, "host int, path int, n double, good double")
    assert quality.strength(paths, "host") == pytest.approx(30, rel=0.25)
    assert quality.strength(paths) < 3
    level = spark.createDataFrame([(1, 10.0, 5.0), (2, 20.0, 10.0)], "path int, n double, good double")
    assert quality.strength(level) == quality.strength(level.limit(0)) == quality.MOST_STRENGTH


def test_the_site_decides_where_the_text_does_not(spark):
    """Fails without the site's term: texts that say nothing go by the other documents of their site."""
    rows = [(host, "p", sign * 3.0) for host, sign in (("good", 1), ("bad", -1)) for _ in range(200)]
    unsure = [("good", "p", -0.2), ("bad", "p", 0.2), ("alone", "p", 0.2), (None, "p", -0.2)]
    rows = [(host or "\0", path, odds) for host, path, odds in rows + unsure]
    scored = spark.createDataFrame(rows, "host string, path string, text_log_odds double")
    found = quality.sited(scored, *quality.counted(scored)).filter(F.abs("text_log_odds") < 1).collect()
    kept = {row["host"]: row["score"] >= quality.THRESHOLD for row in found}
    assert kept == {"good": True, "bad": False, "alone": True, "\0": False}
    alone = next(row for row in found if row["host"] == "alone")
    assert alone["site_log_odds"] == pytest.approx(0.0, abs=0.05)

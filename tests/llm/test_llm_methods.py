"""Operators against brute force on small inputs."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillbook.llm import (
    ann,
    curriculum,
    embedding_dedup,
    language,
    maxent,
    packing,
    passages,
    simhash,
    toxicity,
)
from tillbook.llm.components import components
from tillbook.llm.queries import QUERIES
from tillbook.llm.suffix_groups import suffix_order

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(3000):
        text = [rng.randint(0, rng.choice((1, 2, 4))) for _ in range(rng.randint(0, 14))]
        assert suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(rows):
    """(n_bytes, n_removed, n_spans, digest) of each document by the rule itself."""
    docs, first, out = sorted((i, (t or "").encode()) for i, t in rows), {}, {}
    for i, b in docs:
        for s in range(len(b) - 49):
            first.setdefault(b[s : s + 50], i)
    for i, b in docs:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < i:
                gone[s : s + 50] = True
        kept = bytes(x for x, g in zip(b, gone[:-1], strict=True) if not g)
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-1]))[:-1]).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [2048, 2])
def test_passages_against_the_rule(docs, monkeypatch, most):
    monkeypatch.setattr(passages, "MOST_CONTEXTS", most)
    monkeypatch.setattr(passages, "PART_BYTES", 700)
    found = {row["doc_id"]: tuple(row)[1:] for row in passages.repeated_bytes(docs.select("doc_id", "text")).collect()}
    assert found == removed([(row["doc_id"], row["text"]) for row in docs.collect()])


def test_passages_of_copies_in_other_slices(spark):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows, slices = [], [[] for _ in range(12)]
    for k in range(24):
        passage = word(150)
        texts = sorted((word(90) + passage + word(70), word(60) + passage + word(110)), key=lambda t: passages.text_hash(t.encode()))
        # b in a slice of its own, its near-copy c and another copy of it together: b < c < a
        b, c, a = ((k * 10 + i, texts[t]) for i, t in ((1, 0), (2, 1), (3, 0)))
        rows += [b, c, a]
        slices[k % 6].append(b)
        slices[6 + k % 6] += [c, a]
    parts = spark.sparkContext.parallelize(slices, len(slices)).flatMap(lambda x: x)
    found = passages.repeated_bytes(spark.createDataFrame(parts, "doc_id long, text string"))
    assert {row["doc_id"]: tuple(row)[1:] for row in found.collect()} == removed(rows)


def test_golay_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**63, 500, dtype=np.int64)
    other = one.copy()
    for k in range(len(one)):
        for bit in rng.choice(64, rng.integers(0, 3), replace=False):
            other[k] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
    keys = [[set() for _ in one] for _ in range(2)]
    for sets, prints in zip(keys, (one, other), strict=True):
        for row, key in zip(*simhash.keys(prints), strict=True):
            sets[row].add(key)
    assert all(a & b for a, b in zip(*keys, strict=True))


def linked(ids, near):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if near(a, b):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_components(docs):
    rows = simhash.near_duplicates(docs).collect()
    bits = {row["doc_id"]: int(row["fingerprint"], 16) for row in rows}
    expected = linked(sorted(bits), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 2)
    assert {row["doc_id"]: row["component_id"] for row in rows} == expected
    kept = simhash.one_of_each(docs).collect()
    assert sorted(row["doc_id"] for row in kept) == sorted(set(expected.values()))


def test_tiles_of_a_crowded_key(docs, monkeypatch, spark):
    monkeypatch.setattr(simhash, "TILE", 2)
    bits = [0] + [1 << k for k in range(40)]
    prints = spark.createDataFrame([(x,) for x in bits], "print long")
    roots = {row["node"]: row["root"] for row in components(simhash._links(prints, 2)).collect()}
    assert set(roots) == set(bits) and set(roots.values()) == {0}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    found = {row["node"]: row["root"] for row in components(edges).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}


@pytest.mark.parametrize(("rows", "pairs"), [(8, 1 << 17), (64, 100), (16, 50)])
def test_embedding_links(spark, monkeypatch, rows, pairs):
    # a grid of two coordinates, none, and one; with slices of all, one or three rows
    monkeypatch.setattr(embedding_dedup, "TILE", rows)
    monkeypatch.setattr(embedding_dedup, "MOST_TILE", rows)
    monkeypatch.setattr(embedding_dedup, "PAIRS", pairs)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    vectors = centres[rng.integers(0, 6, 120)] + rng.normal(size=(120, 16)) * rng.choice([0.02, 0.2], (120, 1))
    rows = [(k, [float(np.float32(x)) for x in v], k % 2) for k, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    exact = np.array([row[1] for row in rows])
    unit = exact / np.linalg.norm(exact, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(120)[:, None] % 2 == np.arange(120) % 2)
    found = {row["vec_id"]: row for row in embedding_dedup.near_duplicates(table).collect()}
    assert [found[k]["n_links"] for k in range(120)] == (near.sum(axis=1) - 1).tolist()
    assert {k: row["component_id"] for k, row in found.items()} == linked(range(120), lambda a, b: near[a, b])


def test_nearest_neighbours(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    found = ann.nearest(table).collect()
    hits = total = 0
    for query in ids[ids % 20 == 0]:
        own = sorted((row for row in found if row["query_id"] == query), key=lambda row: row["rank"])
        score = vectors @ vectors[ids == query][0]
        best = [int(ids[k]) for k in np.lexsort((ids, -score)) if ids[k] != query][:20]
        assert [row["rank"] for row in own] == list(range(1, 21))
        assert all(row["score"] == pytest.approx(score[ids == row["vec_id"]][0]) for row in own)
        hits, total = hits + len({row["vec_id"] for row in own} & set(best)), total + 20
    assert hits / total >= 0.9


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(4)
    for most in (1025, 600, 40):
        lengths = rng.integers(1, most, 3000)
        used: Counter = Counter()
        patterns = packing.plan(np.bincount(lengths, minlength=1025))
        for pattern, times in patterns:
            assert sum(pattern) <= 1024
            used.update({x: n * times for x, n in Counter(pattern).items()})
        assert used == Counter(lengths.tolist())
        sequences = sum(times for _, times in patterns)
        assert sequences <= -(-lengths.sum() // 1024) * 1.03 + 1


def test_packing_round_trip(docs):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = packing.best_fit(docs.select("doc_id", "text")).collect()
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
    place: dict[int, list] = {}
    for row in rows:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert len(part) == row["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == row["ids_crc32"]
        place.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert Counter({i: sum(r["length"] for r in rows if r["doc_id"] == i) for i in ids}) == Counter(
        {i: len(x) for i, x in ids.items()}
    )
    for parts in place.values():
        ends = list(itertools.accumulate(length for _, length in sorted(parts)))
        assert [at for at, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


@pytest.mark.parametrize("text", ["a  b\n\n c\t", "it's 12,5 €  –  café", "", "x <|endoftext|> y", "日本語 テキスト   z"])
def test_tokens_are_those_of_the_tokenizer(text):
    full = Tokenizer.from_file(packing.TOKENIZER).encode(text, add_special_tokens=False).ids
    assert packing.token_ids(text) == [*full, 2]


def test_times_invert_the_schedule(spark):
    for schedule in curriculum.SCHEDULES:
        shares = spark.range(0, 21).select((F.col("id") / 20).alias("share"))
        times = [r[0] for r in shares.select(curriculum.time_of(F.col("share"), schedule)).collect()]
        grid = np.linspace(0, 1, 20_001)
        weight = np.interp(grid, *zip(*schedule, strict=True))
        passed = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2)))
        assert np.allclose(np.interp(times, grid, passed / passed[-1]), np.arange(21) / 20, atol=1e-4)


def test_targets_stop_at_three_times_the_size(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 0)], "source string, source_size long")
    found = {row["source"]: row["target"] for row in curriculum.targets(sizes).collect()}
    assert found["a"] == 30 and found["b"] == 300 and found["c"] == pytest.approx(780) and found[None] == 0


def test_curriculum_delivers_what_the_mix_takes(docs):
    taken = {row["doc_id"]: (row["size"], row["taken"]) for row in curriculum.taken(docs).collect()}
    times = Counter(row["doc_id"] for row in curriculum.curriculum(docs).collect())
    assert all(taken[i][0] * n == taken[i][1] for i, n in times.items())


def test_mixing_query_gives_the_training_order(spark, docs):
    found = QUERIES["op6_mixing"](spark, SMALL).collect()
    plain = ("doc_id", "size", "source_size", "target", "taken")
    assert sorted(tuple(r[c] for c in plain) for r in found) == sorted(tuple(r) for r in curriculum.taken(docs).collect())
    assert all(r["size"] * len(r["positions"]) == r["taken"] and len(r["times"]) == len(r["positions"]) for r in found)
    placed = sorted((at, time, r["doc_id"]) for r in found for at, time in zip(r["positions"], r["times"], strict=True))
    assert [at for at, _, _ in placed] == list(range(1, len(placed) + 1))
    assert [time for _, time, _ in placed] == sorted(time for _, time, _ in placed)
    assert [i for _, _, i in placed] == [r["doc_id"] for r in curriculum.curriculum(docs).collect()]


def test_mixing_of_odd_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (None, "d e", "y"), (3, "", "z"), (4, "f " * 9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = curriculum.delivered(docs).collect()
    text = lambda values: sorted(map(repr, values))
    assert text(tuple(r)[:5] for r in found) == text(tuple(r) for r in curriculum.taken(docs).collect())
    placed = sorted((at, r["doc_id"]) for r in found for at in r["positions"])
    assert [at for at, _ in placed] == list(range(1, len(placed) + 1))
    assert [i for _, i in placed] == [r["doc_id"] for r in curriculum.curriculum(docs).collect()]
    assert curriculum.delivered(docs.limit(0)).collect() == []


def test_marginals_against_all_paths():
    rng = np.random.default_rng(0)
    emissions, move = rng.random((5, 3, 3)).astype(np.float32), rng.random((3, 3)).astype(np.float32)
    lengths = np.array([5, 4, 2])
    found = np.zeros((5, 3, 3))
    for t, probability, _ in language.marginals(emissions, move, lengths):
        found[t, : len(probability)] = probability
    for chain, n in enumerate(lengths):
        expected = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.prod([emissions[t, chain, x] for t, x in enumerate(path)])
            weight *= np.prod([move[a, b] for a, b in itertools.pairwise(path)])
            expected[range(n), path] += weight
        assert np.allclose(expected / expected.sum(axis=1, keepdims=True), found[:n, chain], atol=1e-4)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = found.agg(F.avg(F.expr("int(lang = lang_pred)"))).first()[0]
    assert right >= 0.97


def test_base_scores_and_better_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {row["doc_id"]: row for row in maxent.scores(docs).collect()}
    words = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), None] for r in docs.collect()}
    learned = {i for i in words if zlib.crc32(str(i).encode()) % 5 != 1}
    counts = Counter(w for i in learned for w in words[i])
    tokens, level = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for i, own in words.items():
        base = sum(np.log10((counts[w] + 0.5) / level) for w in own)
        assert rows[i]["base_score"] == pytest.approx(base, rel=1e-9) and rows[i]["train_tokens"] == tokens
        assert rows[i]["n_known"] == sum(counts[w] > 0 for w in own) and rows[i]["n_tokens"] == len(own)
    held_out = [row for row in rows.values() if row["held_out"]]
    assert sum(row["score"] for row in held_out) > sum(row["base_score"] for row in held_out)


def test_every_position_is_an_example(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choices(["a", "b", "c", "d", "rare", "words"], k=n)) for n in (0, 1, 3, 63, 64, 65, 500)]
    rows = [(i, text, True) for i, text in enumerate([*texts, None])] + [(99, "left out", False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learns boolean")
    keys = np.array([maxent.word_key(w) for w in (b"a", b"b", b"c", b"d")], np.uint64)
    none = np.zeros(maxent.CLASSES)
    corpus = maxent.Corpus(700, 7, 8, keys, np.ones(4), none, none)
    found = Counter()
    for row in maxent._examples(docs, corpus).collect():
        found.update(map(tuple, maxent.examples_in(row["examples"]).tolist()))
    wanted = Counter()
    for _, text, learns in rows:
        words = np.array([maxent.word_key(w) for w in (text or "").encode().split()], np.uint64)
        own = [*[maxent.NOTHING] * 4, *corpus.symbols(words).tolist(), 0]
        wanted.update((*own[k - 4 : k][::-1], own[k]) for k in range(4, len(own) if learns else 0))
    assert found == wanted


def test_slopes_add_up_by_row():
    rng = np.random.default_rng(2)
    rows, slope = rng.integers(0, 40, (300, 5)), rng.random((300, 8)).astype(np.float32)
    found, wanted = np.zeros((64, 8), np.float32), np.zeros((64, 8))
    maxent._add(found, rows, slope)
    np.add.at(wanted, rows.ravel(), np.repeat(slope, 5, axis=0))
    assert np.allclose(found, wanted, atol=1e-3)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 1023).astype(np.uint64)
    rare = np.full(maxent.CLASSES, 10.0)
    corpus = maxent.Corpus(5000, 1100, 7, keys, np.arange(1023, 0, -1.0), rare, np.full(maxent.CLASSES, 4.0))
    model = maxent.Model.start(corpus)
    model = maxent.Model(corpus, model.classes + rng.normal(size=model.classes.shape).astype(np.float32), model.within)
    symbols = np.arange(maxent.FREQUENT)
    history = np.broadcast_to(np.array([3, 5, maxent.NOTHING, maxent.NOTHING]), (len(symbols), 4))
    common = 10 ** maxent.log_probabilities(model, history, symbols, np.zeros(len(symbols)))
    classes = np.arange(maxent.CLASSES) + maxent.FREQUENT
    # four known words of 2.5 each and one unknown stand for a rare class
    shares = [10 ** maxent.log_probabilities(model, history[:16], classes, np.full(16, n)) for n in (2.5, 0.0)]
    assert common.sum() + (4 * shares[0] + shares[1]).sum() == pytest.approx(1, abs=1e-4)


def test_grammar_weighs_clauses():
    def score(text):
        return sum(toxicity.clause_scores(text, toxicity.Lexicon({}), toxicity.Composed()))

    assert score("what a fine day") == 0
    assert score("you are an idiot") > score("some idiot was there") > score("he is not an idiot") > 0
    assert score("she said an idiot was there") < score("some idiot was there")
    assert score("I will kill you") > score("to kill time")
    assert score("not here. idiot") == score("idiot")


def test_insults_by_support_in_a_large_sample(spark):
    # in 8 of 4,000 toxic documents, 0.2% of them
    text = F.when((F.col("id") % 2 == 1) & (F.col("id") < 16), "what a zorgblat").otherwise("some words")
    rows = spark.range(8000).select(text.alias("text"), (F.col("id") % 2).cast("int").alias("toxic"))
    found = toxicity._learn_insults(rows)
    assert "zorgblat$" in found and "some$" not in found


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.scores(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id")
    right = found.filter("held_out").agg(F.avg(F.expr("int(toxic = predicted)"))).first()[0]
    assert right >= 0.96

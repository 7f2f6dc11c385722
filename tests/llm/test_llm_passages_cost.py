"""What the suffix sort of op10_passages is given, and what comes of it."""

from __future__ import annotations

import numpy as np
import pytest

from tillbook.llm import passages
from tillbook.llm.suffix_groups import suffix_order

SIDE = passages.SPAN - 1


@pytest.fixture
def sorted_symbols(monkeypatch):
    """Numbers of symbols that were sorted."""
    sizes = []

    def counted(text):
        sizes.append(len(text))
        return suffix_order(text)

    monkeypatch.setattr(passages, "suffix_order", counted)
    return sizes


def solved(groups):
    """(document, place) of each window that goes."""
    settled = passages._Settled(7)
    for entries in groups:
        settled.group(entries)
    settled.solve()
    rows = np.concatenate([np.zeros((3, 0), np.int64), *settled.covered], axis=1)
    return sorted((doc, place + k) for doc, place, windows in rows.T.tolist() for k in range(windows))


def by_the_rule(groups):
    gone = []
    for entries in groups:
        found = {}
        for context, doc, places in entries:
            left, body = context[4], context[5:]
            for k in range(len(body) - SIDE + 1):
                found.setdefault((left - k, body[k : k + SIDE]), []).extend((doc, place + k) for place in places)
        for rows in found.values():
            gone += [row for row in rows if row[0] > min(rows)[0]]
    return sorted(gone)


def context(before, after):
    return b"hash" + bytes((len(before),)) + before + after


def groups_of(seed, letters, count):
    rng = np.random.default_rng(seed)
    some = lambda n: bytes(rng.choice(letters, n).astype(np.uint8))
    for number in range(count):
        sides = [(some(SIDE), some(SIDE)) for _ in range(3)]
        entries = {}
        for _ in range(rng.integers(2, 9)):
            before, after = sides[rng.integers(3)][0], sides[rng.integers(3)][1]
            cut = rng.integers(0, SIDE, 2)
            before = some(cut[0]) + before[cut[0] :] if rng.random() < 0.5 else before[rng.integers(SIDE + 1) :]
            after = after[: cut[1]] + some(SIDE - cut[1]) if rng.random() < 0.5 else after[: rng.integers(SIDE - len(before), SIDE + 1)]
            if len(before) + len(after) >= SIDE:
                doc = int(rng.integers(0, 5))
                entries.setdefault(context(before, after), (doc, [1000 * number + 10_000_000 * doc + 100 * len(entries)]))
        yield [[text, doc, places] for text, (doc, places) in sorted(entries.items())]


@pytest.mark.parametrize("letters", [[0, 1], [0, 97, 255], list(range(256))], ids=["two", "three", "all"])
def test_windows_of_blocks_against_the_rule(letters, sorted_symbols):
    groups = list(groups_of(len(letters), letters, 400))
    assert (expected := by_the_rule(groups))
    assert solved(groups) == expected
    assert 0 < sum(sorted_symbols) < sum(len(text) - 3 for group in groups if len(group) > 1 for text, _, _ in group)


def test_contexts_without_a_window_in_common_are_not_sorted(sorted_symbols):
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 123, 2 * SIDE).astype(np.uint8))
    before, after = text[:SIDE], text[SIDE:]
    # ten bytes before the anchor and eleven behind it are one too few
    alike = context(before[:-11] + b"-" + before[-10:], after[:11] + b"-" + after[12:])
    assert solved([[[context(before, after), 1, [5]], [alike, 2, [70]]]]) == []
    assert sum(sorted_symbols) == 0
    # one more on either side: these alone are sorted, with the anchor and an end
    alike = context(before[:-12] + b"-" + before[-11:], after[:11] + b"-" + after[12:])
    assert solved([[[context(before, after), 1, [5]], [alike, 2, [70]]]]) == [(2, 70 + SIDE - 11)]
    assert sum(sorted_symbols) == 2 * (SIDE + 2)


def test_anchors_against_the_rule():
    rng = np.random.default_rng(5)
    for _ in range(30):
        sizes = rng.choice([0, 1, passages.GRAM, passages.LENGTH - 1, passages.LENGTH, 51, 90, 400], rng.integers(1, 8))
        bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        data = rng.integers(97, 97 + rng.choice([1, 2, 26]), bounds[-1]).astype(np.uint8)
        expected = []
        for text, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            hashes = passages.gram_hashes(data[begin:end]) if end - begin >= passages.LENGTH else []
            for k in range(len(hashes) - passages.SPAN + 1):
                at = k + int(hashes[k : k + passages.SPAN].argmin())
                expected.append((begin + k, text, begin + at, int(hashes[at])))
        found = passages.anchors(data, bounds)
        windows = [
            (start, text, at, least)
            for text, low, high, at, least in zip(*(x.tolist() for x in found), strict=True)
            for start in range(low, high)
        ]
        assert windows == expected

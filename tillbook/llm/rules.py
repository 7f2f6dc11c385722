"""Quality rules as a cascade that stops at the first rule a document breaks.

On a bounded sample each rule is timed by itself, and one aggregation counts which rules reject which documents. The
cascade then takes, again and again, the rule that rejects the most of what is left per second; what it rejects is not
shown to dearer rules. The order decides how long it takes, never which documents stay: they break no rule at all.

All is made of native column expressions. A measure is one expression from the text: its words are bound once by a
``transform`` over a one-element array, so a rule behind others costs nothing for the documents those reject.

Defined results: a null, empty or blank text has no words and all its counts are 0, so it breaks the rule on length. Long
texts are judged as a whole. Repeated rows and rows without an id are judged alike, each by itself. An empty table gives
no rows; its rules stay in the order given. Further columns are ignored by ``verdicts`` and kept by ``accepted``.

Windows of words are compared by xxhash64 inside one text; two different ones of a text of a million words share a hash
with a probability of less than one in ten million.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import sample_below, stored

#: Documents on which rules are timed and counted.
SAMPLE = 1_000

#: Times that a rule is timed on the sample; the shortest counts.
ROUNDS = 2

WINDOW = 8

#: White space that parts words; a word is a run of anything else.
BLANKS = " \t\n\x0b\x0c\r"

OTHERS = {"symbols": "[^#*$%&|<>]+", "letters": r"\P{L}+", "capitals": r"\P{Lu}+", "marks": "[^!?]+"}
ELLIPSES = ("...", "…")
BULLETS = ("- ", "• ", "* ")

Measures = Mapping[str, Column]


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words; a split, which is faster than extracting matches, leaves empty ones at both ends."""
    parts = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def lines(text: Column) -> Column:
    """Lines that have a word."""
    found = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "")
    return F.coalesce(found, F.array().cast("array<string>"))


def characters(text: Column, kind: str) -> Column:
    """How many characters of a kind: what is left without the long runs of all others."""
    return F.coalesce(F.length(F.regexp_replace(text, OTHERS[kind], "")), F.lit(0)).cast("long")


def repeated(items: Column) -> Column:
    """How many items equal an earlier one."""
    return (F.size(items) - F.size(F.array_distinct(items))).cast("long")


def _covered(starts: Column) -> Column:
    """How many places the windows at these ascending places cover."""
    widths = F.transform(starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW))))
    return F.aggregate(widths, F.lit(0).cast("long"), lambda total, width: total + width)


def _twice(hashes: Column) -> Column:
    """The ascending places of hashes that are found twice or more: equal ones are neighbours once sorted."""
    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(pairs: Column) -> Column:
        same = F.filter(
            pairs,
            lambda pair, i: (pair["h"] == F.get(pairs, i + 1)["h"])
            | ((i > 0) & (pair["h"] == F.get(pairs, F.greatest(i - 1, F.lit(0)))["h"])),
        )
        return F.sort_array(F.transform(same, lambda pair: pair["i"]))

    return bound(ranked, places)


def _window_hashes(of_words: Column) -> Column:
    """A hash for each window of ``WINDOW`` words: hashes of neighbours are paired, then those of pairs, and so on."""

    def paired(hashes: Column, apart: int) -> Column:
        return bound(hashes, lambda h: F.zip_with(h, F.slice(h, F.lit(1 + apart), F.size(h)), lambda a, b: F.xxhash64(a, b)))

    hashes, width = F.transform(of_words, lambda word: F.xxhash64(word)), 1
    while width < WINDOW:
        hashes, width = paired(hashes, width), 2 * width
    return F.slice(hashes, F.lit(1), F.size(of_words) - WINDOW + 1)  # the last ones lack a neighbour


def repeated_words(of_words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that the text holds twice or more. Only texts with such windows are sorted."""
    none = F.lit(0).cast("long")
    of_hashes = bound(
        _window_hashes(of_words),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), bound(_twice(h), _covered)).otherwise(none),
    )
    return F.when(F.size(of_words) > WINDOW, of_hashes).otherwise(none)


def line_counts(text: Column) -> Column:
    """Counts of the lines as one struct."""

    def starts(line: Column) -> Column:
        return reduce(Column.__or__, (F.startswith(F.ltrim(line, F.lit(BLANKS)), F.lit(mark)) for mark in BULLETS))

    def ends(line: Column) -> Column:
        return reduce(Column.__or__, (F.endswith(F.rtrim(line, F.lit(BLANKS)), F.lit(mark)) for mark in ELLIPSES))

    return bound(
        lines(text),
        lambda found: F.struct(
            F.size(found).cast("long").alias("n_lines"),
            repeated(found).alias("n_dup_lines"),
            F.size(F.filter(found, ends)).cast("long").alias("n_open_ends"),
            F.size(F.filter(found, starts)).cast("long").alias("n_bullets"),
        ),
    )


#: What several rules share: it is computed once, where the first rule that needs it is reached.
SHARED: dict[str, Callable[[Column], Column]] = {"words": words, "lines": line_counts}


def measures(text: Column, shared: Mapping[str, Column]) -> dict[str, Column]:
    """The measures that can be had from the text and from what is ``shared`` so far."""
    found = {f"n_{kind}": characters(text, kind) for kind in OTHERS}
    if "words" in shared:
        of_words = shared["words"]
        found |= {
            "n_words": F.size(of_words).cast("long"),
            "word_chars": F.length(F.array_join(of_words, "")).cast("long"),
            "n_repeat_words": repeated_words(of_words),
        }
    if "lines" in shared:
        found |= {name: shared["lines"][name] for name in ("n_lines", "n_dup_lines", "n_open_ends", "n_bullets")}
    return found


@dataclass(frozen=True)
class Rule:
    """``rejects`` says of the measures of a text whether it breaks the rule, never null; ``needs`` names what is shared."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measures], Column]


#: The base rules: by themselves they say ``base_failed``.
BASE_RULES = (
    Rule("few words", ("words",), lambda m: m["n_words"] < 20),
    Rule("repeated words", ("words",), lambda m: m["n_repeat_words"] * 100 > m["n_words"] * 30),
)

#: Limits in use for web text, wide enough for prose in any language.
RULES = (
    *BASE_RULES,
    Rule("symbols", ("words",), lambda m: m["n_symbols"] * 10 > m["n_words"]),
    Rule("repeated lines", ("lines",), lambda m: (m["n_dup_lines"] > 2) & (m["n_dup_lines"] * 10 > m["n_lines"] * 3)),
    Rule("word length", ("words",), lambda m: (m["word_chars"] < m["n_words"] * 2) | (m["word_chars"] > m["n_words"] * 15)),
    Rule("few letters", ("words",), lambda m: m["n_letters"] * 10 < m["word_chars"] * 6),
    Rule("capitals", ("words",), lambda m: m["n_capitals"] * 2 > m["word_chars"]),
    Rule("shouting", ("words",), lambda m: m["n_marks"] * 4 > m["n_words"]),
    Rule("open ends", ("lines",), lambda m: m["n_open_ends"] * 10 > m["n_lines"] * 3),
    Rule("bullets", ("lines",), lambda m: m["n_bullets"] * 10 > m["n_lines"] * 9),
)


@dataclass(frozen=True)
class Estimate:
    """A rule with its seconds a document, what it needs included, and the share it rejects of what the rules before it
    leave."""

    rule: Rule
    cost: float
    rejection: float


def ranked(
    rules: Sequence[Rule], costs: Sequence[float], shared: Mapping[str, float], patterns: Mapping[int, int]
) -> list[Estimate]:
    """Greedy order by rejection per cost among what is left. ``patterns`` counts documents by the rules they break, as bits.

    What a rule needs is paid by the first rule that needs it. Rules that reject nothing more come last, the cheapest
    first; ties go by the order given.
    """
    left, unpaid, out, waiting = dict(patterns), dict(shared), [], list(range(len(rules)))
    while waiting:
        total = sum(left.values())
        shares = {i: sum(n for bits, n in left.items() if bits >> i & 1) / total if total else 0.0 for i in waiting}
        dues = {i: costs[i] + sum(unpaid.get(name, 0.0) for name in rules[i].needs) for i in waiting}
        best = min(waiting, key=lambda i: (-shares[i] / dues[i], dues[i], i))
        out.append(Estimate(rules[best], dues[best], shares[best]))
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
        unpaid = {name: cost for name, cost in unpaid.items() if name not in rules[best].needs}
        waiting.remove(best)
    return out


def _seconds(sample: DataFrame, value: Column) -> float:
    def once() -> float:
        began = time.perf_counter()
        sample.agg(F.count_if(value)).collect()
        return time.perf_counter() - began

    return min(once() for _ in range(ROUNDS))


def estimated(sample: DataFrame, rules: Sequence[Rule], given: Measures | None = None) -> list[Estimate]:
    """The rules in the order of the cascade. ``sample`` is a bounded table, read a few times for each rule.

    ``given`` measures are columns of it. At most as many patterns as the sample has rows reach the driver.
    """
    text, known = F.col("text"), given or {}
    needed = {name for rule in rules for name in rule.needs} if given is None else set()
    apart = [_cascade([rule], text, {}, known, given is not None).isNotNull() for rule in rules]
    bits = sum((F.when(broken, 1 << i).otherwise(0).cast("long") for i, broken in enumerate(apart)), F.lit(0).cast("long"))
    patterns = {row["bits"]: row["count"] for row in sample.select(bits.alias("bits")).groupBy("bits").count().collect()}
    rows, reading = max(1, sum(patterns.values())), _seconds(sample, F.lit(True))
    shared = {name: max(_seconds(sample, bound(SHARED[name](text), Column.isNotNull)) - reading, 0.0) for name in needed}
    costs = [
        max(_seconds(sample, broken) - reading - sum(shared.get(name, 0.0) for name in rule.needs), 1e-4) / rows
        for rule, broken in zip(rules, apart, strict=True)
    ]
    return ranked(rules, costs, {name: cost / rows for name, cost in shared.items()}, patterns)


def _cascade(rules: Sequence[Rule], text: Column, shared: Mapping[str, Column], given: Measures, complete: bool) -> Column:
    """The name of the first rule a text breaks; null if it breaks none. What is behind it is not computed then."""
    if not rules:
        return F.lit(None).cast("string")
    first, later = rules[0], rules[1:]
    missing = [] if complete else [name for name in first.needs if name not in shared]
    if missing:
        rest = lambda value: _cascade(rules, text, {**shared, missing[0]: value}, given, complete)
        return bound(SHARED[missing[0]](text), rest)
    broken = first.rejects({**measures(text, shared), **given})
    return F.when(broken, first.name).otherwise(_cascade(later, text, shared, given, complete))


def broken_rule(cascade: Sequence[Estimate], given: Measures | None = None) -> Column:
    """The first rule of the cascade that the column ``text`` breaks. ``given`` are all measures that need what is shared,
    where they are columns already."""
    return _cascade([estimate.rule for estimate in cascade], F.col("text"), {}, given or {}, given is not None)


def _sampled(docs: DataFrame, most: int) -> DataFrame:
    return stored(sample_below(docs.select("doc_id", "text"), "doc_id", docs.count(), most), "rules-sample")


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _counted(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``doc_id``, ``text`` and the base counts; the columns of all measures that need words or lines."""
    text = F.col("text")
    of_words = bound(words(text), lambda found: _struct(measures(text, {"words": found}), "n_words", "word_chars", "n_repeat_words"))
    counts = docs.select(
        "doc_id",
        "text",
        of_words.alias("of_words"),
        line_counts(text).alias("of_lines"),
        characters(text, "symbols").alias("n_symbols"),
    )
    given = {name: F.col("of_words")[name] for name in ("n_words", "word_chars", "n_repeat_words")}
    given |= {name: F.col("of_lines")[name] for name in ("n_lines", "n_dup_lines", "n_open_ends", "n_bullets")}
    return counts, {**given, "n_symbols": F.col("n_symbols")}


def _struct(found: Measures, *names: str) -> Column:
    return F.struct(*(found[name].alias(name) for name in names))


def verdicts(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed`` and ``kept`` of each document.

    The counts are asked for of every document, so the rules on them cost next to nothing here; the others are
    computed only for documents that no rule before them rejects.
    """
    sample, given = _counted(_sampled(docs, sample_rows))
    cascade = estimated(stored(sample, "rules-counts"), rules, given)
    rows, _ = _counted(docs)
    base_failed = reduce(Column.__or__, (rule.rejects(given) for rule in BASE_RULES))
    return rows.select(
        "doc_id",
        *(given[name].alias(name) for name in BASE),
        base_failed.alias("base_failed"),
        F.when(base_failed, False).otherwise(broken_rule(cascade, given).isNull()).alias("kept"),
    )


def accepted(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE) -> DataFrame:
    """The documents that break no rule, with all their columns; every measure is computed only where it is needed."""
    cascade = estimated(_sampled(docs, sample_rows), rules)
    return docs.filter(broken_rule(cascade).isNull())

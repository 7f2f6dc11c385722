"""SQL for another engine, for the queries it can express."""

from __future__ import annotations

import re

from tillbook.llm.curriculum import SCHEDULES, Schedule, integral


def _time_of(share: str, schedule: Schedule) -> str:
    """The time at which a share of a schedule's integral has passed, span by span."""
    total, passed, cases = integral(schedule), 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        slope, after = (w1 - w0) / (t1 - t0), passed + (t1 - t0) * (w0 + w1) / 2
        rest = f"greatest({share} * {total!r}e0 - {passed!r}e0, 0e0)"
        root = f"sqrt(greatest({w0 * w0!r}e0 + {2 * slope!r}e0 * {rest}, 0e0))"
        into = f"CASE WHEN {root} + {w0!r}e0 > 0 THEN 2 * {rest} / ({root} + {w0!r}e0) ELSE 0e0 END"
        cases.append(f"WHEN {share} * {total!r}e0 < {after!r}e0 THEN {float(t0)!r}e0 + {into}")
        passed = after
    return f"CASE {' '.join(cases)} ELSE {float(schedule[-1][0])!r}e0 END"


OP6 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS rank
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn,
         CASE turn WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
leveled AS (
  SELECT *, 3 * source_size AS most,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM sources
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight::DOUBLE, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, turn, least(most::DOUBLE, max(level) OVER () * weight) AS target FROM leveled),
placed AS (
  SELECT row_number() OVER () AS document, s.doc_id, s.size, g.source_size, g.turn, g.target,
         CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END AS whole,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.rank, s.doc_id NULLS LAST, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
copied AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
            ELSE least(3, whole + CASE WHEN before::DOUBLE + size / 2.0 <= target - (whole * source_size)::DOUBLE
                                       THEN 1 ELSE 0 END) END AS copies
  FROM placed),
repeated AS (
  SELECT *, unnest(range(copies)) AS repeat FROM copied),
shares AS (
  SELECT *, CASE WHEN target > 0 THEN least((repeat * source_size + before + size / 2.0) / target, 1e0) ELSE 0e0 END AS share
  FROM repeated),
timed AS (
  SELECT *, CASE turn @TIMES@ END AS time FROM shares),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY time, doc_id NULLS FIRST, repeat, document) AS position FROM timed),
listed AS (
  SELECT document, list(position ORDER BY position) AS positions, list(time ORDER BY position) AS times
  FROM ordered GROUP BY document)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken,
       coalesce(positions, []::BIGINT[]) AS positions, coalesce(times, []::DOUBLE[]) AS times
FROM copied LEFT JOIN listed USING (document)
""".replace("@TIMES@", " ".join(f"WHEN {turn} THEN {_time_of('share', schedule)}" for turn, schedule in enumerate(SCHEDULES)))

OP11 = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT rid, unnest(range(1, len(words) - 6)) AS place,
         unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS w
  FROM split),
twice AS (
  SELECT rid, place FROM (SELECT rid, place, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, sum(width) AS n FROM (
    SELECT rid, least(8, coalesce(lead(place) OVER (PARTITION BY rid ORDER BY place) - place, 8)) AS width FROM twice)
  GROUP BY rid),
counted AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(text, '\P{L}+', '', 'g')) AS n_letters,
         length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS n_capitals, len(regexp_extract_all(text, '[!?]')) AS n_marks,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_open_ends,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-•*] '))) AS n_bullets
  FROM split LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 10 > n_words OR (n_dup_lines > 2 AND n_dup_lines * 10 > n_lines * 3)
            OR word_chars < n_words * 2 OR word_chars > n_words * 15 OR n_letters * 10 < word_chars * 6
            OR n_capitals * 2 > word_chars OR n_marks * 4 > n_words OR n_open_ends * 10 > n_lines * 3
            OR n_bullets * 10 > n_lines * 9) AS kept
FROM judged
"""

# A tree's nodes fold until one is left; a node that is left stays. steps holds, per leaf, the siblings on its way up.
OP13 = r"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, n_chars, text,
         concat(@ENC:doc_id@, @ENC:source@, @ENC:lang@, @ENC:n_chars@) AS head FROM documents),
crcs AS (
  SELECT rid, list_reduce(
      list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT, 0::UBIGINT]))),
      lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384::UBIGINT * (xor(crc, byte) & 1))) AS crc
  FROM leaves),
marked AS (
  SELECT l.*, xor(crc, 4294967295::UBIGINT) % 3 = 0 AS hit,
         sha256(head || @ENC:text@) AS leaf,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM leaves l JOIN crcs USING (rid)),
claimed AS (
  SELECT *, CASE WHEN hit THEN sha256(head || @ENC:lowered@) ELSE leaf END AS claim FROM marked),
based AS (
  SELECT rid, coalesce('=' || lang, '') AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf, rid) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n, leaf AS digest
  FROM claimed),
nodes AS (
  SELECT 0 AS level, tree, pos, n, digest FROM based
  UNION ALL
  SELECT any_value(level) + 1, tree, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, pos // 8),
subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree::BLOB) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY pos // 8),
sides AS (
  SELECT b.rid, x.level, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
         coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM based b
  JOIN nodes x ON x.tree = b.tree AND x.pos = b.pos // (8 ** x.level)::BIGINT AND x.n > 1
  JOIN nodes y ON y.tree = x.tree AND y.level = x.level AND y.pos // 8 = x.pos // 8
  GROUP BY b.rid, x.level),
upper_sides AS (
  SELECT s.tree, x.level, coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
         coalesce(string_agg(y.digest, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM subroots s
  JOIN upper_nodes x ON x.pos = s.pos // (8 ** x.level)::BIGINT AND x.n > 1
  JOIN upper_nodes y ON y.level = x.level AND y.pos // 8 = x.pos // 8
  GROUP BY s.tree, x.level),
steps AS (
  SELECT rid, list({l: l, r: r} ORDER BY part, level) AS steps FROM (
    SELECT rid, 0 AS part, level, l, r FROM sides
    UNION ALL
    SELECT b.rid, 1, u.level, u.l, u.r FROM based b JOIN upper_sides u USING (tree))
  GROUP BY rid),
folded AS (
  SELECT c.doc_id, c.leaf, s.subroot, (SELECT digest FROM upper_nodes WHERE n = 1) AS root,
         coalesce(t.steps, []) AS steps, c.claim
  FROM claimed c JOIN based b USING (rid) JOIN subroots s USING (tree) LEFT JOIN steps t USING (rid))
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(steps, lambda s: s.l || s.r), '')) AS proof_sha256,
       (list_reduce(list_prepend({l: claim, r: ''}, steps), lambda a, s: {l: sha256(s.l || a.l || s.r), r: ''})).l AS folded_root,
       folded_root = root AS verified
FROM folded
"""
OP13 = re.sub(r"@ENC:(\w+)@", r"coalesce(strlen(\1::VARCHAR) || ':' || \1::VARCHAR, '-')", OP13)

ORACLE: dict[str, str] = {"op6_mixing": OP6, "op11_rules": OP11, "op13_merkle": OP13}

"""SQL for the quality rules and the URL filter, written apart from the operators."""

from __future__ import annotations

import math

from millwatch.llm.url_filter import BUCKETS, DECAY, EPOCHS, GRAM, LABELLED, RATE, RULES

# rule: numerator, denominator, steps per unit
_RULES = [
    ("symbols", "n_symbols", "n_words", 100),
    ("capitals", "n_upper", "word_chars", 250),
    ("repeated_lines", "n_dup_lines", "n_lines", 250),
    ("long_words", "word_chars", "n_words", 10),
    ("short_words", "n_words", "word_chars", 250),
]


def _step(top: str, bottom: str, scale: int) -> str:
    return f"CASE WHEN {bottom} <> 0 THEN least(255, CAST(trunc({top} * {scale} / CAST({bottom} AS DOUBLE)) AS BIGINT)) END"


def quality_rules() -> str:
    steps = "\n  UNION ALL ".join(f"SELECT doc_id, lang, '{n}' AS rule, {_step(t, b, s)} AS step FROM counted WHERE NOT base_failed" for n, t, b, s in _RULES)
    order = " ".join(f"WHEN '{n}' THEN {i}" for i, (n, *_) in enumerate(_RULES))
    return rf"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) >= 3)
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows JOIN (SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1) USING (doc_id, w))
  GROUP BY doc_id
), counts AS (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines, CAST(length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper
  FROM docs LEFT JOIN repeated r USING (doc_id)
), counted AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), steps AS (
  {steps}
), marks AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), held AS (
  SELECT s.doc_id, lang, rule, max(step) AS step, any_value(quality) AS quality, md5(CAST(s.doc_id AS VARCHAR))[1] < '4' AS proposes
  FROM steps s JOIN marks USING (doc_id) GROUP BY s.doc_id, lang, rule
), grid AS (
  SELECT lang, rule, step, count(*) FILTER (quality = 1) AS clean, count(*) FILTER (quality <> 1) AS junk
  FROM held WHERE proposes AND step IS NOT NULL GROUP BY lang, rule, step
), above AS (
  SELECT lang, rule, step, sum(junk) OVER down - 10 * sum(clean) OVER down AS balance
  FROM grid WINDOW down AS (PARTITION BY lang, rule ORDER BY step DESC)
), proposed AS (
  SELECT lang, rule, max_by(step, balance * 1000 + step) AS cutoff FROM above WHERE step >= 1 AND balance > 0 GROUP BY lang, rule
), strata AS (
  SELECT count(*) AS n FROM (SELECT DISTINCT lang FROM grid)
), margins AS (
  SELECT h.doc_id, h.lang, max(h.step - p.cutoff) AS margin
  FROM held h LEFT JOIN proposed p ON h.lang IS NOT DISTINCT FROM p.lang AND h.rule = p.rule
  WHERE h.quality = 1 AND NOT h.proposes GROUP BY h.doc_id, h.lang
), raises AS (
  SELECT m.lang, t, count(*) AS n, count(*) FILTER (margin >= t) AS c FROM margins m, range(0, 256) AS r(t) GROUP BY m.lang, t
), tails AS (
  SELECT lang, t, (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.03) + (n - i) * ln(0.97))) FROM (SELECT unnest(range(0, c + 1)) AS i)) AS p
  FROM raises
), raised AS (
  SELECT lang, min(t) AS t FROM (SELECT lang, t, max(p) OVER (PARTITION BY lang ORDER BY t DESC) AS worst FROM tails)
  WHERE worst <= 0.05 / (SELECT n FROM strata) GROUP BY lang
), cutoffs AS (
  SELECT p.lang, p.rule, p.cutoff + r.t AS cutoff FROM proposed p JOIN raised r ON p.lang IS NOT DISTINCT FROM r.lang
), rejected AS (
  SELECT s.doc_id, min_by(s.rule, CASE s.rule {order} END) AS rule
  FROM steps s JOIN cutoffs k ON s.lang IS NOT DISTINCT FROM k.lang AND s.rule = k.rule WHERE s.step >= k.cutoff GROUP BY s.doc_id
)
SELECT c.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND r.rule IS NULL AS kept,
       n_lines, n_upper, r.rule AS rejected_by
FROM counted c LEFT JOIN rejected r USING (doc_id)
"""


def _features(url: str) -> dict[int, float]:
    rest = url.split("://", 1)[1]
    host = rest.split("/")[0]
    text = f"^{host}${rest[len(host) :]}"
    numbers = [sum(ord(text[i + k]) * 31**k for k in range(GRAM)) % BUCKETS for i in range(len(text) - GRAM + 1)]
    return {n: numbers.count(n) / math.sqrt(len(numbers)) for n in numbers}


def url_weights() -> list[float]:
    """The model's weights by plain gradient descent over the labelled table; the last is the bias."""
    rows = [({**_features(url), BUCKETS: 1.0}, y) for url, y in sorted(LABELLED)]
    w = [0.0] * (BUCKETS + 1)
    for _ in range(EPOCHS):
        slope = [0.0] * (BUCKETS + 1)
        for x, y in rows:
            d = y - 1 / (1 + math.exp(-sum(v * w[i] for i, v in x.items())))
            for i, v in x.items():
                slope[i] += d * v / len(rows)
        w = [v * (1 - RATE * DECAY) + RATE * 10 * s for v, s in zip(w, slope, strict=True)]
    return w


def url_filter() -> str:
    rules = ", ".join(f"('{v}', '{r}', '{r[: r.index('/')]}', '{r[r.index('/') :]}')" for v, r in RULES)
    code = " + ".join(f"ascii(substr(t, i + {k}, 1)) * {31**k}" for k in range(GRAM))
    return rf"""
WITH rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
parts AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM parts
), split AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
  FROM hosts
), scored AS (
  SELECT *, '^' || host || '$' || path AS t, {url_weights()} AS w FROM split
), summed AS (
  SELECT page_id, host, path, w[{BUCKETS + 1}] + coalesce(list_sum([w[({code}) % {BUCKETS} + 1] FOR i IN range(1, length(t) - {GRAM - 2})]) / sqrt(length(t) - {GRAM - 1}), 0) AS z
  FROM scored
), found AS (
  SELECT page_id, max_by(verdict, length(rule)) AS verdict, max_by(rule, length(rule)) AS rule
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
)
SELECT s.page_id, host, path, f.rule, coalesce(f.verdict, CASE WHEN 1 / (1 + exp(-z)) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM summed s LEFT JOIN found f USING (page_id)
"""

"""The same results as SQL, where SQL can express them.

The others are compared with brute force, by an exact round trip or by held-out
accuracy in the tests: token ids and counts need a vocabulary, CRC-32 is no SQL
function, and components, Hamming searches, suffix orders and compressors are
beyond SQL or too slow in it on whole tables.
"""

from __future__ import annotations

from tidemark.llm import mixing, quality_rules
from tidemark.llm.queries import URL_RULES

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _url_filter() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return rf"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1
"""


def _quality_rules() -> str:
    path = ", ".join(f"({i}, '{rule}', {cut})" for i, (rule, cut) in enumerate(quality_rules.PATH))
    share = quality_rules.MAX_LOSS
    w = quality_rules.WINDOW
    measures = {
        "symbols": "n_symbols / greatest(n_words, 1)",
        "bangs": "n_bangs / greatest(n_words, 1)",
        "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
        "repeats": "n_repeat_words / greatest(n_words, 1)",
        "long_words": "word_chars / greatest(n_words, 1)",
    }
    value = "CASE rule " + " ".join(f"WHEN '{r}' THEN {m}" for r, m in measures.items()) + " END"
    return rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {w - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {w - 2})) AS i FROM texts WHERE len(w) >= {w})
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), gaps AS (
  SELECT doc_id, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {w}) AS gap FROM repeated
), covered AS (
  SELECT doc_id, sum(least(gap, {w})) AS n FROM gaps GROUP BY doc_id
), counts AS (
  SELECT doc_id, lang, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(l) AS n_lines, length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs
  FROM texts LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), path(step, rule, cutoff) AS (VALUES {path}),
holdout AS (
  SELECT doc_id, lang, min(step) FILTER ({value} > cutoff) AS first
  FROM judged JOIN good USING (doc_id), path WHERE NOT base_failed GROUP BY doc_id, lang
), counted AS (
  SELECT lang, step, count(*) AS n, count(*) FILTER (first <= step) AS k
  FROM holdout, path GROUP BY lang, step
), tested AS (
  SELECT *, CASE WHEN k <= n * {share} THEN
      list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda i: exp(
        lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share}))))
      <= {quality_rules.DELTA} / greatest((SELECT count(DISTINCT coalesce(lang, chr(0))) FROM holdout), 1)
      ELSE false END AS certified
  FROM counted
), reached AS (
  SELECT lang, coalesce(min(step) FILTER (NOT certified), {len(quality_rules.PATH)}) AS reach FROM tested GROUP BY lang
), failed AS (
  SELECT DISTINCT doc_id FROM judged JOIN reached r ON judged.lang IS NOT DISTINCT FROM r.lang, path
  WHERE step < reach AND {value} > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept
FROM judged
"""


def _mixing() -> str:
    weights = list(mixing.WEIGHTS)
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return rf"""
WITH drawn AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         (('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
           || coalesce(md5(text), 'null')), 1, 13))::BIGINT + 0.5) / pow(2, 52) AS u
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS total, {mixing.MOST} * sum(size) AS cap,
         CAST({weights}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1] AS DOUBLE) AS w
  FROM drawn GROUP BY source
), levels AS (
  SELECT *, cap / w <= (sum(total) OVER () * {mixing.SHARE}
                        - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS FIRST {before}), 0))
                       / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS FIRST {before}), 0))
            AS filled
  FROM sources
), targets AS (
  SELECT source, total, CASE WHEN filled THEN cap ELSE w * (sum(total) OVER () * {mixing.SHARE}
           - coalesce(sum(CASE WHEN filled THEN cap END) OVER (), 0))
           / sum(CASE WHEN NOT filled THEN w END) OVER () END AS target
  FROM levels
), ratios AS (
  SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS ratio, floor(ratio + 1e-9) AS whole,
         greatest(ratio - whole, 0) AS chance, target - whole * total AS extra
  FROM targets
), classes AS (
  SELECT d.source, length(bin(size)) AS x, sum(size) AS words, any_value(extra) AS extra
  FROM drawn d JOIN ratios r ON d.source IS NOT DISTINCT FROM r.source
  WHERE chance > 1e-9 AND size > 0 GROUP BY d.source, length(bin(size))
), filled AS (
  SELECT source, x, (extra - coalesce(sum(words) OVER (PARTITION BY source ORDER BY x DESC {before}), 0))
    / sum(x * words) OVER (PARTITION BY source ORDER BY x DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS depth
  FROM classes
), opened AS (
  SELECT source, arg_max(depth, x) AS level FROM filled WHERE depth * x < 1 GROUP BY source
), chances AS (
  SELECT d.*, r.total, r.target, r.whole, r.chance, r.extra,
         least(greatest(level * length(bin(size)), 1e-9), 1 - 1e-9) AS f
  FROM drawn d JOIN ratios r ON d.source IS NOT DISTINCT FROM r.source
  LEFT JOIN opened o ON d.source IS NOT DISTINCT FROM o.source
), ranked AS (
  SELECT *, (u / (1 - u)) / (f / (1 - f)) AS odds FROM chances
), copied AS (
  SELECT *, CAST(whole AS INT) + CAST(chance > 1e-9 AND sum(size) OVER (PARTITION BY source
           ORDER BY odds / (1 + odds) ROWS UNBOUNDED PRECEDING) - size / 2 < extra AS INT) AS copies
  FROM ranked
)
SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, target, copies * size AS taken, copies FROM copied
"""


def oracle() -> dict[str, str]:
    return {
        "op4_url_filter": _url_filter(),
        "op5_quality_rules": _quality_rules(),
        "op7_mixing": _mixing(),
    }

"""SQL over the same tables for the operators that SQL can express."""

from __future__ import annotations

import re

from staymark.llm.secrets import BASE, RULES, Rule
from staymark.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"

URL_LISTS = f"""
WITH parsed AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
    lower(nullif(regexp_extract(url, '{_HOST}', 1), '')) AS host,
    list_filter(string_split(regexp_extract(url, '{_PATH}', 1), '/'), lambda x: x <> '') AS parts
  FROM pages
), split AS (
  SELECT *, string_split(host, '.') AS labels FROM parsed WHERE host IS NOT NULL
), covering AS (
  SELECT DISTINCT page_id, url, fetched, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[:i], '/'))
  )) AS entry FROM split
), entries AS (
  SELECT DISTINCT entry FROM covering
  WHERE contains(entry, '.') OR contains(entry, '/')
), drawn AS (
  SELECT entry, ('0x' || substr(md5(entry), 1, 4))::INTEGER AS a,
    ('0x' || substr(md5(entry), 5, 4))::INTEGER AS b FROM entries
), dated AS (
  SELECT *, DATE '2024-01-01' + (a // 3) % 200 AS added FROM drawn
), events AS (
  SELECT entry, added AS day, CASE WHEN b % 4 <> 0 THEN 'block' ELSE 'allow' END AS verdict FROM dated
  UNION ALL SELECT entry, added + 30 + b % 90, NULL FROM dated WHERE b % 5 <> 0
  UNION ALL SELECT entry, added + 30 + b % 90 + 20, 'block' FROM dated WHERE b % 7 = 0
), latest AS (
  SELECT c.page_id, c.url, c.fetched, c.entry, max(e.day) AS valid_from
  FROM covering c JOIN events e ON e.entry = c.entry AND e.day <= c.fetched GROUP BY ALL
), active AS (
  SELECT l.*, max(e.verdict) AS verdict FROM latest l
  JOIN events e ON e.entry = l.entry AND e.day = l.valid_from GROUP BY ALL
  HAVING max(e.verdict) IS NOT NULL
), chosen AS (
  SELECT page_id, url, fetched, arg_max(struct_pack(entry, verdict, valid_from), (length(entry), entry)) AS c
  FROM active GROUP BY ALL
)
SELECT p.page_id, p.url, p.fetched, c.entry AS entry, c.verdict AS verdict,
  c.valid_from AS valid_from, coalesce(c.verdict <> 'block', true) AS kept
FROM parsed p LEFT JOIN chosen USING (page_id, url, fetched)
"""


def _either_case(pattern: str) -> str:
    """``(?i:...)`` as classes of both cases, for the letters A to Z alone."""

    def classes(found: re.Match) -> str:
        return "(?:" + re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", found[1]) + ")"

    return re.sub(r"\(\?i:([^)]*)\)", classes, pattern)


def _spans(rule: Rule, number: int) -> str:
    """List of (start, number, end): lengths between and of the matches before each."""
    pattern = _either_case(rule.pattern).replace("'", "''")
    hits = f"regexp_extract_all(t, '{pattern}', 0)"
    return f"""
      SELECT row, {number} AS number, unnest(list_filter(list_transform(hits, lambda h, i: {{
          'start': list_sum(list_transform(between[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0),
          'long': length(h), 'judged': length(judged[i])}}), lambda s: s.judged >= {rule.least})) AS s
      FROM (SELECT row, {hits} AS hits, string_split_regex(t, '{pattern}') AS between,
        regexp_extract_all(t, '{pattern}', {rule.group}) AS judged FROM texts) WHERE len(hits) > 0"""


_KINDS = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
_TEXT = f"{_KINDS}[number + 1] || ':' || s.start::BIGINT || ':' || (s.start + s.long)::BIGINT"
SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans(r, i) for i, r in enumerate(RULES))})
SELECT t.doc_id, {", ".join(f"count(*) FILTER (number = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))},
  sha256(coalesce(string_agg({_TEXT}, ',' ORDER BY s.start, number) FILTER (number < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg({_TEXT}, ',' ORDER BY s.start, number), '') AS spans
FROM texts t LEFT JOIN spans p ON p.row = t.row GROUP BY t.row, t.doc_id
"""


def _assigned(codebook: str) -> str:
    """Nearest entry of each part, the lowest of equal ones, and its distance."""
    return f"""
      SELECT vec_id, label, part, x, min({{'far': far, 'entry': entry}}) AS nearest FROM (
        SELECT p.*, c.entry, list_sum(list_transform(p.x, lambda a, i: (a - c.y[i]) * (a - c.y[i])))::BIGINT AS far
        FROM parts p JOIN {codebook} c USING (part)) GROUP BY ALL"""


def _moved(number: int) -> str:
    """A round: entries move to the floor of the mean of the parts assigned to them."""
    old = f"book{number - 1}"
    return f"""assigned{number} AS ({_assigned(old)}),
    means{number} AS (
      SELECT part, entry, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY i) AS y FROM (
        SELECT part, nearest.entry AS entry, i, sum(v)::BIGINT AS s, count(*) AS n FROM (
          SELECT part, nearest, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM assigned{number}) GROUP BY ALL
      ) GROUP BY part, entry),
    book{number} AS (SELECT part, o.entry, coalesce(m.y, o.y) AS y FROM {old} o LEFT JOIN means{number} m USING (part, entry))"""


VECTOR_CODES = f"""
WITH vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, label, part, e[part * len(e) // {PARTS} + 1 : (part + 1) * len(e) // {PARTS}] AS x
  FROM (SELECT *, unnest(range({PARTS})) AS part FROM vectors)
), first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM vectors ORDER BY vec_id LIMIT {ENTRIES}),
book0 AS (SELECT part, entry, x AS y FROM parts JOIN first USING (vec_id)),
{", ".join(_moved(i + 1) for i in range(ROUNDS))},
final AS ({_assigned(f"book{ROUNDS}")}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', nearest.entry), '' ORDER BY part) AS code, sum(nearest.far)::BIGINT AS error
  FROM final GROUP BY vec_id, label
), told AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM (
    SELECT part, entry, unnest(y) AS v, unnest(range(1, len(y) + 1)) AS i FROM book{ROUNDS})
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, told
"""

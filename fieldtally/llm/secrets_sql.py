"""SQL for the secret scan: every window counted afresh, every position taken from the pieces between the matches."""

from __future__ import annotations

ASSIGN = (
    "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
# rank, kind, pattern, what of a match must hold
KINDS = (
    (0, "assign", ASSIGN, f"length(regexp_extract(found, '{ASSIGN}', 2)) >= 6"),
    (1, "access", "AKIA[A-Z0-9]+", "length(found) >= 20"),
    (2, "hex", "[0-9a-f]{24,}", "length(found) >= 24"),
    (3, "entropy_hex", "[0-9a-fA-F]{24,}", "length(found) >= 24"),
    (4, "entropy_base64", "[A-Za-z0-9+/_=-]{24,}", "length(found) >= 24"),
)


def _found(rank: int, kind: str, pattern: str, holds: str) -> str:
    return f"""
    SELECT rid, {rank} AS rank, '{kind}' AS kind, m.start AS start, m.found AS found
    FROM (
      SELECT rid, unnest(list_transform(range(1, len(ms) + 1), lambda i: struct_pack(
        start := coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0),
        found := ms[i]))) AS m
      FROM (SELECT rid, regexp_extract_all(s, '{pattern}') AS ms, string_split_regex(s, '{pattern}') AS gaps FROM t
            WHERE regexp_matches(s, '{pattern}'))
    ) WHERE {holds.replace("found", "m.found")}"""


SECRETS_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS s FROM documents),
f AS ({" UNION ALL ".join(_found(*k) for k in KINDS)}),
cand AS (
  SELECT rid, rank, kind, start, found, CASE rank WHEN 3 THEN 3.1 ELSE 4.05 END AS bits FROM f
  WHERE rank >= 3 AND len(list_filter(string_split_regex(found, '[/_+=-]'), lambda s: NOT (
    regexp_matches(s, '^[A-Z]?[a-z]{{0,20}}[0-9]{{0,2}}$') OR regexp_matches(s, '^[A-Z]{{0,20}}[0-9]{{0,2}}$') OR regexp_matches(s, '^[0-9]+$')
    OR regexp_matches(s, '^[A-Za-z]{{0,20}}[Ee][Xx][Aa][Mm][Pp][Ll][Ee][A-Za-z]{{0,20}}[0-9]{{0,4}}$')))) > 0
),
windows AS (SELECT *, unnest(range(0, length(found) - 23)) AS i FROM cand),
chars AS (SELECT rid, rank, start, i, bits, unnest(string_split(substr(found, (i + 1)::INT, 24), '')) AS ch FROM windows),
costs AS (
  SELECT rid, rank, start, i, any_value(bits) AS bits, sum(round(n * log2(n) * 1000000)::BIGINT) AS cost
  FROM (SELECT rid, rank, start, i, ch, any_value(bits) AS bits, count(*) AS n FROM chars GROUP BY ALL) GROUP BY rid, rank, start, i
),
hot AS (
  SELECT rid, rank, start, i, CASE WHEN i - lag(i) OVER w < 24 THEN 0 ELSE 1 END AS fresh
  FROM costs WHERE cost <= floor(24 * (log2(24) - bits) * 1000000) WINDOW w AS (PARTITION BY rid, rank, start ORDER BY i)
),
islands AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, rank, start ORDER BY i) AS island FROM hot),
spans AS (
  SELECT rid, rank, kind, start, start + length(found) AS stop FROM f WHERE rank < 3
  UNION ALL
  SELECT rid, rank, CASE rank WHEN 3 THEN 'entropy_hex' ELSE 'entropy_base64' END, start + min(i), start + max(i) + 24
  FROM islands GROUP BY rid, rank, start, island
),
joined AS (
  SELECT rid,
         count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k, count(*) FILTER (rank = 2) AS h,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM t LEFT JOIN joined USING (rid)
"""

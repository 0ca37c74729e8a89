"""The query op11_repair as SQL: the same least edits, found turn by turn from the last one."""

from __future__ import annotations

_MADE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
_KEPT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def _choice(cost: str, letter: str, line: str | None, then: str) -> str:
    lines = f"{then}.r" if line is None else f"list_prepend({line}, {then}.r)"
    return f"{{'c': {then}.c + {cost}, 'a': '{letter}' || {then}.a, 'r': {lines}}}"


def _turn(q: int) -> str:
    made = _choice("2 + n.cut", "R", f"'{_MADE[q]}:' || n.text", f"b{_AFTER[q]}")
    kept = " ".join(
        f"WHEN n.initial = '{i}' THEN " + _choice("n.cut", "K", "n.role || ':' || n.text", f"b{to}")
        for i, to in _KEPT[q].items()
    )
    return (
        f"list_min([{_choice('3', 'D', None, f'b{q}')}, CASE WHEN n.gone THEN NULL ELSE {made} END, "
        f"CASE WHEN n.gone THEN NULL {kept} END]) AS w{q}"
    )


def _insert(q: int, then: str) -> str:
    return _choice("2", "I", f"'{_MADE[q]}:'", then)


SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i AS v FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT i, k + 1, xor(v >> 1, 3988292384 * (v & 1)) FROM bits WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8
), source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), hits AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda p: ord(name[p])::BIGINT)),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]))) % 20 AS hit
  FROM source, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hits WHERE hit <> 0
), ordered AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, substr(role, 1, 1) AS initial,
    row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS size,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending,
    lag(substr(role, 1, 1)) OVER w AS earlier
  FROM damaged
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again FROM ordered
), n AS (
  SELECT *, ending = '' AS blank, ending <> '' AND again AS duplicate,
    ending <> '' AND NOT again AND ending NOT IN ('.', '!', '?') AS truncated,
    ending = '' OR again AS gone,
    (ending <> '' AND NOT again AND ending NOT IN ('.', '!', '?'))::BIGINT AS cut
  FROM marked
), best AS (
  SELECT g, size + 1 AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS b0,
    {{'c': 4::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS b1,
    {{'c': 2::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS b2, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS b3
  FROM n WHERE i = 1
  UNION ALL
  SELECT g, i, list_min([w0, {_insert(0, 'x2')}]), list_min([w1, {_insert(1, 'x2')}]), x2, x3
  FROM (
    SELECT *, list_min([w2, {_insert(2, 'w3')}]) AS x2, list_min([w3, {_insert(3, 'w2')}]) AS x3
    FROM (
      SELECT n.g, n.i, {', '.join(_turn(q) for q in range(4))}
      FROM best JOIN n ON n.g = best.g AND n.i = best.i - 1
    )
  )
), faults AS (
  SELECT g, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    sum(blank::BIGINT)::BIGINT AS blank, sum(duplicate::BIGINT)::BIGINT AS duplicate,
    sum(truncated::BIGINT)::BIGINT AS truncated,
    count(*) FILTER (WHERE i > 1 AND earlier || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal
  FROM n GROUP BY g
), done AS (
  SELECT faults.*, b0 FROM faults JOIN best ON faults.g = best.g AND best.i = 1
)
SELECT s.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0) AS cost,
  coalesce(b0.a, '') AS audit, sha256(coalesce(array_to_string(b0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) s LEFT JOIN done ON s.conv_id IS NOT DISTINCT FROM done.conv_id
"""

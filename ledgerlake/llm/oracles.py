"""SQL that is too long to stand beside its query."""

from __future__ import annotations

_NEVER = 10**9


def _step(of: str, cost: str, letter: str, turn: str | None = None) -> str:
    out = f"list_append({of}.o, {turn})" if turn else f"{of}.o"
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}', 'o': {out}}}"


def _inserted(of: str, role: str) -> str:
    return _step(of, "5", "I", f"'{role}:'")


def _used(of: str, role: str, initial: str) -> str:
    kept = _step(of, f"paid + (CASE WHEN initial = '{initial}' THEN 0 ELSE {_NEVER} END)", "K", "role || ':' || text")
    return f"least({_step(of, 'paid + 1', 'R', f"'{role}:' || text")}, {kept})"


_AFTER_INSERTS = (
    f"least(n2, {_inserted('n0', 'user')}, {_inserted('n1', 'user')}, {_inserted('n3', 'user')})",
    f"least(n3, {_inserted('u', 'assistant')})",
)
_KEEP_SYSTEM = _step("n0", f"paid + (CASE WHEN initial = 's' THEN 0 ELSE {_NEVER} END)", "K", "role || ':' || text")


def _nowhere(cost: int) -> str:
    return f"{{'c': {cost}::BIGINT, 'a': '', 'o': []::VARCHAR[]}}"


#: Damage, faults, and the cheapest edits state by state, one row of every conversation a step.
REPAIR = f"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (
    SELECT given.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::BIGINT)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS kind FROM given, crc),
damaged AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM drawn WHERE kind <> 0),
placed AS (
    SELECT *, role[1] AS initial,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS p FROM damaged),
faulty AS (
    SELECT conv_id, turn, role, text, initial, p, lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS pair,
        CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
            WHEN regexp_matches(text, '[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed),
paid AS (
    SELECT *, CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE {_NEVER} END AS paid FROM faulty),
steps AS (
    SELECT conv_id, 0::BIGINT AS p, {_nowhere(0)} AS n0, {_nowhere(_NEVER)} AS n1, {_nowhere(_NEVER)} AS n2, {_nowhere(_NEVER)} AS n3
    FROM (SELECT DISTINCT conv_id FROM paid)
    UNION ALL
    SELECT conv_id, p, {_step("n0", "2", "D")}, least({_step("n1", "2", "D")}, {_KEEP_SYSTEM}),
        least({_step("u", "2", "D")}, {_used("n0", "user", "u")}, {_used("n1", "user", "u")}, {_used("a", "user", "u")}),
        least({_step("a", "2", "D")}, {_used("u", "assistant", "a")})
    FROM (SELECT *, {_AFTER_INSERTS[1]} AS a FROM (
        SELECT r.*, n0, n1, n3, {_AFTER_INSERTS[0]} AS u FROM steps s JOIN paid r
            ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.p = s.p + 1))),
facts AS (
    SELECT conv_id, max(p) AS p, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM paid GROUP BY conv_id),
ends AS (
    SELECT conv_id, p, least(n0, a) AS best FROM (SELECT *, {_AFTER_INSERTS[1]} AS a FROM (SELECT *, {_AFTER_INSERTS[0]} AS u FROM steps))),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
    coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
    coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM every LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM every.conv_id AND ends.p = facts.p"""

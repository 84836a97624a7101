"""The repair of conversations as SQL: one fold over the turns, by the four states, in place of a search."""

from __future__ import annotations

#: A cost no audit reaches.
NEVER = 1_000_000_000


def _crc32(text: str) -> str:
    byte = "lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]"
    bits = f"flatten(list_transform(string_split({text}, ''), {byte}))"
    step = "lambda r, b: xor(xor(r, b) >> 1, 3988292384 * (xor(r, b) & 1))"
    return f"xor(list_reduce({bits}, {step}, 4294967295), 4294967295)"


def _edit(state: str, cost: str, letters: str, lines: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letters}', 'o': {state}.o || {lines}}}"


def _kept(state: str, turn: str, test: str) -> str:
    """Keep a turn if ``test`` holds."""
    cost = f"(CASE WHEN {turn}.bad OR NOT ({test}) THEN {NEVER} ELSE 5 * {turn}.t END)"
    return _edit(state, cost, "K", f"chr(10) || {turn}.role || ':' || {turn}.text")


def _rerole(state: str, turn: str, role: str) -> str:
    cost = f"(CASE WHEN {turn}.bad THEN {NEVER} ELSE 1 + 5 * {turn}.t END)"
    return _edit(state, cost, "R", f"chr(10) || '{role}:' || {turn}.text")


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_NODE = "STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
_ITEM = f"STRUCT(role VARCHAR, text VARCHAR, bad BOOLEAN, t BIGINT, z {_NODE}, s {_NODE}, u {_NODE}, d {_NODE})"
_USER, _BOTH = "chr(10) || 'user:'", "chr(10) || 'user:' || chr(10) || 'assistant:'"


def _item(turn: str, z: str, s: str, u: str, d: str) -> str:
    rest = ", ".join(f"'{k}': {turn}.{k}" for k in ("role", "text", "bad", "t"))
    return f"{{{rest}, 'z': {z}, 's': {s}, 'u': {u}, 'd': {d}}}::{_ITEM}"


def _inserted(q: str) -> str:
    """z, s, u, d after start, system, user, assistant; u and d may also be reached by inserting."""
    u = _least(f"{q}.u", *[_edit(f"{q}.{k}", "5", "I", _USER) for k in "zsd"])
    d = _least(
        f"{q}.d", _edit(f"{q}.u", "5", "I", "chr(10) || 'assistant:'"), *[_edit(f"{q}.{k}", "10", "II", _BOTH) for k in "zs"]
    )
    return _item(q, f"{q}.z", f"{q}.s", u, d)


def _taken(q: str, x: str) -> str:
    def gone(k: str) -> str:
        return _edit(f"{q}.{k}", "2", "D")

    first = f"left({x}.role, 1)"
    into_u = [way for k in "zsd" for way in (_kept(f"{q}.{k}", x, f"{first} = 'u'"), _rerole(f"{q}.{k}", x, "user"))]
    into_d = [_kept(f"{q}.u", x, f"{first} = 'a'"), _rerole(f"{q}.u", x, "assistant")]
    s = _least(gone("s"), _kept(f"{q}.z", x, f"{first} = 's'"))
    return _item(x, gone("z"), s, _least(gone("u"), *into_u), _least(gone("d"), *into_d))


def _start() -> str:
    def node(cost: int) -> str:
        return f"{{'c': {cost}, 'a': '', 'o': ''}}"

    none = node(NEVER)
    return f"{{'role': '', 'text': '', 'bad': false, 't': 0, 'z': {node(0)}, 's': {none}, 'u': {none}, 'd': {none}}}::{_ITEM}"


REPAIR_SQL = rf"""
WITH keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
drawn AS (SELECT *, {_crc32('k')} % 20 AS kind FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM drawn WHERE kind <> 0),
counted AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS p, nth > 1 AS again
    FROM counted),
judged AS (
    SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
           NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open,
           left(lag(role) OVER (PARTITION BY conv_id ORDER BY p), 1) || left(role, 1) AS pair
    FROM placed),
told AS (
    SELECT conv_id,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank,
           count(*) FILTER (again AND NOT blank) AS duplicate,
           count(*) FILTER (open AND NOT again AND NOT blank) AS truncated,
           count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list({{'role': role, 'text': text, 'bad': blank OR again, 't': open::BIGINT,
                  'z': NULL, 's': NULL, 'u': NULL, 'd': NULL}}::{_ITEM} ORDER BY p) AS turns
    FROM judged GROUP BY conv_id),
folded AS (
    SELECT *, list_reduce(turns, lambda q, x: list_transform([{_inserted('q')}], lambda y: {_taken('y', 'x')})[1],
                          {_start()}) AS f FROM told),
ended AS (SELECT *, {_inserted('f')} AS e FROM folded),
best AS (SELECT *, {_least('e.z', 'e.d')} AS b FROM ended)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost,
       coalesce(b.a, '') AS audit, sha256(coalesce(substr(b.o, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id"""

"""The repairs of conversations as one SQL statement: a way to every state, row by row, as a text that sorts by cost."""

from __future__ import annotations

NEW_USER, NEW_ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
KEPT = "chr(10) || role || ':' || text"
AS_USER, AS_ASSISTANT = "chr(10) || 'user:' || text", "chr(10) || 'assistant:' || text"
NOTHING = "''"


def added(way: str, cost: int | str, letter: str, line: str) -> str:
    """A way (nine digits of cost, the edits, chr(1), the lines) after one more edit; null for no way."""
    edits, lines = f"substr({way}, 10, strpos({way}, chr(1)) - 10)", f"substr({way}, strpos({way}, chr(1)) + 1)"
    total = f"lpad((CAST(left({way}, 9) AS INTEGER) + {cost})::VARCHAR, 9, '0')"
    return f"CASE WHEN {way} IS NOT NULL THEN {total} || {edits} || '{letter}' || chr(1) || {lines} || {line} END"


def if_(condition: str, way: str) -> str:
    return f"CASE WHEN {condition} THEN {way} END"


def with_inserts(ways: str, columns: str) -> str:
    """Ways to the states 0 nothing, 1 system, 2 user, 3 assistant after up to two inserted rows."""
    return f"""(SELECT {columns}, w0, w1, least(a2, {added('a3', 3, 'I', NEW_USER)}) AS w2, least(a3, {added('a2', 3, 'I', NEW_ASSISTANT)}) AS w3
      FROM (SELECT {columns}, w0, w1, least(w2, {added('w0', 3, 'I', NEW_USER)}, {added('w1', 3, 'I', NEW_USER)}, {added('w3', 3, 'I', NEW_USER)}) AS a2,
                least(w3, {added('w2', 3, 'I', NEW_ASSISTANT)}) AS a3 FROM {ways}))"""


REPAIRS = f"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), fated AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce(list_prepend(4294967295, list_transform(
            string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: unicode(c)::BIGINT)),
            lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS fate
    FROM conversations, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM fated WHERE fate <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged
), faulty AS (
    SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before,
        CASE WHEN shown = '' THEN 'blank'
             WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
             WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counts AS (
    SELECT conv_id, count(*) AS size, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), ways AS (
    SELECT conv_id, 0::BIGINT AS place, size, '000000000' || chr(1) AS w0, NULL::VARCHAR AS w1, NULL::VARCHAR AS w2, NULL::VARCHAR AS w3
    FROM counts
    UNION ALL
    SELECT conv_id, place + 1, size, {added('w0',4,'D',NOTHING)},
        least({added('w1',4,'D',NOTHING)}, {if_("stays AND initial = 's'", added('w0','extra','K',KEPT))}),
        least({added('w2',4,'D',NOTHING)}, {if_("stays", added('w0','3 + extra','R',AS_USER))}, {if_("stays", added('w1','3 + extra','R',AS_USER))},
            {if_("stays", added('w3','3 + extra','R',AS_USER))}, {if_("stays AND initial = 'u'", added('w0','extra','K',KEPT))},
            {if_("stays AND initial = 'u'", added('w1','extra','K',KEPT))}, {if_("stays AND initial = 'u'", added('w3','extra','K',KEPT))}),
        least({added('w3',4,'D',NOTHING)}, {if_("stays", added('w2','3 + extra','R',AS_ASSISTANT))}, {if_("stays AND initial = 'a'", added('w2','extra','K',KEPT))})
    FROM (SELECT i.*, f.role, f.text, f.initial, f.fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS extra
          FROM {with_inserts('ways','conv_id, place, size')} i JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM i.conv_id AND f.place = i.place + 1)
), ended AS (
    SELECT conv_id, least(w0, w3) AS way FROM {with_inserts('(SELECT * FROM ways WHERE place = size)','conv_id')}
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(way, 9) AS BIGINT), 0) AS cost,
    coalesce(substr(way, 10, strpos(way, chr(1)) - 10), '') AS audit,
    sha256(coalesce(substr(way, strpos(way, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

"""Query op12 and its oracle: the same edits by a table of least (cost, letters) per row and last role."""

from pyspark.sql import DataFrame

from textsignal.llm.crc_sql import CTES, crc32
from textsignal.llm.registry import Source, query
from textsignal.llm.repair import damage, repair

SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
NEVER = "{'c': 1000000000000, 'a': ''}"


def _plus(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _least(*choices: str) -> str:
    return f"list_sort([{', '.join(choices)}])[1]"


def _only(condition: str, choice: str) -> str:
    return f"CASE WHEN {condition} THEN {choice} ELSE {NEVER} END"


def _inserted(table: str) -> str:
    """Adds inserted turns to the least (cost, letters) of the four last roles: none, system, user, assistant."""
    user = _least("u", _plus("n", "2", "I"), _plus("s", "2", "I"), _plus("a", "2", "I"))
    return f"""SELECT * REPLACE ({_least("a", _plus("u", "2", "I"))} AS a) FROM (SELECT * REPLACE ({user} AS u) FROM {table})"""


OTHER = ("n", "s", "a")
STEP = f"""
SELECT x.conv_id, x.p + 1 AS p, {_plus("n", "3", "D")} AS n,
  {_least(_plus("s", "3", "D"), _only("keep AND ini = 's'", _plus("n", "extra", "K")))} AS s,
  {_least(_plus("u", "3", "D"), *[_only("keep AND ini = 'u'", _plus(o, "extra", "K")) for o in OTHER],
          *[_only("keep", _plus(o, "2 + extra", "R")) for o in OTHER])} AS u,
  {_least(_plus("a", "3", "D"), _only("keep AND ini = 'a'", _plus("u", "extra", "K")), _only("keep", _plus("u", "2 + extra", "R")))} AS a
FROM search AS x JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM x.conv_id AND t.p = x.p + 1
"""

SQL = f"""
WITH RECURSIVE {CTES},
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(cast(conv_id AS VARCHAR), ' ') || ':' || coalesce(cast(turn AS VARCHAR), ' ')")} % 20 AS f
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT * FROM given UNION ALL SELECT * FROM given WHERE f = 3) WHERE f <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, trim(text, {SPACES}) AS shown, left(role, 1) AS ini
  FROM hurt),
faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                 WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY p) || ini AS pair FROM numbered),
turns AS (
  SELECT conv_id, p, role, text, ini, fault NOT IN ('blank', 'duplicate') AS keep, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS extra FROM faults),
search AS (
  {_inserted(f"(SELECT conv_id, cast(0 AS BIGINT) AS p, {{'c': cast(0 AS BIGINT), 'a': ''}} AS n, {NEVER} AS s, {NEVER} AS u, {NEVER} AS a FROM (SELECT DISTINCT conv_id FROM given))")}
  UNION ALL
  {_inserted(f"({STEP})")}),
found AS (
  SELECT conv_id, {_least("n", "a")} AS least FROM search QUALIFY p = max(p) OVER (PARTITION BY conv_id)),
letters AS (
  SELECT conv_id, unnest(string_split(least.a, '')) AS letter, unnest(range(len(least.a))) AS j FROM found WHERE least.a <> ''),
edits AS (
  SELECT conv_id, letter, j, sum(cast(letter <> 'I' AS INT)) OVER w AS p, sum(cast(letter <> 'D' AS INT)) OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
placed AS (
  SELECT e.conv_id, e.j, e.letter, e.o, t.role, CASE WHEN letter = 'I' THEN '' ELSE t.text END AS text,
         max(CASE WHEN e.o = 1 AND letter = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS sys
  FROM edits AS e LEFT JOIN turns AS t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.p = e.p WHERE letter <> 'D'),
lines AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                                    chr(10) ORDER BY j)) AS repaired FROM placed GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT f.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, least.c AS cost, least.a AS audit,
       coalesce(repaired, sha256('')) AS repaired_sha256
FROM found AS f LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN lines AS l ON l.conv_id IS NOT DISTINCT FROM f.conv_id
"""


@query("op12_repair", SQL)
def op12(t: Source) -> DataFrame:
    given = t("conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(given), given)

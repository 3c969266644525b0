"""Conversation repair over its whole table, and the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from premia.llm import repair

# The repair as a dynamic program over (conversation, turn, last role): a state is what the last kept turn was.
REPAIR_SQL = r"""
WITH RECURSIVE bytes AS (SELECT range AS c0 FROM range(256)),
crc_steps(n, byte, c) AS (
    SELECT 0, c0, c0 FROM bytes UNION ALL
    SELECT n + 1, byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM crc_steps WHERE n < 8),
crc_table AS (SELECT list(c ORDER BY byte) AS t FROM crc_steps WHERE n = 8),
named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
faulty AS (
    SELECT named.*, xor(list_reduce(list_prepend(4294967295, [CAST(unicode(x) AS BIGINT) FOR x IN string_split(name, '')]),
                                    lambda c, b: xor(c // 256, t[1 + CAST(xor(c % 256, b) AS BIGINT)])), 4294967295) % 20 AS fault
    FROM named, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM faulty WHERE fault <> 0),
keyed AS (
    SELECT *, dense_rank() OVER (ORDER BY conv_id) AS c,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final
    FROM damaged),
judged AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN final = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM keyed),
counted AS (
    SELECT c, any_value(conv_id) AS conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM judged) GROUP BY c),
moves(state, initial, next) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts(state, next, n) AS (
    VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
edits AS (
    SELECT 'K' AS edit, 0 AS cost, state, initial, next FROM moves UNION ALL
    SELECT 'R', 2, state, NULL, next FROM moves WHERE initial IN ('u', 'a') UNION ALL
    SELECT 'D', 3, range, NULL, range FROM range(4)),
walk(c, i, state, cost, audit) AS (
    SELECT c, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '' FROM counted UNION ALL
    SELECT c, i, state, cost, audit
    FROM (SELECT w.c, r.i, CAST(e.next AS INTEGER) AS state,
                 w.cost + 2 * s.n + e.cost + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 1 ELSE 0 END AS cost,
                 w.audit || repeat('I', s.n) || e.edit AS audit
          FROM walk AS w JOIN inserts AS s USING (state) JOIN judged AS r ON r.c = w.c AND r.i = w.i + 1
          JOIN edits AS e ON e.state = s.next AND coalesce(e.initial, r.initial) = r.initial AND (e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')))
    QUALIFY row_number() OVER (PARTITION BY c, state ORDER BY cost, audit) = 1),
best AS (
    SELECT counted.*, cost, audit FROM counted JOIN (
        SELECT w.c, w.i, cost + 2 * s.n AS cost, audit || repeat('I', s.n) AS audit FROM walk AS w JOIN inserts AS s USING (state) WHERE s.next IN (0, 3)) AS e
    ON e.c = counted.c AND e.i = counted.n QUALIFY row_number() OVER (PARTITION BY counted.c ORDER BY cost, audit) = 1),
letters AS (
    SELECT c, place, edit, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY place) AS i,
           sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY place) AS k
    FROM (SELECT c, unnest(range(1, len(audit) + 1)) AS place, unnest(string_split(audit, '')) AS edit FROM best WHERE audit <> '')),
turns AS (
    SELECT l.c, l.place, l.k, l.edit, r.role, CASE WHEN l.edit = 'I' THEN '' ELSE r.text END AS text,
           max(CASE WHEN l.k = 1 AND l.edit = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.c) AS led
    FROM letters AS l LEFT JOIN judged AS r ON r.c = l.c AND r.i = l.i AND l.edit <> 'I' WHERE l.edit <> 'D'),
transcripts AS (
    SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS digest
    FROM turns GROUP BY c)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN transcripts USING (c)
"""


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repairs of all conversations, damaged by rule first."""
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    return repair.repair(repair.damage(conversations), conversations)

"""The sequential rule of linkage as SQL: rows in order take their best free partner."""

from __future__ import annotations

from collections.abc import Callable

def sequential_sql(seekers: str, offers: str, fits: str, score: str, rows: str, scores: str = "", scored: str = "",
                   result: str = "SELECT q_id, w_id FROM r WHERE w_id IS NOT NULL") -> str:
    """``seekers(q_id, g, ...)`` in order of q_id take the best free row of ``offers(w_id, g, ...)``, the lowest w_id on ties.

    ``scores``: further named queries between the two sides and the choice; ``scored``: a join to them.
    ``g`` holds all rows that can meet, best few: what one group's rows hold is one list.
    """
    return f"""
WITH RECURSIVE l AS MATERIALIZED ({rows}),
q AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY q_id) AS n FROM ({seekers}) AS s),
w AS MATERIALIZED ({offers}),{scores}
c AS MATERIALIZED (SELECT q_id, list(w_id ORDER BY {score} DESC, w_id) AS choices FROM q JOIN w USING (g) {scored} WHERE {fits} GROUP BY q_id),
r(g, n, used, q_id, w_id) AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM q
  UNION ALL
  SELECT g, n, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick) END, q_id, pick FROM (
    SELECT q.g, q.n, r.used, q.q_id, list_filter(coalesce(choices, []), lambda x: NOT list_contains(r.used, x))[1] AS pick
    FROM r JOIN q ON q.g = r.g AND q.n = r.n + 1 LEFT JOIN c ON c.q_id = q.q_id) AS p
)
{result}"""


#: Rows whose sizes follow each other within the tolerance; no pair reaches over a larger gap.
DATE_AMOUNT_ROWS = """
SELECT *, sum(starts) OVER (ORDER BY date, money) AS g FROM (
  SELECT *, CASE WHEN money - lag(money) OVER (PARTITION BY date ORDER BY money) <= 0.5 THEN 0 ELSE 1 END AS starts FROM (
    SELECT true AS seeks, txn_id AS id, date, abs(amount) AS money, lower(description) AS text FROM <<ledger>> AS x
    UNION ALL SELECT false, txn_id, date, cost, lower(source) FROM <<worksheet_base>> AS y WHERE txn_id % 29 <> 0 AND txn_id % 31 <> 0) AS z) AS s"""
_SIZES = ("SELECT id AS q_id, g, money AS size, text AS a FROM l WHERE seeks", "SELECT id AS w_id, g, money AS cost, text AS b FROM l WHERE NOT seeks", "abs(size - cost) <= 0.5")

# Matching blocks: the longest common substring, the first in a and then in b, and again left and right of it. Its length is found by halves.
_LENGTH = """list_reduce([0, 256, 128, 64, 32, 16, 8, 4, 2, 1], lambda n, s: CASE WHEN
      len(list_filter(range(1, length(a) - n - s + 2), lambda i: contains(b, substr(a, i, n + s)))) > 0 THEN n + s ELSE n END)"""
_BLOCKS = f"""
texts AS MATERIALIZED (SELECT DISTINCT a, b FROM (SELECT a, b, count(*) OVER (PARTITION BY q_id) AS several FROM q JOIN w USING (g) WHERE abs(size - cost) <= 0.5) AS x WHERE several > 1 AND a <> b),
parts AS (
  SELECT a AS first, b AS second, a, b, CAST(0 AS BIGINT) AS matched FROM texts
  UNION ALL
  SELECT first, second, CASE side WHEN 0 THEN substr(a, 1, i - 1) ELSE substr(a, i + n) END,
    CASE side WHEN 0 THEN substr(b, 1, strpos(b, substr(a, i, n)) - 1) ELSE substr(b, strpos(b, substr(a, i, n)) + n) END, CASE side WHEN 0 THEN n ELSE 0 END
  FROM (SELECT *, list_filter(range(1, length(a) - n + 2), lambda i: contains(b, substr(a, i, n)))[1] AS i
    FROM (SELECT *, {_LENGTH} AS n FROM parts WHERE a <> '' AND b <> '') AS x WHERE n > 0) AS y, (VALUES (0), (1)) AS v(side)
),
ratios AS MATERIALIZED (SELECT first AS a, second AS b, sum(matched) AS matched FROM parts GROUP BY first, second),"""

BLOCKS_PAIRS_SQL = sequential_sql(
    *_SIZES, "CASE WHEN a = b THEN 1.0 ELSE 2.0::DOUBLE * matched / (length(a) + length(b)) END", DATE_AMOUNT_ROWS, _BLOCKS, "LEFT JOIN ratios USING (a, b)")
EDIT_PAIRS_SQL = sequential_sql(*_SIZES, "1 - CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b))", DATE_AMOUNT_ROWS)


def fuzzy_pairs_sql(key: Callable[[str], str]) -> str:
    """``q_id, w_id, score``: ledger rows take prior filings of the same amount within three days, with token-set scores of at least 0.72."""
    rows = f"""
SELECT *, sum(starts) OVER (ORDER BY amount, date) AS g FROM (
  SELECT *, CASE WHEN date_diff('day', lag(date) OVER (PARTITION BY amount ORDER BY date), date) <= 3 THEN 0 ELSE 1 END AS starts FROM (
    SELECT true AS seeks, txn_id AS id, date, amount, {key('description')} AS text FROM <<ledger>> AS x
    UNION ALL SELECT false, w_id, date, amount, {key('description')} FROM <<prior_filing>> AS y) AS z) AS s"""
    words = lambda c: f"list_distinct(list_filter(string_split({c}, ' '), lambda x: x <> ''))"
    alone = lambda x, y: f"array_to_string(list_sort(list_filter({x}, lambda v: NOT list_contains({y}, v))), ' ')"
    # The longest common subsequence of the words that one side has alone, one bit per letter of a's.
    masks = """list_transform(string_split(own_b, ''), lambda ch: list_aggregate(list_transform(range(1, length(own_a) + 1),
      lambda i: CASE WHEN substr(own_a, i, 1) = ch THEN CAST(1 AS HUGEINT) << CAST(i - 1 AS INT) ELSE CAST(0 AS HUGEINT) END), 'bit_or'))"""
    common = f"length(own_a) - bit_count(list_reduce(list_prepend(ones, {masks}), lambda row, m: ((row + (row & m)) | (row - (row & m))) & ones))"
    full = lambda own: f"(length(base) + CASE WHEN base = '' OR {own} = '' THEN 0 ELSE 1 END + length({own}))"
    alike = f"""1 - (length(own_a) + length(own_b) - 2 * CASE WHEN own_a = '' OR own_b = '' THEN 0 ELSE {common} END) / CAST({full('own_a')} + {full('own_b')} AS DOUBLE)"""
    scores = f"""
texts AS MATERIALIZED (SELECT *, array_to_string(list_sort(list_intersect(x, y)), ' ') AS base, {alone('x', 'y')} AS own_a, {alone('y', 'x')} AS own_b
  FROM (SELECT DISTINCT a, b, {words('a')} AS x, {words('b')} AS y FROM q JOIN w USING (g) WHERE abs(date_diff('day', day, filed)) <= 3 AND amount = paid) AS t),
scored AS MATERIALIZED (SELECT a, b, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0::DOUBLE WHEN base <> '' AND (own_a = '' OR own_b = '') THEN 1.0::DOUBLE
  WHEN base = '' THEN {alike}
  ELSE greatest({alike}, 2.0::DOUBLE * length(base) / (length(base) + {full('own_a')}), 2.0::DOUBLE * length(base) / (length(base) + {full('own_b')})) END AS score
  FROM (SELECT *, (CAST(1 AS HUGEINT) << CAST(length(own_a) AS INT)) - 1 AS ones FROM texts) AS t),"""
    return sequential_sql(
        "SELECT id AS q_id, g, date AS day, amount, text AS a FROM l WHERE seeks", "SELECT id AS w_id, g, date AS filed, amount AS paid, text AS b FROM l WHERE NOT seeks",
        "abs(date_diff('day', day, filed)) <= 3 AND score >= 0.72", "score", rows, scores, "JOIN scored USING (a, b)",
        "SELECT r.q_id, r.w_id, score FROM r JOIN q ON q.q_id = r.q_id JOIN w ON w.w_id = r.w_id JOIN scored USING (a, b)")

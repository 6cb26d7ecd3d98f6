"""DuckDB-side definition of the fixture tables (mirrors sources/fixtures.py)."""

PREFIX = """
WITH log AS (
  SELECT event_id AS row_id, user_id AS uid,
         CAST(json_extract_string(props, '$.k') AS INT) AS aid,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
         CASE WHEN event_id % 10 < 7 THEN 'train'
              WHEN event_id % 10 < 9 THEN 'valid' ELSE 'test' END AS split,
         event_id % 5 AS fold
  FROM events),
ad AS (
  SELECT CAST(p_partkey AS INT) AS aid, p_brand AS campaignId, p_type AS advertiserId,
         p_size AS creativeSize, p_name AS adkw
  FROM part),
usr AS (
  SELECT c.c_custkey AS uid, c.c_nationkey AS lbs, c.c_mktsegment AS gender,
         CAST(floor(c.c_acctbal / 1000) AS INT) AS ability,
         CASE WHEN c.c_custkey % 10 = 0 THEN '-1' ELSE coalesce(o.kw1, '-1') END AS kw1
  FROM customer c LEFT JOIN (
    SELECT o_custkey, string_agg(CAST(o_orderkey % 97 AS VARCHAR), ' ' ORDER BY o_orderkey) AS kw1
    FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey),
m AS (SELECT * FROM log JOIN ad USING (aid) JOIN usr USING (uid))
"""


def q(body: str) -> str:
    """Prefix the fixture CTEs. ``body`` starts with ``, name AS (...)`` CTEs
    or directly with ``SELECT``."""
    body = body.strip()
    if body.startswith(","):
        return PREFIX + body
    return PREFIX + body

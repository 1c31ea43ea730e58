"""Relational queries: the text that runs on Spark over bound inputs, and the plain text it must agree with.

Where the two differ, the Spark text aggregates or removes duplicates before a join or an expansion,
so that a key with very many rows is reduced before the shuffle that would bring its rows together.
"""

from __future__ import annotations

import re

from acceptance.tables import ask

# Same text on both sides, apart from the names of the tables.
SHARED = {
    "filter_project": """
        SELECT l_orderkey, l_linenumber, l_quantity
        FROM SALES.tpch.lineitem
        WHERE l_shipdate >= TIMESTAMP '1995-01-01 00:00:00' AND l_discount BETWEEN 0.02 AND 0.05
          AND l_returnflag IN ('A', 'R') AND l_linestatus LIKE 'F%'""",
    "full_join": """
        SELECT COALESCE(a.k, b.k) AS k, a.n AS n_cust, b.n AS n_supp
        FROM (SELECT c_nationkey AS k, COUNT(*) AS n FROM CRM.tpch.customer WHERE c_nationkey < 15 GROUP BY c_nationkey) a
        FULL JOIN (SELECT s_nationkey AS k, COUNT(*) AS n FROM CRM.tpch.supplier WHERE s_nationkey > 5 GROUP BY s_nationkey) b
          ON a.k = b.k""",
    "scalar_subquery": """
        SELECT o_orderkey FROM SALES.tpch.orders
        WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM SALES.tpch.orders)""",
    "correlated_scalar": """
        SELECT o_orderkey FROM SALES.tpch.orders o
        WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM SALES.tpch.orders i WHERE i.o_custkey = o.o_custkey)""",
    "cte_having": """
        WITH t AS (SELECT o_custkey, COUNT(*) AS n FROM SALES.tpch.orders GROUP BY o_custkey HAVING COUNT(*) > 10)
        SELECT o_custkey, n FROM t""",
    "distinct_agg": """
        SELECT event_type, COUNT(DISTINCT user_id) AS users, COUNT(*) AS n FROM WEB.tpch.events GROUP BY event_type""",
    "top_k": """
        SELECT o_orderkey, o_totalprice FROM SALES.tpch.orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "union_all": """
        SELECT c_nationkey AS k FROM CRM.tpch.customer UNION ALL SELECT s_nationkey AS k FROM CRM.tpch.supplier""",
    "union_distinct": """
        SELECT c_nationkey AS k FROM CRM.tpch.customer UNION SELECT s_nationkey AS k FROM CRM.tpch.supplier""",
    "date_fn": """
        SELECT o_orderkey, CAST(YEAR(o_orderdate) AS BIGINT) AS y, CAST(MONTH(o_orderdate) AS BIGINT) AS m,
          CAST(o_orderdate AS DATE) AS d, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS mon
        FROM SALES.tpch.orders""",
    "math_case_fn": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ABS(l_discount - 0.05) AS dd,
          CAST(FLOOR(l_quantity / 10) AS BIGINT) AS q10,
          CASE WHEN l_quantity < 10 THEN 'lo' WHEN l_quantity < 30 THEN 'mid' ELSE 'hi' END AS band,
          COALESCE(NULLIF(l_returnflag, 'N'), 'none') AS rf
        FROM SALES.tpch.lineitem""",
}

# (text for Spark, text to agree with). Money is summed in whole cents: as exact as decimals, and much faster over many
# groups; a sum beyond a bigint would be an error, not a wrong result.
PAIRS = {
    "inner_join_agg": (
        """
        SELECT c_mktsegment, SUM(n) AS n_orders, CAST(SUM(CAST(cents AS DECIMAL(20,0))) / 100 AS DOUBLE) AS revenue
        FROM (SELECT o_custkey, COUNT(*) AS n, SUM(CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS cents
              FROM SALES.tpch.orders GROUP BY o_custkey)
        JOIN CRM.tpch.customer ON o_custkey = c_custkey
        GROUP BY c_mktsegment""",
        """
        SELECT c_mktsegment, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    ),
    "multi_way_join": (
        """
        WITH lines AS (
               SELECT l_orderkey, COUNT(*) AS n, SUM(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)) AS cents
               FROM SALES.tpch.lineitem GROUP BY l_orderkey),
             bought AS (SELECT o_custkey, SUM(n) AS n, SUM(cents) AS cents
                        FROM lines JOIN SALES.tpch.orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
             by_nation AS (SELECT c_nationkey, SUM(n) AS n, SUM(CAST(cents AS DECIMAL(20,0))) AS cents
                           FROM bought JOIN CRM.tpch.customer ON o_custkey = c_custkey GROUP BY c_nationkey)
        SELECT r_name, n_name, SUM(n) AS n_lines, CAST(SUM(cents) / 100 AS DOUBLE) AS gross
        FROM by_nation JOIN GEO.tpch.nation ON c_nationkey = n_nationkey
        JOIN GEO.tpch.region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""",
        """
        SELECT r_name, n_name, COUNT(*) AS n_lines, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name""",
    ),
    "left_join": (
        """
        SELECT c_custkey, SUM(COALESCE(n, 0)) AS n_big
        FROM CRM.tpch.customer LEFT JOIN (
          SELECT o_custkey, COUNT(o_orderkey) AS n FROM SALES.tpch.orders WHERE o_totalprice > 400000 GROUP BY o_custkey)
          ON c_custkey = o_custkey
        GROUP BY c_custkey""",
        """
        SELECT c_custkey, COUNT(o_orderkey) AS n_big
        FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) o ON c_custkey = o_custkey
        GROUP BY c_custkey""",
    ),
    "right_join": (
        """
        SELECT n_name, SUM(COALESCE(n, 0)) AS n_supp
        FROM (SELECT s_nationkey, COUNT(s_suppkey) AS n FROM CRM.tpch.supplier GROUP BY s_nationkey)
        RIGHT JOIN GEO.tpch.nation ON s_nationkey = n_nationkey
        GROUP BY n_name""",
        """
        SELECT n_name, COUNT(s_suppkey) AS n_supp FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey
        GROUP BY n_name""",
    ),
    "semi_join_exists": (
        """
        SELECT c_custkey, c_name FROM CRM.tpch.customer
        WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM SALES.tpch.orders WHERE o_totalprice > 400000)
                      WHERE o_custkey = c_custkey)""",
        """
        SELECT c_custkey, c_name FROM customer
        WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    ),
    "anti_join_not_exists": (
        """
        SELECT c_custkey, c_name FROM CRM.tpch.customer
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey FROM SALES.tpch.orders WHERE o_totalprice > 400000)
                          WHERE o_custkey = c_custkey)""",
        """
        SELECT c_custkey, c_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
    ),
    "in_subquery": (
        """
        SELECT p_partkey FROM SALES.tpch.part
        WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM SALES.tpch.lineitem WHERE l_quantity >= 50)""",
        """
        SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)""",
    ),
    "rollup_agg": (
        """
        SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus) AS BIGINT) AS g1,
          CAST(GROUPING(o_orderpriority) AS BIGINT) AS g2, SUM(n) AS n
        FROM (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n FROM SALES.tpch.orders
              GROUP BY o_orderstatus, o_orderpriority)
        GROUP BY ROLLUP(o_orderstatus, o_orderpriority)""",
        """
        SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus) AS BIGINT) AS g1,
          CAST(GROUPING(o_orderpriority) AS BIGINT) AS g2, COUNT(*) AS n
        FROM orders GROUP BY ROLLUP(o_orderstatus, o_orderpriority)""",
    ),
    "cube_agg": (
        """
        SELECT l_returnflag, l_linestatus, SUM(n) AS n
        FROM (SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM SALES.tpch.lineitem GROUP BY l_returnflag, l_linestatus)
        GROUP BY CUBE(l_returnflag, l_linestatus)""",
        """
        SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY CUBE(l_returnflag, l_linestatus)""",
    ),
    "grouping_sets_agg": (
        """
        SELECT l_returnflag, l_linestatus, SUM(n) AS n
        FROM (SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM SALES.tpch.lineitem GROUP BY l_returnflag, l_linestatus)
        GROUP BY GROUPING SETS((l_returnflag), (l_linestatus), ())""",
        """
        SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem
        GROUP BY GROUPING SETS((l_returnflag), (l_linestatus), ())""",
    ),
    "intersect_distinct": (
        """
        SELECT DISTINCT c_nationkey AS k FROM CRM.tpch.customer
        INTERSECT SELECT DISTINCT s_nationkey AS k FROM CRM.tpch.supplier""",
        """
        SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey AS k FROM supplier""",
    ),
    "except_distinct": (
        """
        SELECT DISTINCT c_custkey AS k FROM CRM.tpch.customer
        EXCEPT SELECT DISTINCT o_custkey AS k FROM SALES.tpch.orders WHERE o_totalprice > 400000""",
        """
        SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey AS k FROM orders WHERE o_totalprice > 400000""",
    ),
    "string_fn": (
        """
        SELECT c_custkey, UPPER(c_name) AS u, CAST(LENGTH(c_name) AS BIGINT) AS len, SUBSTRING(c_name, 1, 8) AS pre,
          CONCAT(c_mktsegment, '-', CAST(c_nationkey AS VARCHAR(10))) AS seg, REPLACE(c_name, '#', '_') AS rep
        FROM CRM.tpch.customer""",
        # The other engine's CONCAT skips nulls.
        """
        SELECT c_custkey, UPPER(c_name) AS u, CAST(LENGTH(c_name) AS BIGINT) AS len, SUBSTRING(c_name, 1, 8) AS pre,
          c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR(10)) AS seg, REPLACE(c_name, '#', '_') AS rep
        FROM customer""",
    ),
    "json_fn": (
        """
        SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM WEB.tpch.events""",
        """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    ),
    # Every seventh text is cut off and every eleventh is null; what cannot be read is null.
    "json_struct_fn": (
        """
        SELECT event_id, s.k AS k, to_json(named_struct('k', s.k)) AS again
        FROM (SELECT event_id, from_json(CASE WHEN event_id % 11 = 3 THEN NULL WHEN event_id % 7 = 1
                THEN SUBSTRING(props, 1, LENGTH(props) - 1) ELSE props END, 'k INT') AS s FROM WEB.tpch.events)""",
        """
        SELECT event_id, k, CASE WHEN k IS NOT NULL THEN '{"k":' || k || '}' WHEN props IS NOT NULL AND event_id % 11 <> 3 THEN '{}'
          ELSE CASE WHEN event_id % 11 = 3 OR props IS NULL THEN '{}' END END AS again
        FROM (SELECT event_id, props, CASE WHEN event_id % 11 = 3 OR event_id % 7 = 1 THEN NULL
                ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events)""",
    ),
}

def queries() -> dict:
    texts = {**SHARED, **{key: pair[0] for key, pair in PAIRS.items()}}
    return {key: lambda spark, sf_dir, sql=sql: ask(spark, sf_dir, sql) for key, sql in texts.items()}


def oracle_sql() -> dict[str, str]:
    shared = {key: re.sub(r"\b(SALES|WEB|CRM|GEO)\.tpch\.", "", sql) for key, sql in SHARED.items()}
    return {**shared, **{key: pair[1] for key, pair in PAIRS.items()}}

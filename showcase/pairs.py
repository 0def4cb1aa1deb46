"""Pairs of tables to compare, derived from the given tables.

The texts run in Spark and in DuckDB alike and keep all columns.  Totals and amounts are
compared as DECIMAL, lines with their doubles as they are.
"""

ORDERS_SOURCE = """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       o_orderstatus, o_orderdate, o_orderpriority
FROM orders
"""

# Missing in the target, changed to null, changed, missing in the source, duplicated.
ORDERS_TARGET = """
SELECT o_orderkey AS order_id, o_custkey AS cust_id,
       CASE WHEN o_orderkey % 83 = 0 THEN NULL
            WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total,
       o_orderstatus AS status, o_orderdate AS ordered, o_orderpriority AS priority
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey + 10000000, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)),
       o_orderstatus, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 101 = 0
UNION ALL
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)),
       o_orderstatus, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 499 = 0
"""

# Orders of which one priority has another customer in places, one lacks orders, and one is gone.
ORDERS_PARTLY = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderkey % 53 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
       CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderstatus, o_orderdate, o_orderpriority
FROM orders
WHERE o_orderpriority <> '5-LOW' AND NOT (o_orderpriority = '1-URGENT' AND o_orderkey % 59 = 0)
"""

ORDERS_MAPPING = (
    "o_orderkey:order_id, o_custkey:cust_id, o_totalprice:total, o_orderstatus:status,"
    " o_orderdate:ordered, o_orderpriority:priority"
)
ORDERS_KEYS = "o_orderkey"

# The totals as a text file would hold them, some of them unreadable.
ORDERS_AS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS order_key, CAST(o_custkey AS VARCHAR(20)) AS cust_key,
       CASE WHEN o_orderkey % 13 = 0 THEN 'n/a'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(20)) END AS total,
       o_orderstatus AS status, o_orderdate AS ordered, o_orderpriority AS urgency
FROM orders
"""

ORDERS_TYPED = """
SELECT o_orderkey AS order_key, CAST(o_custkey AS BIGINT) AS cust_key,
       CASE WHEN o_orderkey % 83 = 0 THEN NULL
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total,
       CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS status,
       o_orderdate AS ordered, o_orderpriority AS priority
FROM orders WHERE o_orderkey % 97 <> 0
"""

# Orders whose columns have the names that results use themselves.
OWN_NAMES_SOURCE = """
SELECT o_orderkey AS kind, o_custkey AS src_n, CAST(o_totalprice AS DECIMAL(18,2)) AS uncastable,
       o_orderstatus AS __row, o_orderdate AS column_name, o_orderpriority AS repeated
FROM orders
"""

OWN_NAMES_TARGET = """
SELECT o_orderkey AS kind, CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_custkey END AS src_n,
       CAST(o_totalprice AS DECIMAL(18,2)) AS uncastable,
       CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderstatus END AS __row,
       o_orderdate AS column_name, o_orderpriority AS repeated
FROM orders WHERE o_orderkey % 97 <> 0
"""

# Whole vectors, some of them missing, null, of other labels or twice.
VECTORS_SOURCE = "SELECT vec_id, embedding, label FROM embeddings"

VECTORS_TARGET = """
SELECT vec_id, CASE WHEN vec_id % 29 = 0 THEN NULL ELSE embedding END AS embedding,
       CASE WHEN vec_id % 37 = 0 THEN label + 1 ELSE label END AS label
FROM embeddings WHERE vec_id % 23 <> 0
UNION ALL
SELECT vec_id + 100000000, embedding, label FROM embeddings WHERE vec_id % 41 = 0
"""

# Turns of conversations, as nested columns of two makes.
NESTED_SOURCE = """
SELECT conv_id, named_struct('turn', CAST(turn AS STRING), 'role', role, 'text', text) AS message,
       array(CAST(turn AS STRING), role) AS marks,
       map('n', if(turn % 2 = 0, '7', 'x')) AS notes,
       array(named_struct('at', CAST(turn AS DOUBLE) + 0.5, 'by', role)) AS steps
FROM conversations
"""

NESTED_TARGET = """
SELECT CAST(conv_id AS STRING) AS conv_id,
       named_struct('turn', turn, 'role', role, 'n_chars', length(text)) AS message,
       array(turn) AS marks, map('n', 1) AS notes, array(named_struct('at', turn, 'by', role)) AS steps
FROM conversations
"""

# The lines of a csv file of orders: some have too many fields, too few, or a quote that stays open.
ORDER_LINES = """
SELECT CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_orderkey AS VARCHAR(20)) || ',' || o_orderstatus || ',' || o_orderpriority || ',more,still more'
            WHEN o_orderkey % 23 = 0 THEN CAST(o_orderkey AS VARCHAR(20)) || ',' || o_orderstatus
            WHEN o_orderkey % 29 = 0 THEN CAST(o_orderkey AS VARCHAR(20)) || ',' || o_orderstatus || ',"' || o_orderpriority
            WHEN o_orderkey % 31 = 0 THEN CAST(o_orderkey AS VARCHAR(20)) || ',"' || o_orderstatus || ',' || o_orderpriority
            WHEN o_orderkey % 37 = 0 THEN CAST(o_orderkey AS VARCHAR(20)) || ',"' || o_orderstatus || ',",' || o_orderpriority
            ELSE CAST(o_orderkey AS VARCHAR(20)) || ',' || o_orderstatus || ',' || o_orderpriority END AS value,
       CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 23 = 0 THEN 1
            WHEN o_orderkey % 29 = 0 OR o_orderkey % 31 = 0 THEN 2 ELSE 0 END AS wrong
FROM orders
"""

# The key (l_orderkey, l_linenumber) is not unique.
LINES_SOURCE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
"""

LINES_TARGET = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_partkey % 53 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       l_extendedprice, l_discount, l_tax,
       CASE WHEN l_suppkey % 31 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem WHERE l_suppkey % 29 <> 0
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
       l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_suppkey % 23 = 0
"""

LINES_MAPPING = (
    "l_orderkey:l_orderkey, l_linenumber:l_linenumber, l_partkey:l_partkey, l_suppkey:l_suppkey,"
    " l_quantity:l_quantity, l_extendedprice:l_extendedprice, l_discount:l_discount, l_tax:l_tax,"
    " l_returnflag:l_returnflag, l_linestatus:l_linestatus, l_shipdate:l_shipdate"
)
LINES_KEYS = "l_orderkey, l_linenumber"

# Five keys hold all rows, so each of them is hot.
EVENTS_SOURCE = """
SELECT event_type, event_id, ts, user_id, CAST(value AS DECIMAL(18,2)) AS amount, props FROM events
"""

EVENTS_TARGET = """
SELECT event_type, event_id, ts, user_id,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS amount, props
FROM events WHERE user_id % 7 <> 0
"""

EVENTS_MAPPING = (
    "event_type:event_type, event_id:event_id, ts:ts, user_id:user_id, amount:amount, props:props"
)
EVENTS_KEYS = "event_type"

# A jobs table of one job per part; some mappings are empty, some are malformed.
JOBS_OF_PARTS = """
SELECT 'part-' || CAST(p_partkey AS VARCHAR(20)) AS job_name,
       'parquet' AS source_type, p_type AS source_location,
       CASE WHEN p_partkey % 7 = 0 THEN NULL
            WHEN p_partkey % 11 = 0 THEN 'p_partkey:id, p_brand'
            ELSE 'p_partkey : id,p_brand:' || p_brand || ', p_size:s' || CAST(p_size AS VARCHAR(20))
            END AS column_mapping,
       CASE WHEN p_size % 2 = 0 THEN 'source_to_target, record_count'
            ELSE ' Threshold,S2T ,schema_drift' END AS checks
FROM part
"""

# An audit table of one event per row of events.
AUDIT_OF_EVENTS = """
SELECT event_type AS job_name, 'run-' || CAST(user_id AS VARCHAR(20)) AS run_id,
       CASE event_id % 3 WHEN 0 THEN 'record_count' WHEN 1 THEN 's2t' ELSE 'threshold' END
           AS recon_type,
       CASE WHEN event_id % 401 = 0 THEN 'ERROR' WHEN event_id % 31 = 0 THEN 'FAILURE'
            WHEN event_id % 17 = 0 THEN 'WARNING' ELSE 'SUCCESS' END AS status,
       props AS message
FROM events
"""

JOB_FLAGS = """
SELECT DISTINCT event_type AS job_name,
       CASE WHEN event_type < 'p' THEN 'Y' ELSE 'N' END AS notify_on_success,
       CASE WHEN event_type > 'e' THEN 'Y' ELSE 'N' END AS notify_on_failure
FROM events
"""

RULE_FILTER = """
SELECT o_orderkey, o_custkey, o_totalprice FROM source_view WHERE o_totalprice > 400000
"""

RULE_JOIN_AGG = """
WITH lines AS (
  SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS line_total
  FROM lineitem GROUP BY l_orderkey
)
SELECT o_orderkey, o_totalprice, line_total
FROM source_view JOIN lines ON o_orderkey = l_orderkey
WHERE line_total > o_totalprice
"""

RULE_WINDOW = """
SELECT l_orderkey, COUNT(*) AS first_rows
FROM (SELECT l_orderkey, RANK() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
      FROM source_view) ranked
WHERE place = 1
GROUP BY l_orderkey HAVING COUNT(*) > 1
"""

RULE_TOTALS = """
SELECT o_custkey, COUNT(*) AS n_orders, CAST(SUM(o_totalprice) AS DECIMAL(18,2)) AS total
FROM source_view GROUP BY o_custkey
"""

TOTALS_TARGET = """
SELECT o_custkey AS cust_id, COUNT(*) + CASE WHEN o_custkey % 17 = 0 THEN 1 ELSE 0 END AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
FROM orders WHERE o_custkey % 41 <> 0 GROUP BY o_custkey
"""

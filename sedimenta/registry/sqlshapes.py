"""SQL twins of ``sources.shapes`` as inline views for the check queries."""

ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'processing' END AS status,
  o_orderpriority AS priority FROM orders)"""

DIRTY = """(SELECT
  CASE WHEN o_orderkey % 107 = 0 THEN NULL ELSE 'ORD' || o_orderkey END AS order_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'CUST' || o_custkey END AS customer_id,
  CASE WHEN o_orderkey % 109 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
  CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
  CASE WHEN o_orderkey % 127 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN 'invalid_status'
       WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'cancelled' END AS status,
  CASE WHEN o_orderkey % 131 = 0 THEN NULL WHEN o_orderkey % 83 = 0 THEN 'invalid-email'
       ELSE 'user' || o_custkey || '@mail.example.com' END AS email
  FROM (SELECT *, unnest(range(CASE WHEN o_orderkey % 53 = 0 THEN 2 ELSE 1 END)) AS copy_no FROM orders))"""

CUSTOMERS = """(SELECT 'CUST' || c_custkey AS customer_id,
  CASE WHEN c_custkey % 71 <> 0 THEN lower(replace(c_name,'#','.')) || '@' || lower(c_mktsegment) || '.example.com' END AS email,
  CASE WHEN c_custkey % 73 <> 0 THEN '555-010-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
  '900-55-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS ssn,
  upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) AS first_name, c_name AS last_name,
  (c_custkey % 500) || ' Main Street' AS address, n_name AS city, r_name AS state,
  lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
  lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS credit_card_last4,
  DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
  DATE '1994-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS signup_date,
  c_custkey % 2 = 0 AS consent_marketing, c_custkey % 3 <> 0 AS consent_data_sharing,
  c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMER_ORDERS = f"(SELECT * REPLACE ('CUST' || customer_id AS customer_id) FROM {ORDERS})"

PRODUCTS = """(SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
  CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.70 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS cost_price FROM part)"""

LINES = """(SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
  l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS line_total,
  CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag FROM lineitem)"""

CHANGES = """(SELECT user_id, event_type AS status, value AS amount, ts AS updated_at, event_id AS seq FROM events)"""

CUTOVER = "TIMESTAMP '2024-01-15 00:00:00'"

AUDIT = """(SELECT event_id AS audit_id, 'user' || user_id || '@corp.example.com' AS user_email,
  CASE user_id % 4 WHEN 0 THEN 'data_engineer' WHEN 1 THEN 'data_analyst' WHEN 2 THEN 'marketing_team' ELSE 'customer_service' END AS user_role,
  event_type AS action_type,
  CASE event_id % 5 WHEN 0 THEN 'silver.customers' WHEN 1 THEN 'silver.orders' WHEN 2 THEN 'silver.patient_records'
       WHEN 3 THEN 'gold.customers_masked' ELSE 'silver.products' END AS table_name,
  CAST(floor(value * 100) AS BIGINT) AS row_count, ts AS "timestamp", '10.0.0.' || (event_id % 3) AS ip_address,
  event_type <> 'error' AS success,
  CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'permission denied' WHEN 1 THEN 'timeout'
       WHEN 2 THEN 'table not found' ELSE 'row filter rejected' END END AS error_message FROM events)"""

RUNS = """(SELECT 'job_' || (user_id % 20) AS job_name, event_id AS run_id, ts AS start_time,
  ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time,
  CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'TIMEOUT' ELSE 'CANCELLED' END
       ELSE 'SUCCESS' END AS result_state, value AS execution_duration,
  CASE WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 'java.lang.OutOfMemoryError: heap'
       WHEN 1 THEN 'read timeout after 300 s' WHEN 2 THEN 'TableNotFoundException: silver.orders'
       WHEN 3 THEN 'AnalysisException: cannot resolve column' ELSE 'unknown' END END AS error_message FROM events)"""

EDGES = """(SELECT 'lake.t' || src AS source_table, 'lake.t' || k AS target_table,
  CASE WHEN p_type = 'PROMO' THEN 'VIEW' ELSE 'TABLE' END AS target_type,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(k % 100000 AS BIGINT)) AS created_at
  FROM (SELECT p_partkey AS k, p_type, unnest([CAST(floor(p_partkey / 2) AS BIGINT), CAST(floor(p_partkey / 3) AS BIGINT)]) AS src FROM part)
  WHERE src > 0)"""

METRICS = """(SELECT event_type AS metric_name, CAST(ts AS DATE) AS metric_date,
  round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS metric_value
  FROM events GROUP BY ALL)"""

REVIEWS = """(SELECT doc_id AS review_id, text AS review_text, CAST(doc_id % 5 + 1 AS BIGINT) AS rating, source, lang FROM documents)"""

# End of the data, the point in time relative dates start from.
EVENTS_END = "(SELECT max(ts) FROM events)"
ORDERS_END = "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"

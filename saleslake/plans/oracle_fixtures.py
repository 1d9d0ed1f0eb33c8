"""The fixture views in SQL (DuckDB dialect) for the oracle side of the check.
They restate ``saleslake.plans.fixtures`` independently, so the check compares
two separate derivations of each input."""

FIXTURE_CTES = """
sales_txn AS (
SELECT l.l_orderkey * 10 + l.l_linenumber AS txn_id,
       o.o_custkey AS cust_id,
       CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE l.l_partkey END AS prod_id,
       l.l_suppkey AS store_id,
       o.o_orderdate AS txn_datetime,
       CASE WHEN l.l_orderkey % 53 = 0 THEN CAST(0 AS DECIMAL(8,2)) ELSE CAST(l.l_quantity AS DECIMAL(8,2)) END AS sold_qty,
       CASE WHEN l.l_partkey % 89 = 0 THEN CAST(0 AS DECIMAL(12,4)) ELSE CAST(p.p_retailprice AS DECIMAL(12,4)) END AS unit_sell_price,
       CASE WHEN l.l_linenumber = 7 THEN NULL
            ELSE CAST(CAST(l.l_discount AS DECIMAL(5,2)) * CAST(p.p_retailprice AS DECIMAL(12,4)) AS DECIMAL(12,4)) END AS disc_amount,
       CASE WHEN l.l_linenumber = 1 THEN concat(' ', lower(r.r_name), ' ') ELSE r.r_name END AS store_region_cd,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN NULL ELSE 'GBP' END AS currency,
       o.o_orderpriority AS payment_type_cd,
       concat('T', CAST(l.l_suppkey AS VARCHAR)) AS terminal_ref,
       CASE WHEN o.o_orderkey % 31 = 0 THEN 'VOID' WHEN o.o_orderkey % 37 = 0 THEN 'CANCELLED'
            WHEN o.o_orderkey % 41 = 0 THEN 'TEST' WHEN o.o_orderkey % 43 = 0 THEN NULL ELSE 'COMPLETED' END AS txn_status_cd
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey),
stg_product AS (
SELECT p_partkey AS product_id, concat('P', CAST(p_partkey AS VARCHAR)) AS product_code,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_name END AS product_name,
       p_type AS category_code, p_brand AS subcategory_code, p_partkey % 100 AS supplier_id,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS cost_price,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) + CASE WHEN p_partkey % 7 = 0 THEN 10 ELSE 0 END AS DECIMAL(12,4)) AS list_price,
       CAST(NULL AS VARCHAR) AS tax_class_code,
       CASE WHEN p_partkey % 17 = 0 THEN 'N' ELSE 'Y' END AS is_active,
       DATE '1998-01-01' AS load_date
FROM part),
dim_product AS (
SELECT CAST(p_partkey * 2 + 1001 AS BIGINT) AS dim_product_key, p_partkey AS product_id,
       concat('P', CAST(p_partkey AS VARCHAR)) AS product_code, p_name AS product_name, p_type AS category_code,
       p_brand AS subcategory_code, p_partkey % 100 AS supplier_id,
       CAST(CAST(p_retailprice AS DECIMAL(12,4)) * CAST(0.7 AS DECIMAL(2,1)) AS DECIMAL(12,4)) AS cost_price,
       CAST(p_retailprice AS DECIMAL(12,4)) AS list_price,
       CASE WHEN p_partkey % 5 = 0 THEN DATE '1996-01-01' ELSE DATE '1995-01-01' END AS valid_from,
       DATE '9999-12-31' AS valid_to, 'Y' AS is_current, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END AS version_num,
       CAST(NULL AS VARCHAR) AS tax_class_code
FROM part WHERE p_partkey % 11 <> 0
UNION ALL
SELECT CAST(p_partkey * 2 + 1000 AS BIGINT), p_partkey, concat('P', CAST(p_partkey AS VARCHAR)), concat('old ', p_name), p_type,
       p_brand, p_partkey % 100, CAST(1 AS DECIMAL(12,4)), CAST(2 AS DECIMAL(12,4)),
       DATE '1995-01-01', DATE '1995-12-31', 'N', 1, CAST(NULL AS VARCHAR)
FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 5 = 0),
loyalty_profile AS (
SELECT c_custkey AS cust_id, c_mktsegment AS tier_cd, CAST(c_acctbal AS DECIMAL(14,2)) AS lifetime_spend
FROM customer WHERE c_custkey % 4 <> 0),
stg_customer AS (
SELECT c.c_custkey AS customer_id, concat('C', CAST(c.c_custkey AS VARCHAR)) AS customer_code,
       substring(c.c_name, 1, 8) AS first_name,
       CASE WHEN c.c_custkey % 19 = 0 THEN NULL ELSE substring(c.c_name, 10, 9) END AS last_name,
       lower(c.c_name) AS email, r.r_name AS region_code,
       coalesce(lp.tier_cd, 'STANDARD') AS loyalty_tier, lp.lifetime_spend AS lifetime_value, DATE '1998-01-01' AS load_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN loyalty_profile lp ON lp.cust_id = c.c_custkey),
dim_customer AS (
SELECT CAST(customer_id + 1000 AS BIGINT) AS dim_customer_key, customer_id, customer_code,
       concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name, email, region_code,
       CASE WHEN customer_id % 6 = 0 THEN 'BRONZE' ELSE loyalty_tier END AS loyalty_tier,
       DATE '1995-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, 'Y' AS is_current, 1 AS version_num
FROM stg_customer WHERE customer_id % 11 <> 0),
dim_store AS (
SELECT CAST(s_suppkey + 1000 AS BIGINT) AS dim_store_key, s_suppkey AS store_id, 'Y' AS is_current
FROM supplier WHERE s_suppkey % 10 <> 0),
supplier_feed AS (
SELECT p_partkey % 100 AS supplier_id, p_partkey AS product_id, CAST(p_retailprice + 5 AS DECIMAL(12,4)) AS list_price,
       CAST(600 AS DECIMAL(12,4)) AS cost_price, DATE '1997-06-01' AS effective_date FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT p_partkey % 100, p_partkey, CAST(p_retailprice + 6 AS DECIMAL(12,4)), CAST(610 AS DECIMAL(12,4)), DATE '1997-12-01'
FROM part WHERE p_partkey % 4 = 0),
src_customer AS (
SELECT c.c_custkey AS cust_id, concat('C', CAST(c.c_custkey AS VARCHAR)) AS cust_ref_cd,
       substring(c.c_name, 1, 8) AS first_nm,
       CASE WHEN c.c_custkey % 19 = 0 THEN NULL ELSE substring(c.c_name, 10, 9) END AS last_nm,
       c.c_name AS email_addr, concat('07', CAST(c.c_custkey AS VARCHAR)) AS mobile_phone,
       r.r_name AS home_region_cd, DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS reg_date
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
stg_customer_prev AS (
SELECT customer_id, customer_code, first_name, last_name, email, CAST(NULL AS VARCHAR) AS phone, region_code,
       loyalty_tier, lifetime_value, CAST(NULL AS DATE) AS registration_date,
       CAST(NULL AS TIMESTAMP) AS last_purchase_date, load_date
FROM stg_customer WHERE customer_id % 11 <> 0)
"""

"""DuckDB SQL for every check (the oracle side of the correctness gate).

Money stays DECIMAL until summed and leaves as DOUBLE; averages are
``double(sum) / double(count)``; exact ROUNDs that DuckDB would do in DOUBLE
are done in integer arithmetic instead.
"""

from __future__ import annotations

from .oracle_fixtures import FIXTURE_CTES

# derived layers: staging (extract), split, enrichment, keys, fact
DERIVED_CTES = """
staged AS (
SELECT txn_id AS transaction_id, cust_id AS customer_id, prod_id AS product_id, store_id,
       CAST(txn_datetime AS DATE) AS transaction_date, sold_qty AS quantity, unit_sell_price AS unit_price,
       COALESCE(disc_amount, CAST(0 AS DECIMAL(12,4))) AS discount_amt,
       CASE WHEN unit_sell_price > 0 THEN CAST(
            CAST((2 * CAST(COALESCE(disc_amount, 0) * 10000 AS BIGINT) * 10000 + CAST(unit_sell_price * 10000 AS BIGINT))
                 // (2 * CAST(unit_sell_price * 10000 AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2))
            ELSE CAST(0 AS DECIMAL(5,2)) END AS discount_pct,
       upper(trim(store_region_cd)) AS region_code,
       COALESCE(NULLIF(trim(currency), ''), 'GBP') AS currency_code,
       NULLIF(trim(payment_type_cd), '') AS payment_method, NULLIF(trim(terminal_ref), '') AS pos_terminal_id,
       CAST(txn_datetime AS DATE) AS load_date,
       CAST(strftime(CAST(txn_datetime AS DATE), '%Y%m%d') AS BIGINT) AS load_batch_id,
       upper(trim(store_region_cd)) || '_txn_' || strftime(CAST(txn_datetime AS DATE), '%Y-%m-%d') AS source_file_name,
       'PENDING' AS etl_status
FROM sales_txn
WHERE NULLIF(trim(txn_status_cd), '') NOT IN ('VOID', 'CANCELLED', 'TEST') AND sold_qty > 0 AND unit_sell_price >= 0),
pending AS (SELECT * FROM staged WHERE etl_status = 'PENDING'),
valid AS (SELECT * FROM pending WHERE COALESCE(quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL, false)),
rejects AS (SELECT * FROM pending WHERE NOT COALESCE(quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL, false)),
enriched AS (
SELECT transaction_id, customer_id, product_id, store_id, transaction_date, quantity, unit_price,
       COALESCE(discount_amt, 0) AS discount_amt,
       quantity * unit_price AS gross_amount,
       quantity * unit_price - COALESCE(discount_amt, 0) AS net_amount,
       CAST(year(transaction_date) AS BIGINT) AS fiscal_year,
       CAST(month(transaction_date) AS BIGINT) AS fiscal_month,
       upper(trim(region_code)) AS region_code,
       CASE WHEN currency_code IN ('USD', 'EUR') THEN 'GBP' ELSE currency_code END AS currency_code,
       CASE WHEN quantity * unit_price > 500 THEN 'PREMIUM' WHEN quantity * unit_price > 100 THEN 'STANDARD'
            ELSE 'BASIC' END AS basket_tier
FROM valid),
cur_product AS (SELECT * FROM dim_product WHERE is_current = 'Y'),
joined AS (
SELECT e.transaction_id, e.customer_id, e.product_id,
       COALESCE(d.product_code, 'UNKNOWN') AS product_code,
       COALESCE(d.product_name, 'UNKNOWN PRODUCT') AS product_name,
       COALESCE(d.category_code, 'UNCATEGORISED') AS category_code,
       COALESCE(d.subcategory_code, 'NONE') AS subcategory_code,
       e.store_id, e.transaction_date, e.quantity, e.unit_price, e.discount_amt, e.gross_amount, e.net_amount,
       e.region_code, e.currency_code, e.basket_tier, e.fiscal_year, e.fiscal_month
FROM enriched e LEFT JOIN cur_product d ON d.product_id = e.product_id),
keyed AS (
SELECT s.*, dp.dim_product_key, dc.dim_customer_key, ds.dim_store_key
FROM pending s
LEFT JOIN (SELECT product_id, dim_product_key FROM dim_product WHERE is_current = 'Y') dp ON dp.product_id = s.product_id
LEFT JOIN (SELECT customer_id, dim_customer_key FROM dim_customer WHERE is_current = 'Y') dc ON dc.customer_id = s.customer_id
LEFT JOIN (SELECT store_id, dim_store_key FROM dim_store WHERE is_current = 'Y') ds ON ds.store_id = s.store_id),
fact AS (
SELECT dim_product_key, dim_customer_key, dim_store_key, transaction_date,
       CAST(year(transaction_date) AS BIGINT) AS fiscal_year, CAST(month(transaction_date) AS BIGINT) AS fiscal_month,
       CAST(weekofyear(transaction_date) AS BIGINT) AS fiscal_week,
       quantity, unit_price, discount_amt,
       CAST(ROUND(quantity * unit_price, 4) AS DECIMAL(16,4)) AS gross_amount,
       CAST(ROUND(quantity * unit_price - discount_amt, 4) AS DECIMAL(16,4)) AS net_amount,
       CAST(ROUND((quantity * unit_price - discount_amt) * CAST(0.20 AS DECIMAL(3,2)), 4) AS DECIMAL(12,4)) AS tax_amount,
       region_code, COALESCE(currency_code, 'GBP') AS currency_code, load_date, load_batch_id
FROM keyed WHERE dim_product_key IS NOT NULL AND dim_customer_key IS NOT NULL),
buyers AS (
SELECT cust_id, max(txn_datetime) AS last_purchase_date FROM sales_txn
WHERE CAST(txn_datetime AS DATE) <= DATE '1998-01-01' GROUP BY cust_id),
cust_src AS (
SELECT c.cust_id AS customer_id, NULLIF(trim(c.cust_ref_cd), '') AS customer_code,
       NULLIF(trim(c.first_nm), '') AS first_name, NULLIF(trim(c.last_nm), '') AS last_name,
       lower(NULLIF(trim(c.email_addr), '')) AS email, NULLIF(trim(c.mobile_phone), '') AS phone,
       c.home_region_cd AS region_code,
       COALESCE(lp.tier_cd, 'STANDARD') AS loyalty_tier, lp.lifetime_spend AS lifetime_value,
       c.reg_date AS registration_date, b.last_purchase_date, DATE '1998-01-01' AS load_date
FROM src_customer c JOIN buyers b ON b.cust_id = c.cust_id LEFT JOIN loyalty_profile lp ON lp.cust_id = c.cust_id),
cust_upserted AS (
SELECT COALESCE(t.customer_id, s.customer_id) AS customer_id,
       CASE WHEN t.customer_id IS NOT NULL THEN t.customer_code ELSE s.customer_code END AS customer_code,
       CASE WHEN t.customer_id IS NOT NULL THEN t.first_name ELSE s.first_name END AS first_name,
       CASE WHEN t.customer_id IS NOT NULL THEN t.last_name ELSE s.last_name END AS last_name,
       CASE WHEN t.customer_id IS NOT NULL THEN t.email ELSE s.email END AS email,
       CASE WHEN t.customer_id IS NOT NULL THEN t.phone ELSE s.phone END AS phone,
       CASE WHEN t.customer_id IS NOT NULL THEN t.region_code ELSE s.region_code END AS region_code,
       CASE WHEN s.customer_id IS NOT NULL THEN s.loyalty_tier ELSE t.loyalty_tier END AS loyalty_tier,
       CASE WHEN s.customer_id IS NOT NULL THEN s.lifetime_value ELSE t.lifetime_value END AS lifetime_value,
       CASE WHEN t.customer_id IS NOT NULL THEN t.registration_date ELSE s.registration_date END AS registration_date,
       CASE WHEN s.customer_id IS NOT NULL THEN s.last_purchase_date ELSE t.last_purchase_date END AS last_purchase_date,
       CASE WHEN s.customer_id IS NOT NULL THEN s.load_date ELSE t.load_date END AS load_date
FROM stg_customer_prev t FULL OUTER JOIN cust_src s ON t.customer_id = s.customer_id),
ytd AS (
SELECT d.customer_id, CAST(SUM(f.net_amount) AS DOUBLE) AS total_spend_ytd, CAST(COUNT(*) AS BIGINT) AS txn_count_ytd
FROM fact f JOIN dim_customer d ON d.dim_customer_key = f.dim_customer_key
WHERE f.transaction_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
GROUP BY d.customer_id),
stg_active AS (SELECT * FROM stg_product WHERE load_date = DATE '1998-01-01' AND is_active = 'Y'),
prod_cls AS (
SELECT s.*, c.dim_product_key AS cur_key, c.valid_from AS cur_valid_from, c.version_num AS cur_version,
       CASE WHEN c.product_id IS NULL THEN 'NEW'
            WHEN COALESCE(c.product_name, 'X') <> COALESCE(s.product_name, 'X')
              OR COALESCE(c.category_code, 'X') <> COALESCE(s.category_code, 'X')
              OR COALESCE(c.list_price, 0) <> COALESCE(s.list_price, 0)
              OR COALESCE(c.cost_price, 0) <> COALESCE(s.cost_price, 0)
              OR COALESCE(c.supplier_id, 0) <> COALESCE(s.supplier_id, 0) THEN 'CHANGED'
            ELSE 'SAME' END AS change_class
FROM stg_active s LEFT JOIN cur_product c ON c.product_id = s.product_id),
dim_product_after AS (
SELECT dim_product_key, product_id, product_code, product_name, category_code, subcategory_code, supplier_id,
       cost_price, list_price, valid_from, valid_to, is_current, version_num, tax_class_code
FROM dim_product
WHERE NOT (is_current = 'Y' AND product_id IN (SELECT product_id FROM prod_cls WHERE change_class = 'CHANGED'))
UNION ALL
SELECT d.dim_product_key, d.product_id, d.product_code, d.product_name, d.category_code, d.subcategory_code,
       d.supplier_id, d.cost_price, d.list_price, d.valid_from, DATE '1997-12-31', 'N', d.version_num, d.tax_class_code
FROM dim_product d JOIN prod_cls p ON p.product_id = d.product_id AND p.change_class = 'CHANGED'
WHERE d.is_current = 'Y'
UNION ALL
SELECT (SELECT max(dim_product_key) FROM dim_product) + row_number() OVER (ORDER BY p.product_id),
       p.product_id, p.product_code, p.product_name, p.category_code, p.subcategory_code, p.supplier_id,
       p.cost_price, p.list_price, DATE '1998-01-01', DATE '9999-12-31', 'Y',
       COALESCE((SELECT max(v.version_num) FROM dim_product v WHERE v.product_id = p.product_id), 0) + 1,
       p.tax_class_code
FROM prod_cls p WHERE p.change_class IN ('NEW', 'CHANGED')),
cust_stage AS (
SELECT customer_id, customer_code, concat(coalesce(first_name, ''), ' ', coalesce(last_name, '')) AS full_name,
       email, region_code, loyalty_tier
FROM stg_customer WHERE load_date = DATE '1998-01-01' AND customer_id IS NOT NULL),
cust_cls AS (
SELECT s.*, CASE WHEN c.customer_id IS NULL THEN 'NEW'
            WHEN COALESCE(c.full_name, 'X') <> COALESCE(s.full_name, 'X')
              OR COALESCE(c.email, 'X') <> COALESCE(s.email, 'X')
              OR COALESCE(c.loyalty_tier, 'X') <> COALESCE(s.loyalty_tier, 'X') THEN 'CHANGED'
            ELSE 'SAME' END AS change_class
FROM cust_stage s LEFT JOIN (SELECT * FROM dim_customer WHERE is_current = 'Y') c ON c.customer_id = s.customer_id),
dim_customer_after AS (
  SELECT * FROM dim_customer
  WHERE NOT (is_current = 'Y' AND customer_id IN (SELECT customer_id FROM cust_cls WHERE change_class = 'CHANGED'))
  UNION ALL
  SELECT d.dim_customer_key, d.customer_id, d.customer_code, d.full_name, d.email, d.region_code, d.loyalty_tier,
         d.valid_from, DATE '1997-12-31', 'N', d.version_num
  FROM dim_customer d JOIN cust_cls c ON c.customer_id = d.customer_id AND c.change_class = 'CHANGED'
  WHERE d.is_current = 'Y'
  UNION ALL
  SELECT (SELECT max(dim_customer_key) FROM dim_customer) + row_number() OVER (ORDER BY c.customer_id),
         c.customer_id, c.customer_code, c.full_name, c.email, c.region_code, c.loyalty_tier,
         DATE '1998-01-01', DATE '9999-12-31', 'Y',
         COALESCE((SELECT max(v.version_num) FROM dim_customer v WHERE v.customer_id = c.customer_id), 0) + 1
  FROM cust_cls c WHERE c.change_class IN ('NEW', 'CHANGED')),
rollup AS (
SELECT region_code, transaction_date AS summary_date, category_code, fiscal_year, fiscal_month,
       CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       CAST(SUM(gross_amount) AS DOUBLE) AS total_gross_revenue,
       CAST(SUM(net_amount) AS DOUBLE) AS total_net_revenue,
       CAST(SUM(discount_amt) AS DOUBLE) AS total_discount_amount,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT product_id) AS BIGINT) AS distinct_products,
       CAST(COUNT(DISTINCT store_id) AS BIGINT) AS distinct_stores,
       CAST(SUM(net_amount) AS DOUBLE) / CAST(greatest(COUNT(*), 1) AS DOUBLE) AS avg_basket_value
FROM joined GROUP BY region_code, transaction_date, category_code, fiscal_year, fiscal_month),
summary AS (
SELECT region_code, transaction_date AS summary_date, CAST(COUNT(*) AS BIGINT) AS total_transactions,
       SUM(quantity) AS total_quantity, SUM(net_amount) AS total_revenue,
       CAST(COUNT(DISTINCT dim_customer_key) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT dim_product_key) AS BIGINT) AS distinct_products,
       CAST(SUM(net_amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_basket_size
FROM fact GROUP BY region_code, transaction_date),
fact_counts AS (
SELECT region_code, transaction_date, CAST(COUNT(*) AS BIGINT) AS row_count FROM fact GROUP BY region_code, transaction_date)
"""

PREFIX = "WITH " + FIXTURE_CTES.strip() + ",\n" + DERIVED_CTES.strip()

CHECK_SQL: dict[str, str] = {}

CHECK_SQL["scan_txn_day_region"] = """
SELECT txn_id AS transaction_id, cust_id AS customer_id, prod_id AS product_id, store_id,
       CAST(txn_datetime AS DATE) AS transaction_date, CAST(sold_qty AS DOUBLE) AS quantity,
       CAST(unit_sell_price AS DOUBLE) AS unit_price, CAST(disc_amount AS DOUBLE) AS discount_amt,
       CAST(CASE WHEN unit_sell_price > 0 THEN CAST(
            CAST((2 * CAST(COALESCE(disc_amount, 0) * 10000 AS BIGINT) * 10000 + CAST(unit_sell_price * 10000 AS BIGINT))
                 // (2 * CAST(unit_sell_price * 10000 AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(5,2))
            ELSE CAST(0 AS DECIMAL(5,2)) END AS DOUBLE) AS discount_pct,
       store_region_cd AS region_code, currency AS currency_code, payment_type_cd AS payment_method,
       CAST(strftime(CAST(txn_datetime AS DATE), '%Y%m%d') AS BIGINT) AS load_batch_id
FROM sales_txn WHERE NULLIF(trim(txn_status_cd), '') = 'COMPLETED' AND sold_qty > 0
"""

CHECK_SQL["dim_product_current"] = """
SELECT product_id, product_code, product_name, category_code, subcategory_code,
       CAST(list_price AS DOUBLE) AS list_price, is_current, valid_from, valid_to
FROM dim_product WHERE is_current = 'Y'
"""

_STAGED_OUT = """
SELECT transaction_id, customer_id, product_id, store_id, transaction_date, CAST(quantity AS DOUBLE) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amt AS DOUBLE) AS discount_amt,
       CAST(discount_pct AS DOUBLE) AS discount_pct, region_code, currency_code, payment_method, pos_terminal_id,
       load_date, load_batch_id, source_file_name, etl_status
FROM {src}
"""
CHECK_SQL["extract_sales"] = _STAGED_OUT.format(src="staged")
CHECK_SQL["valid_sales"] = _STAGED_OUT.format(src="valid")

CHECK_SQL["reject_sales"] = """
SELECT transaction_id, region_code, transaction_date,
       concat_ws('; ',
                 CASE WHEN COALESCE(quantity <= 0, true) THEN 'INVALID_QUANTITY' END,
                 CASE WHEN COALESCE(unit_price <= 0, true) THEN 'INVALID_PRICE' END,
                 CASE WHEN product_id IS NULL THEN 'MISSING_PRODUCT' END) AS rejection_reason,
       '1998-01-02 02:00:00' AS rejected_at
FROM rejects
"""

CHECK_SQL["enrich_sales"] = """
SELECT transaction_id, customer_id, product_id, store_id, transaction_date, CAST(quantity AS DOUBLE) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amt AS DOUBLE) AS discount_amt,
       CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(net_amount AS DOUBLE) AS net_amount,
       fiscal_year, fiscal_month, region_code, currency_code, basket_tier
FROM enriched
"""

_JOINED_OUT = """
SELECT transaction_id, customer_id, product_id, product_code, product_name, category_code, subcategory_code,
       store_id, transaction_date, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_amt AS DOUBLE) AS discount_amt, CAST(gross_amount AS DOUBLE) AS gross_amount,
       CAST(net_amount AS DOUBLE) AS net_amount, region_code, currency_code, basket_tier, fiscal_year, fiscal_month
FROM joined
"""
CHECK_SQL["join_product_left"] = _JOINED_OUT

CHECK_SQL["unmatched_product"] = """
SELECT product_id, transaction_id, customer_id, store_id, transaction_date, CAST(quantity AS DOUBLE) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_amt AS DOUBLE) AS discount_amt,
       CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(net_amount AS DOUBLE) AS net_amount,
       fiscal_year, fiscal_month, region_code, currency_code, basket_tier
FROM enriched e WHERE NOT EXISTS (SELECT 1 FROM cur_product d WHERE d.product_id = e.product_id)
"""

_ROLLUP = """
SELECT region_code, transaction_date AS summary_date, category_code, fiscal_year, fiscal_month,
       CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       CAST(SUM(gross_amount) AS DOUBLE) AS total_gross_revenue,
       CAST(SUM(net_amount) AS DOUBLE) AS total_net_revenue,
       CAST(SUM(discount_amt) AS DOUBLE) AS total_discount_amount,
       CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT product_id) AS BIGINT) AS distinct_products,
       CAST(COUNT(DISTINCT store_id) AS BIGINT) AS distinct_stores,
       CAST(SUM(net_amount) AS DOUBLE) / CAST(greatest(COUNT(*), 1) AS DOUBLE) AS avg_basket_value
FROM joined GROUP BY region_code, transaction_date, category_code, fiscal_year, fiscal_month
"""
CHECK_SQL["category_rollup"] = _ROLLUP

CHECK_SQL["summary_column_mapping"] = """
SELECT region_code, summary_date, category_code, total_transactions, total_quantity,
       total_net_revenue AS total_revenue, total_gross_revenue AS gross_revenue,
       avg_basket_value AS avg_basket_size, distinct_customers, distinct_products
FROM (""" + _ROLLUP + ") r"

_FACT_OUT = """
SELECT dim_product_key, dim_customer_key, dim_store_key, transaction_date, fiscal_year, fiscal_month, fiscal_week,
       CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_amt AS DOUBLE) AS discount_amt, CAST(gross_amount AS DOUBLE) AS gross_amount,
       CAST(net_amount AS DOUBLE) AS net_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
       region_code, currency_code, load_date, load_batch_id
FROM fact
"""
CHECK_SQL["fact_load"] = _FACT_OUT

CHECK_SQL["dropped_by_dims"] = """
SELECT transaction_id, product_id, customer_id, region_code, transaction_date,
       concat_ws('; ', CASE WHEN dim_product_key IS NULL THEN 'NO_CURRENT_PRODUCT' END,
                       CASE WHEN dim_customer_key IS NULL THEN 'NO_CURRENT_CUSTOMER' END) AS drop_reason
FROM keyed WHERE dim_product_key IS NULL OR dim_customer_key IS NULL
"""

CHECK_SQL["surrogate_keys"] = """
SELECT CAST(999 + row_number() OVER (ORDER BY dim_product_key NULLS FIRST, dim_customer_key NULLS FIRST,
            dim_store_key NULLS FIRST, transaction_date NULLS FIRST, fiscal_year NULLS FIRST, fiscal_month NULLS FIRST,
            fiscal_week NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST, discount_amt NULLS FIRST,
            gross_amount NULLS FIRST, net_amount NULLS FIRST, tax_amount NULLS FIRST, region_code NULLS FIRST,
            currency_code NULLS FIRST, load_date NULLS FIRST, load_batch_id NULLS FIRST) AS BIGINT) AS fact_sales_key,
       dim_product_key, dim_customer_key, dim_store_key, transaction_date, fiscal_year, fiscal_month, fiscal_week,
       CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_amt AS DOUBLE) AS discount_amt, CAST(gross_amount AS DOUBLE) AS gross_amount,
       CAST(net_amount AS DOUBLE) AS net_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
       region_code, currency_code, load_date, load_batch_id
FROM fact
"""

CHECK_SQL["regional_summary"] = """
SELECT region_code, transaction_date AS summary_date, CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity, CAST(SUM(net_amount) AS DOUBLE) AS total_revenue,
       CAST(COUNT(DISTINCT dim_customer_key) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT dim_product_key) AS BIGINT) AS distinct_products,
       CAST(SUM(net_amount) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_basket_size
FROM fact GROUP BY region_code, transaction_date
"""

CHECK_SQL["product_rankings"] = """
SELECT region_code, dim_product_key, fiscal_year, fiscal_month,
       CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(total_units AS DOUBLE) AS total_units,
       transaction_count, CAST(total_revenue AS DOUBLE) / CAST(transaction_count AS DOUBLE) AS avg_transaction_value,
       CAST(rank() OVER w AS BIGINT) AS revenue_rank, CAST(dense_rank() OVER w AS BIGINT) AS revenue_dense_rank,
       CAST(total_revenue AS DOUBLE) / NULLIF(CAST(SUM(total_revenue) OVER (PARTITION BY region_code, fiscal_year, fiscal_month) AS DOUBLE), 0) * 100
         AS revenue_pct_share
FROM (SELECT region_code, dim_product_key, fiscal_year, fiscal_month, SUM(net_amount) AS total_revenue,
             SUM(quantity) AS total_units, CAST(COUNT(*) AS BIGINT) AS transaction_count
      FROM fact GROUP BY region_code, dim_product_key, fiscal_year, fiscal_month) p
WINDOW w AS (PARTITION BY region_code, fiscal_year, fiscal_month ORDER BY total_revenue DESC NULLS LAST)
"""

CHECK_SQL["daily_summary"] = """
SELECT region_code, transaction_date, fiscal_year, fiscal_month, total_transactions,
       CAST(daily_revenue AS DOUBLE) AS daily_revenue, CAST(daily_units AS DOUBLE) AS daily_units,
       CAST(total_discounts AS DOUBLE) AS total_discounts, unique_customers, unique_products,
       CAST(daily_revenue AS DOUBLE) / CAST(total_transactions AS DOUBLE) AS avg_basket,
       CAST(SUM(daily_revenue) OVER (PARTITION BY region_code ORDER BY transaction_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_revenue_ytd,
       CAST(daily_revenue - lag(daily_revenue, 1) OVER (PARTITION BY region_code ORDER BY transaction_date) AS DOUBLE)
         AS revenue_vs_prev_day
FROM (SELECT region_code, transaction_date, fiscal_year, fiscal_month, CAST(COUNT(*) AS BIGINT) AS total_transactions,
             SUM(net_amount) AS daily_revenue, SUM(quantity) AS daily_units, SUM(discount_amt) AS total_discounts,
             CAST(COUNT(DISTINCT dim_customer_key) AS BIGINT) AS unique_customers,
             CAST(COUNT(DISTINCT dim_product_key) AS BIGINT) AS unique_products
      FROM fact GROUP BY region_code, transaction_date, fiscal_year, fiscal_month) d
"""

CHECK_SQL["customer_upsert"] = """
SELECT customer_id, customer_code, first_name, last_name, email, phone, region_code, loyalty_tier,
       CAST(lifetime_value AS DOUBLE) AS lifetime_value, registration_date, last_purchase_date, load_date
FROM cust_upserted
"""

CHECK_SQL["customer_ytd_spend"] = "SELECT customer_id, total_spend_ytd, txn_count_ytd FROM ytd"

CHECK_SQL["customer_segments"] = """
SELECT c.customer_id, c.customer_code, c.region_code, c.loyalty_tier, CAST(c.lifetime_value AS DOUBLE) AS lifetime_value,
       c.last_purchase_date, y.total_spend_ytd, y.txn_count_ytd,
       CASE WHEN c.lifetime_value > 5000 THEN 'HIGH_VALUE' WHEN c.lifetime_value > 1000 THEN 'MID_VALUE'
            WHEN c.lifetime_value > 100 THEN 'LOW_VALUE' ELSE 'PROSPECT' END AS clv_segment,
       CASE WHEN c.last_purchase_date IS NULL THEN 'UNKNOWN'
            WHEN date_diff('day', CAST(c.last_purchase_date AS DATE), DATE '1998-01-01') > 180 THEN 'HIGH'
            WHEN date_diff('day', CAST(c.last_purchase_date AS DATE), DATE '1998-01-01') > 90 THEN 'MEDIUM'
            ELSE 'LOW' END AS churn_risk
FROM cust_upserted c LEFT JOIN ytd y ON y.customer_id = c.customer_id
WHERE c.load_date >= DATE '1998-01-01' - INTERVAL 7 DAY
"""

CHECK_SQL["fiscal_parts"] = """
SELECT transaction_date, CAST(year(transaction_date) AS BIGINT) AS fiscal_year,
       CAST(month(transaction_date) AS BIGINT) AS fiscal_month,
       CAST(weekofyear(transaction_date) AS BIGINT) AS fiscal_week,
       'Q' || CAST(quarter(transaction_date) AS VARCHAR) AS fiscal_quarter
FROM (SELECT DISTINCT transaction_date FROM staged) d
"""

CHECK_SQL["scd2_change_class"] = "SELECT product_id, change_class FROM prod_cls"

_DIM_PRODUCT_OUT = """
SELECT dim_product_key, product_id, product_code, product_name, category_code, subcategory_code, supplier_id,
       CAST(cost_price AS DOUBLE) AS cost_price, CAST(list_price AS DOUBLE) AS list_price,
       valid_from, valid_to, is_current, CAST(version_num AS BIGINT) AS version_num, tax_class_code
FROM {src}
"""
CHECK_SQL["scd2_product"] = _DIM_PRODUCT_OUT.format(src="dim_product_after")


CHECK_SQL["purge_expired"] = _DIM_PRODUCT_OUT.format(
    src="dim_product WHERE NOT (is_current = 'N' AND valid_to < DATE '1998-01-01' - INTERVAL 730 DAY)")

CHECK_SQL["distinct_suppliers"] = """
SELECT DISTINCT supplier_id FROM dim_product_after
WHERE is_current = 'Y' AND valid_from = DATE '1998-01-01' AND supplier_id IS NOT NULL
"""

CHECK_SQL["scd2_customer"] = """
SELECT dim_customer_key, customer_id, customer_code, full_name, email, region_code, loyalty_tier,
       valid_from, valid_to, is_current, CAST(version_num AS BIGINT) AS version_num
FROM dim_customer_after
"""

EXTRA_CTES: dict[str, str] = {}


def check_sql(name: str) -> str:
    return PREFIX.rstrip() + EXTRA_CTES.get(name, "").rstrip() + "\n" + CHECK_SQL[name].strip()


def split_final(sql: str) -> tuple[str, str]:
    """(WITH-prefix, final statement) of a check's SQL."""
    name = None
    for n in CHECK_SQL:
        if sql.endswith(CHECK_SQL[n].strip()):
            name = n
            break
    final = CHECK_SQL[name].strip()
    return sql[: len(sql) - len(final)].rstrip(), final

_HIT = "is_current = 'Y' AND valid_from = DATE '1998-01-01'"
CHECK_SQL["category_rules"] = f"""
SELECT dim_product_key, product_id, product_code,
       CASE WHEN category_code = 'PROMO' AND {_HIT} THEN 'PROMO ' || product_name ELSE product_name END AS product_name,
       category_code,
       CASE WHEN category_code = 'SMALL' AND {_HIT} THEN subcategory_code || '-S' ELSE subcategory_code END
         AS subcategory_code,
       supplier_id,
       CAST(CASE WHEN category_code = 'ECONOMY' AND {_HIT} THEN CAST(ROUND(cost_price * 0.95, 4) AS DECIMAL(12,4))
                 ELSE cost_price END AS DOUBLE) AS cost_price,
       CAST(CASE WHEN category_code = 'PROMO' AND {_HIT} THEN CAST(ROUND(list_price * 0.90, 4) AS DECIMAL(12,4))
                 ELSE list_price END AS DOUBLE) AS list_price,
       valid_from, valid_to, is_current, CAST(version_num AS BIGINT) AS version_num, tax_class_code
FROM dim_product_after
"""

CHECK_SQL["supplier_enrich"] = """
SELECT d.dim_product_key, d.product_id, d.product_code, d.product_name, d.category_code, d.subcategory_code,
       d.supplier_id,
       CAST(CASE WHEN l.product_id IS NOT NULL THEN l.cost_price ELSE d.cost_price END AS DOUBLE) AS cost_price,
       CAST(CASE WHEN l.product_id IS NOT NULL THEN l.list_price ELSE d.list_price END AS DOUBLE) AS list_price,
       d.valid_from, d.valid_to, d.is_current, CAST(d.version_num AS BIGINT) AS version_num, d.tax_class_code
FROM dim_product_after d
LEFT JOIN (
  SELECT product_id, supplier_id, list_price, cost_price FROM (
    SELECT f.*, row_number() OVER (PARTITION BY f.product_id, f.supplier_id
                                   ORDER BY f.effective_date DESC, f.list_price DESC, f.cost_price DESC) AS rn
    FROM supplier_feed f
    WHERE f.effective_date <= DATE '1998-01-01'
      AND f.supplier_id IN (SELECT supplier_id FROM dim_product_after
                            WHERE is_current = 'Y' AND valid_from = DATE '1998-01-01' AND supplier_id IS NOT NULL)) x
  WHERE rn = 1) l
  ON l.product_id = d.product_id AND l.supplier_id = d.supplier_id AND d.is_current = 'Y'
"""

CHECK_SQL["staging_metrics"] = """
SELECT transaction_date, region_code, metric, value FROM (
  SELECT transaction_date, region_code,
         CAST(COUNT(*) AS BIGINT) AS TOTAL_ROWS,
         CAST(count_if(product_id IS NULL) AS BIGINT) AS NULL_PRODUCT_ID,
         CAST(count_if(customer_id IS NULL) AS BIGINT) AS NULL_CUSTOMER_ID,
         CAST(count_if(unit_price = 0) AS BIGINT) AS ZERO_AMOUNT_ROWS,
         CAST(COUNT(DISTINCT store_id) AS BIGINT) AS DISTINCT_STORES,
         CAST(COUNT(DISTINCT product_id) AS BIGINT) AS DISTINCT_PRODUCTS
  FROM staged GROUP BY transaction_date, region_code) m
UNPIVOT (value FOR metric IN (TOTAL_ROWS, NULL_PRODUCT_ID, NULL_CUSTOMER_ID, ZERO_AMOUNT_ROWS,
                              DISTINCT_STORES, DISTINCT_PRODUCTS))
"""

CHECK_SQL["row_count_gate"] = """
SELECT COALESCE(s.transaction_date, f.transaction_date) AS transaction_date,
       COALESCE(s.region_code, f.region_code) AS region_code,
       CAST(COALESCE(s.n, 0) AS BIGINT) AS staged_rows, CAST(COALESCE(f.row_count, 0) AS BIGINT) AS fact_rows,
       CASE WHEN COALESCE(s.n, 0) = 0 THEN 'EMPTY_NOOP' WHEN COALESCE(s.n, 0) < 5 THEN 'BELOW_MINIMUM'
            ELSE 'OK' END AS staging_gate,
       CASE WHEN COALESCE(f.row_count, 0) = 0 THEN 'FACT_EMPTY' ELSE 'FACT_LOADED' END AS fact_gate
FROM (SELECT transaction_date, region_code, COUNT(*) AS n FROM pending GROUP BY transaction_date, region_code) s
FULL OUTER JOIN fact_counts f ON f.transaction_date = s.transaction_date AND f.region_code = s.region_code
"""

CHECK_SQL["day_ratio_gate"] = """
SELECT c.region_code, c.transaction_date, c.row_count, p.row_count AS prev_row_count,
       CAST(c.row_count AS DOUBLE) / CAST(p.row_count AS DOUBLE) AS day_ratio,
       CASE WHEN c.row_count >= 5 AND (p.row_count IS NULL OR c.row_count >= p.row_count * 0.80)
            THEN 'Y' ELSE 'N' END AS gate_passed
FROM fact_counts c LEFT JOIN fact_counts p
  ON p.region_code = c.region_code AND p.transaction_date + 1 = c.transaction_date
"""

CHECK_SQL["audit_counts"] = """
SELECT region_code, summary_date, CAST(COUNT(*) AS BIGINT) AS rollup_rows FROM rollup GROUP BY region_code, summary_date
"""


def _pct_sql(failed: str, total: str) -> str:
    return (f"COALESCE(CAST(((2 * ({failed}) * 1000000 + ({total})) // NULLIF(2 * ({total}), 0)) AS DOUBLE) "
            f"/ 10000.0, 0.0)")


def _dq_row(rule_id, name, table, rtype, date_col, src, total, failed, pct, thr, severity):
    eff = f"COALESCE(NULLIF(CAST({thr} AS DOUBLE), 0.0), 0.01)"
    return f"""
SELECT CAST({rule_id} AS BIGINT) AS rule_id, '{name}' AS rule_name, '{table}' AS target_table,
       '{rtype}' AS rule_type, {date_col} AS check_date, CAST({total} AS BIGINT) AS total_rows,
       CAST({failed} AS BIGINT) AS failed_rows, {pct} AS fail_pct, CAST({thr} AS DOUBLE) AS threshold_pct,
       ({pct}) <= {eff} AS passed, CASE WHEN ({pct}) <= {eff} THEN 'PASS' ELSE 'FAIL' END AS status,
       '{severity}' AS severity
FROM {src} GROUP BY {date_col}"""


_F, _S = "fact", "summary"
_DQ = " UNION ALL ".join([
    _dq_row(1, "NULL_PRODUCT_KEY", "FACT_DAILY_SALES", "NULL_CHECK", "transaction_date", _F, "COUNT(*)",
            "COUNT(CASE WHEN dim_product_key IS NULL THEN 1 END)",
            _pct_sql("COUNT(CASE WHEN dim_product_key IS NULL THEN 1 END)", "COUNT(*)"), "0.0", "CRITICAL"),
    _dq_row(2, "NEGATIVE_NET_AMOUNT", "FACT_DAILY_SALES", "RANGE_CHECK", "transaction_date", _F, "COUNT(*)",
            "count_if(NOT (net_amount >= 0))", _pct_sql("count_if(NOT (net_amount >= 0))", "COUNT(*)"),
            "0.1", "WARNING"),
    _dq_row(3, "REGIONAL_SUMMARY_PRESENT", "FACT_REGIONAL_SUMMARY", "THRESHOLD_COUNT", "summary_date", _S,
            "COUNT(*)", "0", "0.0", "0.0", "CRITICAL"),
    _dq_row(4, "ZERO_PRICE_LINES", "FACT_DAILY_SALES", "GENERIC", "transaction_date", _F, "COUNT(*)",
            "count_if(unit_price = 0)", _pct_sql("count_if(unit_price = 0)", "COUNT(*)"), "5.0", "WARNING"),
    _dq_row(6, "SUMMARY_HAS_REVENUE", "FACT_REGIONAL_SUMMARY", "RANGE_CHECK", "summary_date", _S, "COUNT(*)",
            "count_if(NOT (total_revenue > 0))", _pct_sql("count_if(NOT (total_revenue > 0))", "COUNT(*)"),
            "0.0", "WARNING"),
]) + """ UNION ALL
SELECT CAST(5 AS BIGINT), 'BROKEN_RULE', 'FACT_DAILY_SALES', 'RANGE_CHECK', CAST(NULL AS DATE), CAST(NULL AS BIGINT),
       CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(0.0 AS DOUBLE), false, 'FAIL', 'ERROR'"""
CHECK_SQL["dq_results"] = "SELECT * FROM (" + _DQ + ") dq"

_FR = ("(SELECT f.*, (SELECT true FROM (SELECT DISTINCT dim_product_key FROM dim_product) p "
       "WHERE p.dim_product_key = f.dim_product_key) AS ref12, "
       "(SELECT true FROM (SELECT DISTINCT dim_store_key FROM dim_store) s "
       "WHERE s.dim_store_key = f.dim_store_key) AS ref13 FROM fact f) fr")
CHECK_SQL["dq_referential"] = "SELECT * FROM (" + " UNION ALL ".join([
    _dq_row(11, "FACT_STORE_KEY_SET", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "transaction_date", _F,
            "COUNT(*)", "count_if(dim_store_key IS NULL)", _pct_sql("count_if(dim_store_key IS NULL)", "COUNT(*)"),
            "50.0", "WARNING"),
    _dq_row(12, "FACT_PRODUCT_FK", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "transaction_date", _FR,
            "COUNT(*)", "count_if(ref12 IS NULL)", _pct_sql("count_if(ref12 IS NULL)", "COUNT(*)"),
            "0.0", "CRITICAL"),
    _dq_row(13, "FACT_STORE_FK", "FACT_DAILY_SALES", "REFERENTIAL_CHECK", "transaction_date", _FR,
            "COUNT(*)", "count_if(ref13 IS NULL)", _pct_sql("count_if(ref13 IS NULL)", "COUNT(*)"),
            "10.0", "WARNING"),
]) + ") dq"

CHECK_SQL["dq_summary"] = """
SELECT check_date, CAST(COUNT(*) AS BIGINT) AS total_rules, CAST(count_if(passed) AS BIGINT) AS passed_rules,
       CAST(count_if(NOT passed AND severity = 'CRITICAL') AS BIGINT) AS critical_failures,
       CAST(count_if(NOT passed AND severity <> 'CRITICAL') AS BIGINT) AS other_failures
FROM (""" + _DQ + """) dq GROUP BY check_date
"""


def _audit_rows(table: str, src: str, pk: str, not_null: list[str], widths: dict[str, int]) -> str:
    parts = [f"SELECT '{table}' AS table_name, 'NOT_NULL' AS constraint_type, '{c}' AS column_name, "
             f"CAST(count_if({c} IS NULL) AS BIGINT) AS violation_rows FROM {src}" for c in not_null]
    parts += [f"SELECT '{table}', 'WIDTH', '{c}', CAST(count_if(length({c}) > {w}) AS BIGINT) FROM {src}"
              for c, w in widths.items()]
    parts.append(f"SELECT '{table}', 'PK_UNIQUE', '{pk}', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM "
                 f"(SELECT {pk}, COUNT(*) AS n FROM {src} GROUP BY {pk} HAVING COUNT(*) > 1) d")
    return " UNION ALL ".join(parts)


CHECK_SQL["audit_pk"] = "SELECT * FROM (" + " UNION ALL ".join([
    _audit_rows("stg_sales", "staged", "transaction_id",
                ["transaction_id", "customer_id", "product_id", "store_id", "transaction_date", "region_code"],
                {"region_code": 10, "currency_code": 3, "payment_method": 20, "pos_terminal_id": 20,
                 "source_file_name": 200, "etl_status": 20}),
    _audit_rows("dim_product", "dim_product_after", "dim_product_key",
                ["dim_product_key", "product_id", "valid_from"],
                {"product_code": 20, "product_name": 200, "category_code": 10, "subcategory_code": 10}),
    _audit_rows("dim_customer", "dim_customer_after", "dim_customer_key",
                ["dim_customer_key", "customer_id", "valid_from"],
                {"customer_code": 20, "full_name": 200, "email": 200, "region_code": 10, "loyalty_tier": 20}),
]) + ") a"


def _fk_row(table, src, fk, parent_name, parent_keys):
    return (f"SELECT '{table}' AS table_name, '{fk}' AS column_name, '{parent_name}' AS parent_table, "
            f"CAST(COUNT(*) AS BIGINT) AS orphan_rows FROM {src} c WHERE c.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM ({parent_keys}) p WHERE p.k = c.{fk})")


CHECK_SQL["audit_fk"] = "SELECT * FROM (" + " UNION ALL ".join([
    _fk_row("fact_daily_sales", "fact", "dim_product_key", "dim_product", "SELECT dim_product_key AS k FROM dim_product"),
    _fk_row("fact_daily_sales", "fact", "dim_customer_key", "dim_customer",
            "SELECT dim_customer_key AS k FROM dim_customer"),
    _fk_row("fact_daily_sales", "fact", "dim_store_key", "dim_store", "SELECT dim_store_key AS k FROM dim_store"),
    _fk_row("stg_sales", "staged", "product_id", "dim_product",
            "SELECT product_id AS k FROM dim_product WHERE is_current = 'Y'"),
    _fk_row("stg_sales", "staged", "customer_id", "dim_customer",
            "SELECT customer_id AS k FROM dim_customer WHERE is_current = 'Y'"),
]) + ") f"

CHECK_SQL["entry"] = """
SELECT region_code, transaction_date AS summary_date, CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(quantity) AS DOUBLE) AS total_quantity,
       CAST(SUM(CAST(ROUND(quantity * unit_price - discount_amt, 4) AS DECIMAL(16,4))) AS DOUBLE) AS total_revenue,
       CAST(COUNT(DISTINCT dc.dim_customer_key) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT dp.dim_product_key) AS BIGINT) AS distinct_products,
       CAST(SUM(CAST(ROUND(quantity * unit_price - discount_amt, 4) AS DECIMAL(16,4))) AS DOUBLE)
         / CAST(COUNT(*) AS DOUBLE) AS avg_basket_size
FROM pending s
JOIN (SELECT product_id, dim_product_key FROM dim_product_after WHERE is_current = 'Y') dp ON dp.product_id = s.product_id
JOIN (SELECT customer_id, dim_customer_key FROM dim_customer_after WHERE is_current = 'Y') dc
  ON dc.customer_id = s.customer_id
GROUP BY region_code, transaction_date
"""

# sink round trips read back what the base check computes
CHECK_SQL["reject_sink"] = CHECK_SQL["reject_sales"]
CHECK_SQL["unmatched_sink"] = CHECK_SQL["unmatched_product"]
CHECK_SQL["fact_append"] = CHECK_SQL["fact_load"]
CHECK_SQL["staging_reload"] = CHECK_SQL["extract_sales"]
CHECK_SQL["summary_refresh"] = CHECK_SQL["regional_summary"]
CHECK_SQL["dq_result_sink"] = "SELECT q.*, DATE '1998-01-02' AS run_date FROM (" + CHECK_SQL["dq_results"] + ") q"
CHECK_SQL["analytical_outputs"] = """
SELECT 'segments' AS output, region_code, CAST(customer_id AS VARCHAR) AS subject,
       concat_ws('/', clv_segment, churn_risk) AS label, CAST(NULL AS DOUBLE) AS value FROM (""" + CHECK_SQL["customer_segments"] + """) s
UNION ALL SELECT 'rankings', region_code, concat_ws('-', dim_product_key, fiscal_year, fiscal_month),
       concat_ws('/', revenue_rank, revenue_dense_rank), total_revenue FROM (""" + CHECK_SQL["product_rankings"] + """) r
UNION ALL SELECT 'daily', region_code, CAST(transaction_date AS VARCHAR),
       concat_ws('/', total_transactions, unique_customers, unique_products), running_revenue_ytd FROM (""" + CHECK_SQL["daily_summary"] + ") d"
CHECK_SQL["incremental_load"] = CHECK_SQL["fact_load"]
CHECK_SQL["source_availability"] = """
SELECT CAST(txn_datetime AS DATE) AS business_date, CAST(COUNT(*) AS BIGINT) AS source_rows,
       CASE WHEN COUNT(*) > 0 THEN 'Y' ELSE 'N' END AS available
FROM sales_txn GROUP BY CAST(txn_datetime AS DATE)
"""

CHECK_SQL["incremental_summary"] = CHECK_SQL["regional_summary"]

# The store-backed job over the load date: a repeated transaction id is staged once (first in the order of all columns)
DAY_CTES = """
day_rows AS (
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id, transaction_date, region_code ORDER BY customer_id NULLS FIRST,
           product_id NULLS FIRST, store_id NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST, discount_amt NULLS FIRST,
           discount_pct NULLS FIRST, currency_code NULLS FIRST, payment_method NULLS FIRST, pos_terminal_id NULLS FIRST) AS nth
  FROM staged WHERE transaction_date = DATE '1998-01-01') r WHERE nth = 1),
day_fact AS (
SELECT s.*, CAST(ROUND(quantity * unit_price, 4) AS DECIMAL(16,4)) AS gross_amount,
       CAST(ROUND(quantity * unit_price - discount_amt, 4) AS DECIMAL(16,4)) AS net_amount,
       CAST(ROUND((quantity * unit_price - discount_amt) * CAST(0.20 AS DECIMAL(3,2)), 4) AS DECIMAL(12,4)) AS tax_amount
FROM day_rows s WHERE product_id IN (SELECT product_id FROM dim_product_after WHERE is_current = 'Y')
  AND customer_id IN (SELECT customer_id FROM dim_customer UNION SELECT cust_id FROM src_customer)),
day_valid AS (SELECT * FROM day_rows WHERE COALESCE(quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL, false)),
day_joined AS (
SELECT v.*, quantity * unit_price - discount_amt AS net_amount, d.product_id AS found,
       COALESCE(d.category_code, 'UNCATEGORISED') AS category_code
FROM day_valid v LEFT JOIN (SELECT product_id, category_code FROM dim_product_after WHERE is_current = 'Y') d USING (product_id)),
day_rollup AS (
SELECT region_code, category_code, COUNT(*) AS n, SUM(net_amount) AS net FROM day_joined GROUP BY region_code, category_code)
"""

EXTRA_CTES["daily_runs_fact"] = EXTRA_CTES["daily_runs_slices"] = ",\n" + DAY_CTES.strip()

CHECK_SQL["daily_runs_fact"] = """
SELECT transaction_date, region_code, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_amt AS DOUBLE) AS discount_amt, CAST(gross_amount AS DOUBLE) AS gross_amount,
       CAST(net_amount AS DOUBLE) AS net_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
       CAST(1998 AS BIGINT) AS fiscal_year, CAST(1 AS BIGINT) AS fiscal_month, CAST(1 AS BIGINT) AS fiscal_week,
       currency_code, load_date
FROM day_fact
"""

CHECK_SQL["daily_runs_slices"] = """
SELECT 'summary' AS output, region_code, CAST(1 AS BIGINT) AS n_rows, CAST(SUM(net_amount) AS DOUBLE) AS total
FROM day_fact GROUP BY region_code
UNION ALL SELECT 'rollup', region_code, CAST(COUNT(*) AS BIGINT), CAST(SUM(net) AS DOUBLE) FROM day_rollup GROUP BY region_code
UNION ALL SELECT 'category_summary', region_code, CAST(COUNT(*) AS BIGINT), CAST(SUM(n) AS DOUBLE) FROM day_rollup GROUP BY region_code
UNION ALL SELECT 'staging', region_code, CAST(COUNT(*) AS BIGINT), CAST(SUM(quantity) AS DOUBLE) FROM day_rows GROUP BY region_code
UNION ALL SELECT 'rejected', region_code, CAST(COUNT(*) AS BIGINT), CAST(0 AS DOUBLE) FROM day_rows
          WHERE NOT COALESCE(quantity > 0 AND unit_price > 0 AND product_id IS NOT NULL, false) GROUP BY region_code
UNION ALL SELECT 'unmatched', region_code, CAST(COUNT(*) AS BIGINT), CAST(0 AS DOUBLE) FROM day_joined
          WHERE found IS NULL GROUP BY region_code
"""

CHECK_SQL["region_routed"] = """
SELECT region_code, transaction_date, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM(quantity) AS DOUBLE) AS quantity,
       CASE WHEN region_code = 'AFRICA' THEN 'N' ELSE 'Y' END AS own_table
FROM staged WHERE region_code IN ('ASIA', 'EUROPE', 'AFRICA') GROUP BY region_code, transaction_date
"""
CHECK_SQL["column_defaults"] = """
SELECT txn_id AS transaction_id, CAST(COALESCE(disc_amount, 0) AS DOUBLE) AS discount_amt,
       COALESCE(NULLIF(TRIM(currency), ''), 'GBP') AS currency_code, 'PENDING' AS etl_status
FROM sales_txn
"""

EXTRA_CTES["parallel_regions"] = EXTRA_CTES["daily_runs_fact"]
CHECK_SQL["parallel_regions"] = """
SELECT region_code, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(COUNT(*) AS BIGINT) AS n_keys
FROM day_fact WHERE region_code IN ('ASIA', 'EUROPE') GROUP BY region_code
"""

CHECK_SQL["emptied_slice"] = """
SELECT 'staging' AS output, region_code, CAST(COUNT(*) AS BIGINT) AS n_rows FROM staged
WHERE transaction_date = DATE '1998-01-01' AND region_code <> 'ASIA' GROUP BY region_code
UNION ALL SELECT 'summary', region_code, CAST(1 AS BIGINT) FROM fact
WHERE transaction_date = DATE '1998-01-01' AND region_code <> 'ASIA' GROUP BY region_code
UNION ALL SELECT 'rejected', region_code, CAST(COUNT(*) AS BIGINT) FROM rejects
WHERE transaction_date = DATE '1998-01-01' AND region_code <> 'ASIA' GROUP BY region_code
"""

# A4 / A5: the product master file derived from part (see fixtures.product_master_file)
CHECK_SQL["product_master_csv"] = """
SELECT product_id, product_code, product_name, category_code, subcategory_code, supplier_id,
       CAST(cost_price AS DOUBLE) AS cost_price, CAST(list_price AS DOUBLE) AS list_price, tax_class_code,
       CAST(NULL AS DOUBLE) AS weight_kg,
       CASE WHEN product_id % 23 = 0 THEN 'Y' ELSE is_active END AS is_active,
       DATE '1998-01-01' AS effective_date, CAST(NULL AS DATE) AS expiry_date, DATE '1998-01-01' AS load_date
FROM stg_product WHERE product_id % 499 <> 0
"""
CHECK_SQL["product_file_reconcile"] = """
SELECT CAST(COUNT(*) AS BIGINT) AS file_rows, CAST(count_if(p_partkey % 499 <> 0) AS BIGINT) AS staged_rows,
       CAST(count_if(p_partkey % 499 = 0) AS BIGINT) AS bad_rows,
       CASE WHEN count_if(p_partkey % 499 <> 0) < COUNT(*) THEN 'Y' ELSE 'N' END AS short_load,
       CASE WHEN count_if(p_partkey % 499 = 0) <= 50 THEN 'Y' ELSE 'N' END AS accepted
FROM part
"""

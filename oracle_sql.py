"""Independent DuckDB SQL for every registered query (the correctness oracle).

The oracle follows the reference pipeline's *literal* SQL shapes (window
SUM over the date, LAG per product x store on the fanned-out rows, the
correlated NOT EXISTS, COUNT DISTINCT, a calendar BETWEEN join), while the
Spark side uses the rewritten plans; matching results test the rewrites.

Views available: region nation customer supplier part orders lineitem events.
"""

from __future__ import annotations

from shelfspark import config
from shelfspark.plans import registry as REG
from shelfspark.sources import tpch_roles as R

NULL_PART = config.SURROGATE_NULL


def sk(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{NULL_PART}')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def ratio(num: str, den: str, times: str = "1.0") -> str:
    return (f"CASE WHEN CAST({den} AS DOUBLE) > 0 THEN "
            f"round(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * {times}, 6) END")


def dkey(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def lit_date(d) -> str:
    return f"DATE '{d.isoformat()}'"


def lit_ts(t) -> str:
    return f"TIMESTAMP '{t.isoformat(sep=' ')}'"


AS_OF = lit_date(R.FIXTURE_AS_OF)
CAL_START = lit_date(R.FIXTURE_CALENDAR_START)
CAL_END = lit_date(R.FIXTURE_CALENDAR_END_EXCLUSIVE)
HOLIDAYS = ", ".join(lit_date(h) for h in config.HOLIDAYS)
BREAKS = config.TITLE_CASE_BREAKS
UNIT_PRICE = ("CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) "
              "AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))")


def _sql_class(chars: str) -> str:
    out = []
    for ch in chars:
        if ch in "\\^-[]":
            out.append("\\" + ch)
        elif ch == "'":
            out.append("''")
        elif ch == "\t":
            out.append("\\t")
        elif ch == "\n":
            out.append("\\n")
        elif ch == "\r":
            out.append("\\r")
        elif ch == "\f":
            out.append("\\f")
        elif ch == "\v":
            out.append("\\v")
        else:
            out.append(ch)
    return "[" + "".join(out) + "]"


def title(expr: str) -> str:
    cls = _sql_class(BREAKS)
    neg = "[^" + _sql_class(BREAKS)[1:]
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE array_to_string(list_transform("
            f"regexp_extract_all(lower({expr}), '{neg}*{cls}?'), lambda x: upper(x[1:1]) || x[2:]), '') END")


def _campaign_values() -> str:
    rows = []
    for cid, name, s, e, budget, demo in R.FIXTURE_CAMPAIGNS:
        rows.append(f"('{cid}', '{name}', {s}, {e}, CAST('{budget}' AS DECIMAL(18,2)), '{demo}')")
    return ", ".join(rows)


def _items_json() -> str:
    return ("CASE WHEN o_orderkey % 5 = 4 THEN 'null' WHEN o_orderkey % 5 = 0 THEN '[]' "
            "ELSE '[' || array_to_string(list_transform(generate_series(1, CAST(o_orderkey % 5 AS BIGINT)), "
            "lambda i: '{\"product_id\":\"' || CAST((o_orderkey * 7 + i) % 1000 AS VARCHAR) || "
            "'\",\"quantity\":\"' || CAST(i + o_orderkey % 3 AS VARCHAR) || "
            "CASE WHEN i = 2 THEN '.7' ELSE '' END || '\"}'), ',') || ']' END")


_PAYLOAD = ("'{\"order_id\":\"' || CAST(o_orderkey AS VARCHAR) || '\",' || "
            "'\"customer_id\":' || CAST(o_custkey AS VARCHAR) || ',' || "
            "'\"order_date\":\"' || strftime(o_orderdate, '%Y-%m-%d') || '\",' || "
            "'\"order_status\":\"' || o_orderstatus || '\",' || "
            "'\"total_price\":\"$' || format('{:,.2f}', o_totalprice) || '\",' || "
            "'\"meta\":{\"priority\":\"' || o_orderpriority || '\",\"clerk_no\":' || CAST(o_orderkey % 100 AS VARCHAR) || '},' || "
            "'\"tags\":[\"' || o_orderstatus || '\",\"' || o_orderpriority || '\"],' || "
            "'\"order_items\":' || " + _items_json() + " || '}'")

_FILE = ("CASE WHEN o_orderkey % 10 = 0 THEN 'landing/orders_data/orders_latest.json' "
         "ELSE 'landing/orders_data/orders_' || strftime(o_orderdate, '%Y-%m-%d') || '.json' END")

ITEM_ORDER = ("version_date DESC NULLS LAST, product_id DESC NULLS LAST, supplier_id DESC NULLS LAST, "
              "quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST, "
              "l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST")

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "landing": ((), f"""
        SELECT {_PAYLOAD} AS raw_json, {_FILE} AS _source_file FROM orders"""),
    "bronze": (("landing",), f"""
        SELECT nullif(trim(json_extract_string(raw_json, '$.order_id')), '') AS order_id_raw,
               json_extract_string(raw_json, '$.order_id') AS order_id, raw_json AS raw_payload, _source_file,
               {lit_ts(R.FIXTURE_LOADED_AT)} AS _loaded_at, '{R.FIXTURE_RUN_ID}' AS _batch_id
        FROM landing"""),
    "headers": ((), """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, CAST(c.c_nationkey AS BIGINT) AS store_id,
               o.o_orderpriority AS campaign_id, o.o_orderdate AS order_datetime,
               CAST(o.o_orderdate AS DATE) AS order_date,
               CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 5 AS INTEGER) AS shipping_date,
               CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 11 AS INTEGER) END
                   AS delivery_date,
               CAST(o.o_orderdate AS DATE) + 7 AS estimated_delivery_date,
               CASE o.o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'P' THEN 'Completed' WHEN 'O' THEN 'Pending' END
                   AS order_status,
               CAST(CAST(o.o_orderkey % 4 AS DECIMAL(18,6)) * 0.01 AS DECIMAL(18,6)) AS order_discount_rate,
               CAST(o.o_orderkey % 50 AS DECIMAL(18,2)) AS shipping_cost,
               CAST(o.o_custkey % 20 AS DECIMAL(18,2)) AS tax_amount
        FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""),
    "item_versions": ((), f"""
        SELECT l_orderkey AS order_id, l_linenumber AS item_number, l_partkey AS product_id,
               l_suppkey AS supplier_id, CAST(l_quantity AS BIGINT) AS quantity,
               {UNIT_PRICE} AS unit_price, CAST({UNIT_PRICE} * 0.75 AS DECIMAL(18,2)) AS cost_price,
               CAST(l_discount AS DECIMAL(18,6)) AS item_discount_rate, CAST(l_shipdate AS DATE) AS version_date,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
        FROM lineitem"""),
    "items": (("item_versions", "headers"), f"""
        SELECT v.order_id, v.item_number, v.product_id, v.supplier_id, v.quantity, v.unit_price, v.cost_price,
               v.item_discount_rate, v.version_date, h.order_date, h.order_status, h.customer_id, h.store_id,
               {sk('v.order_id', 'v.item_number')} AS order_item_key
        FROM (SELECT * FROM item_versions
              QUALIFY row_number() OVER (PARTITION BY order_id, item_number ORDER BY {ITEM_ORDER}) = 1) v
        LEFT JOIN headers h ON v.order_id = h.order_id"""),
    "rollup": (("item_versions",), """
        SELECT order_id, count(product_id) AS total_items, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               CAST(sum(quantity * unit_price) AS DECIMAL(18,2)) AS total_amount,
               CAST(sum(quantity * cost_price) AS DECIMAL(18,2)) AS total_cost,
               CAST(sum(item_discount_rate) AS DECIMAL(18,6)) AS total_discount,
               CAST(sum(quantity * unit_price * (1 - item_discount_rate)) AS DECIMAL(18,2)) AS line_revenue,
               CAST(sum(quantity * cost_price) AS DECIMAL(18,2)) AS line_cost
        FROM item_versions GROUP BY order_id"""),
    "orders_s": (("headers", "rollup"), f"""
        SELECT c.*, CAST(c.line_revenue * (1 - c.order_discount_rate) - c.line_cost - c.shipping_cost - c.tax_amount
                    AS DECIMAL(18,2)) AS profit_amount
        FROM (SELECT h.*, coalesce(r.total_items, 0) AS total_items, coalesce(r.total_quantity, 0) AS total_quantity,
                     CAST(coalesce(r.total_amount, 0) AS DECIMAL(18,2)) AS total_amount,
                     CAST(coalesce(r.total_cost, 0) AS DECIMAL(18,2)) AS total_cost,
                     CAST(coalesce(r.total_discount, 0) AS DECIMAL(18,6)) AS total_discount,
                     CAST(coalesce(r.line_revenue, 0) AS DECIMAL(18,2)) AS line_revenue,
                     CAST(coalesce(r.line_cost, 0) AS DECIMAL(18,2)) AS line_cost
              FROM headers h LEFT JOIN rollup r ON h.order_id = r.order_id) c"""),
    "product_history": ((), f"""
        SELECT s.product_id, s.source_snapshot_date, s.stock_quantity, s.supplier_id,
               p.p_name AS product_name, p.p_type AS category, p.p_brand AS subcategory,
               CAST(p.p_size AS BIGINT) AS reorder_level, CAST(p.p_retailprice AS DECIMAL(18,2)) AS cost_price,
               CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * 1.25 AS DECIMAL(18,2)) AS unit_price,
               {sk('s.product_id', 's.source_snapshot_date')} AS product_history_key
        FROM (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS source_snapshot_date,
                     CAST(sum(l_quantity) AS BIGINT) AS stock_quantity, min(l_suppkey) AS supplier_id
              FROM lineitem GROUP BY 1, 2) s
        LEFT JOIN part p ON p.p_partkey = s.product_id"""),
    "store_base": ((), """
        SELECT n.n_nationkey, n.n_name, n.n_regionkey, r.r_name,
               coalesce(s.current_sales, CAST(0 AS DECIMAL(18,2))) AS current_sales
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT c.c_nationkey, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS current_sales
                   FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1) s
               ON s.c_nationkey = n.n_nationkey"""),
    "stores": (("store_base",), """
        SELECT CAST(b.n_nationkey AS BIGINT) AS store_id, b.n_name AS store_name, b.r_name AS address_state,
               'City ' || CAST(b.n_nationkey AS VARCHAR) AS address_city, 'US' AS address_country,
               CAST(2000 + b.n_nationkey * 500 AS BIGINT) AS size_sq_ft, CAST(5 + b.n_nationkey AS BIGINT) AS employee_count,
               DATE '1990-01-01' + CAST(b.n_nationkey * 400 AS INTEGER) AS opening_date,
               CAST(b.current_sales AS DECIMAL(18,2)) AS current_sales, t.sales_target
        FROM store_base b LEFT JOIN (SELECT n_regionkey, CAST(max(current_sales) * 0.95 AS DECIMAL(18,2)) AS sales_target
                                     FROM store_base GROUP BY 1) t ON b.n_regionkey = t.n_regionkey"""),
    "suppliers": ((), """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
               CASE s_nationkey % 3 WHEN 0 THEN 'Manufacturer' WHEN 1 THEN 'Distributor' ELSE 'Wholesaler' END
                   AS supplier_type,
               'Contact ' || CAST(s_suppkey AS VARCHAR) AS contact_person,
               CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE 'orders' || CAST(s_suppkey AS VARCHAR) || '@supplier.example' END
                   AS email,
               '555' || lpad(CAST(s_suppkey % 10000000 AS VARCHAR), 7, '0') AS phone,
               CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey AS VARCHAR) || ' Supply Road' END AS address,
               'Net ' || CAST((s_nationkey % 3 + 1) * 30 AS VARCHAR) AS payment_terms
        FROM supplier"""),
    "customers": ((), """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               CASE WHEN c_custkey % 6 = 5 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
               ' ' || c_mktsegment || '-' || c_name AS display_name,
               CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR) || '@mail.example.com'
                    WHEN c_custkey % 4 = 1 THEN lower(c_mktsegment) || CAST(c_custkey AS VARCHAR) || '@mailcom'
                    WHEN c_custkey % 4 = 2 THEN upper(c_mktsegment) || '_' || CAST(c_custkey AS VARCHAR) || '@Shop.Example.org '
                    ELSE '  ' END AS email,
               CASE WHEN c_custkey % 3 = 0 THEN '+1 (' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ') 555-'
                                                || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
                    WHEN c_custkey % 3 = 1 THEN '(' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ') 555-'
                                                || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
                    ELSE lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-55-'
                         || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
               DATE '1940-01-01' + CAST((c_custkey * 7919) % 25000 AS INTEGER) AS birth_date,
               '$' || format('{:,.2f}', c_acctbal) AS account_balance_text,
               CAST(c_nationkey AS BIGINT) AS store_id
        FROM customer"""),
    "campaigns": ((), f"""
        SELECT campaign_id, campaign_name, CAST(first_day + start_days AS DATE) AS start_date,
               CAST(first_day + start_days + n_days AS DATE) AS end_date, budget, demographics
        FROM (VALUES {_campaign_values()})
            t(campaign_id, campaign_name, start_days, n_days, budget, demographics)
        JOIN (SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE) AS first_day FROM orders GROUP BY o_orderpriority)
            ON o_orderpriority = campaign_id"""),
    "dim_date": ((), f"""
        SELECT {dkey('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               CAST(weekofyear(d) AS INTEGER) AS week, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
               strftime(d, '%a') AS day_name, d IN ({HOLIDAYS}) AS holiday_flag,
               CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
                    WHEN month(d) IN (6, 7, 8) THEN 'Summer' WHEN month(d) IN (9, 10, 11) THEN 'Fall' END AS season
        FROM (SELECT CAST(range AS DATE) AS d FROM range({CAL_START}, {CAL_END}, INTERVAL 1 DAY))"""),
    # ---- inventory (literal reference shape) ----
    "product_store": (("items",), """
        SELECT DISTINCT product_id, store_id FROM items WHERE product_id IS NOT NULL AND store_id IS NOT NULL"""),
    "inv_snap": (("product_history", "product_store"), """
        SELECT ph.product_id, ps.store_id, ph.source_snapshot_date AS inventory_date, ph.stock_quantity AS ending_stock,
               ph.reorder_level, ph.supplier_id, ph.cost_price
        FROM product_history ph JOIN product_store ps ON ph.product_id = ps.product_id"""),
    "inv_begin": (("inv_snap",), """
        SELECT *, lag(ending_stock) OVER (PARTITION BY product_id, store_id ORDER BY inventory_date) AS beginning_stock,
               lag(inventory_date) OVER (PARTITION BY product_id, store_id ORDER BY inventory_date)
                   AS previous_inventory_date
        FROM inv_snap"""),
    "completed": (("items",), """
        SELECT product_id, store_id, order_date AS inventory_date, CAST(sum(quantity) AS BIGINT) AS sold_quantity
        FROM items WHERE lower(order_status) IN ('completed', 'delivered') AND product_id IS NOT NULL
             AND store_id IS NOT NULL AND order_date IS NOT NULL
        GROUP BY 1, 2, 3"""),
    "inv_calc": (("inv_begin", "completed"), """
        SELECT *, CASE WHEN beginning_stock IS NOT NULL AND ending_stock IS NOT NULL
                       THEN ending_stock - beginning_stock + sold_quantity END AS purchased_quantity,
                  CASE WHEN ending_stock IS NOT NULL AND cost_price IS NOT NULL
                       THEN CAST(ending_stock * cost_price AS DECIMAL(18,2)) END AS inventory_value,
                  CASE WHEN beginning_stock IS NOT NULL AND ending_stock IS NOT NULL
                       THEN CAST(beginning_stock + ending_stock AS DOUBLE) / 2.0 END AS average_inventory
        FROM (SELECT b.*, coalesce(s.sold_quantity, 0) AS sold_quantity
              FROM inv_begin b LEFT JOIN completed s ON b.product_id = s.product_id AND b.store_id = s.store_id
                   AND b.inventory_date = s.inventory_date)"""),
    "inventory": (("inv_calc",), f"""
        SELECT {sk('product_id', 'store_id', 'inventory_date')} AS inventory_key, product_id, store_id, inventory_date,
               beginning_stock, purchased_quantity, sold_quantity, ending_stock, inventory_value, average_inventory,
               {ratio('sold_quantity', 'average_inventory')} AS stock_turnover_ratio,
               CASE WHEN sum(purchased_quantity) OVER (PARTITION BY inventory_date) > 0
                    THEN round(CAST(purchased_quantity AS DOUBLE)
                               / CAST(sum(purchased_quantity) OVER (PARTITION BY inventory_date) AS DOUBLE) * 100.0, 6)
                    ELSE 0 END AS supplier_contribution_percentage,
               reorder_level, supplier_id,
               CASE WHEN previous_inventory_date IS NULL THEN FALSE
                    WHEN inventory_date - previous_inventory_date > 1 THEN TRUE ELSE FALSE END AS snapshot_gap_flag,
               CASE WHEN previous_inventory_date IS NULL THEN 0
                    ELSE CAST(inventory_date - previous_inventory_date AS INTEGER) END AS snapshot_gap_days,
               CASE WHEN ending_stock IS NOT NULL AND reorder_level IS NOT NULL AND ending_stock < reorder_level
                    THEN TRUE ELSE FALSE END AS low_stock_flag,
               CASE WHEN purchased_quantity < 0 THEN TRUE ELSE FALSE END AS negative_inferred_purchase_flag
        FROM inv_calc"""),
    # ---- gold ----
    "dim_products": (("product_history", "suppliers"), f"""
        SELECT {sk('p.product_id')} AS product_key, p.product_id, p.product_name, p.category, p.subcategory,
               p.unit_price, p.cost_price, p.supplier_id, s.supplier_name
        FROM (SELECT * FROM product_history QUALIFY row_number() OVER (
                PARTITION BY product_id ORDER BY source_snapshot_date DESC NULLS FIRST, product_history_key DESC) = 1) p
        LEFT JOIN suppliers s ON p.supplier_id = s.supplier_id"""),
    "dim_stores": (("stores",), f"""
        SELECT {sk('store_id')} AS store_key, store_id, store_name,
               CASE WHEN address_city IS NULL OR address_state IS NULL OR address_country IS NULL THEN NULL
                    ELSE concat_ws(', ', address_city, address_state, address_country) END AS address,
               address_city, address_state, address_country, opening_date,
               CASE WHEN size_sq_ft < 5000 THEN 'Small' WHEN size_sq_ft >= 5000 AND size_sq_ft <= 10000 THEN 'Medium'
                    WHEN size_sq_ft > 10000 THEN 'Large' END AS size_category
        FROM stores"""),
    "dim_suppliers": (("suppliers",), f"""
        SELECT {sk('supplier_id')} AS supplier_key, supplier_id, supplier_name,
               CASE WHEN nullif(trim(contact_person), '') IS NULL OR nullif(trim(email), '') IS NULL
                         OR nullif(trim(phone), '') IS NULL OR nullif(trim(address), '') IS NULL THEN NULL
                    ELSE concat_ws(' | ', trim(contact_person), trim(email), trim(phone), trim(address)) END
                   AS contact_information,
               payment_terms, supplier_type
        FROM suppliers"""),
    "dim_campaign": (("campaigns",), f"""
        SELECT {sk('campaign_id')} AS campaign_key, campaign_id, campaign_name, demographics AS target_audience_segment,
               budget, CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL AND end_date >= start_date
                            THEN CAST(end_date - start_date AS INTEGER) END AS duration, start_date, end_date
        FROM campaigns"""),
    "fact_inventory": (("inventory", "dim_products", "dim_stores", "dim_suppliers", "dim_date"), """
        SELECT i.inventory_key, p.product_key, d.date_key, st.store_key, s.supplier_key, i.beginning_stock,
               i.purchased_quantity, i.sold_quantity, i.ending_stock, i.inventory_value, i.stock_turnover_ratio,
               i.supplier_contribution_percentage, i.snapshot_gap_flag, i.snapshot_gap_days
        FROM inventory i LEFT JOIN dim_products p ON i.product_id = p.product_id
        LEFT JOIN dim_stores st ON i.store_id = st.store_id
        LEFT JOIN dim_suppliers s ON i.supplier_id = s.supplier_id
        LEFT JOIN dim_date d ON i.inventory_date = d.full_date"""),
    # ---- campaign (literal reference shape) ----
    "sales_base": (("orders_s",), f"""
        SELECT order_id, {sk('campaign_id')} AS campaign_key, {dkey('order_date')} AS date_key,
               {sk('customer_id')} AS customer_key, customer_id, campaign_id, order_date,
               coalesce(total_amount, CAST(0 AS DECIMAL(18,2))) AS total_sales_amount
        FROM orders_s WHERE order_id IS NOT NULL AND campaign_id IS NOT NULL"""),
    "cph": (("sales_base",), """
        SELECT customer_id, min(order_date) AS first_purchase_date FROM sales_base
        WHERE customer_id IS NOT NULL GROUP BY customer_id"""),
    "fact_sales": (("sales_base", "cph"), """
        SELECT s.*, CASE WHEN s.order_date = h.first_purchase_date THEN TRUE ELSE FALSE END AS is_first_purchase,
               CASE WHEN s.order_date > h.first_purchase_date THEN TRUE ELSE FALSE END AS is_repeat_purchase
        FROM sales_base s LEFT JOIN cph h ON s.customer_id = h.customer_id"""),
    "campaign_customers": (("dim_campaign", "fact_sales"), """
        SELECT DISTINCT c.campaign_key, c.campaign_id, fs.customer_key, fs.customer_id, c.start_date, c.end_date
        FROM dim_campaign c JOIN fact_sales fs ON fs.campaign_key = c.campaign_key
             AND fs.order_date BETWEEN c.start_date AND c.end_date
        WHERE fs.customer_key IS NOT NULL"""),
    "ccs": (("campaign_customers", "fact_sales"), """
        SELECT cc.campaign_key, cc.customer_key,
               max(CASE WHEN fs.is_first_purchase = TRUE THEN 1 ELSE 0 END) AS is_first_purchase,
               max(CASE WHEN fs.is_repeat_purchase = TRUE THEN 1 ELSE 0 END) AS is_repeat_purchase
        FROM campaign_customers cc JOIN fact_sales fs ON fs.campaign_key = cc.campaign_key
             AND fs.customer_key = cc.customer_key AND fs.order_date BETWEEN cc.start_date AND cc.end_date
        GROUP BY cc.campaign_key, cc.customer_key"""),
    "ccm": (("ccs",), """
        SELECT campaign_key, count(DISTINCT customer_key) AS total_campaign_customers,
               count(DISTINCT CASE WHEN is_first_purchase = 1 THEN customer_key END) AS first_purchase_customers,
               count(DISTINCT CASE WHEN is_repeat_purchase = 1 THEN customer_key END) AS repeat_purchase_customers
        FROM ccs GROUP BY campaign_key"""),
    "campaign_dates": (("dim_campaign", "dim_date"), """
        SELECT c.campaign_key, c.campaign_id, c.budget, c.start_date, c.end_date, d.date_key, d.full_date
        FROM dim_campaign c JOIN dim_date d ON d.full_date BETWEEN c.start_date AND c.end_date"""),
    "sales_infl": (("campaign_dates", "fact_sales"), """
        SELECT cd.campaign_key, cd.date_key,
               CAST(coalesce(sum(fs.total_sales_amount), 0) AS DECIMAL(18,2)) AS total_sales_influenced
        FROM campaign_dates cd LEFT JOIN fact_sales fs ON fs.campaign_key = cd.campaign_key
             AND fs.date_key = cd.date_key AND fs.order_date BETWEEN cd.start_date AND cd.end_date
        GROUP BY cd.campaign_key, cd.date_key"""),
    "new_cust": (("campaign_dates", "fact_sales"), """
        SELECT cd.campaign_key, cd.date_key,
               count(DISTINCT CASE WHEN fs.customer_key IS NOT NULL
                                    AND fs.order_date BETWEEN cd.start_date AND cd.end_date
                                    AND NOT EXISTS (SELECT 1 FROM fact_sales prior
                                                    WHERE prior.customer_key = fs.customer_key
                                                      AND prior.order_date < cd.start_date)
                                   THEN fs.customer_key END) AS new_customers_acquired
        FROM campaign_dates cd LEFT JOIN fact_sales fs ON fs.campaign_key = cd.campaign_key
             AND fs.date_key = cd.date_key
        GROUP BY cd.campaign_key, cd.date_key"""),
    "perf_metrics": (("campaign_dates", "sales_infl", "new_cust", "ccm"), """
        SELECT cd.campaign_key, cd.campaign_id, cd.date_key, cd.full_date, cd.budget,
               CAST(coalesce(si.total_sales_influenced, 0) AS DECIMAL(18,2)) AS total_sales_influenced,
               coalesce(nc.new_customers_acquired, 0) AS new_customers_acquired,
               coalesce(ccm.total_campaign_customers, 0) AS total_campaign_customers,
               coalesce(ccm.first_purchase_customers, 0) AS first_purchase_customers,
               coalesce(ccm.repeat_purchase_customers, 0) AS repeat_purchase_customers
        FROM campaign_dates cd
        LEFT JOIN sales_infl si ON cd.campaign_key = si.campaign_key AND cd.date_key = si.date_key
        LEFT JOIN new_cust nc ON cd.campaign_key = nc.campaign_key AND cd.date_key = nc.date_key
        LEFT JOIN ccm ON cd.campaign_key = ccm.campaign_key"""),
    "fact_marketing": (("perf_metrics",), f"""
        SELECT {sk('campaign_key', 'date_key')} AS marketing_performance_key, campaign_key, date_key, campaign_id,
               full_date, total_sales_influenced, new_customers_acquired,
               {ratio('repeat_purchase_customers', 'total_campaign_customers', '100.0')} AS repeat_purchase_rate,
               budget AS total_campaign_cost,
               {ratio('total_sales_influenced - budget', 'budget', '100.0')} AS roi
        FROM perf_metrics"""),
}


def with_ctes(names: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    defs = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {defs}\n{body}"


Q: dict[str, str] = {}


def q(name: str, needs: tuple[str, ...], body: str) -> None:
    Q[name] = with_ctes(needs, body)


# ---------------- ingestion ----------------
q("bronze_extract", ("bronze",), "SELECT order_id, raw_payload, _source_file, _loaded_at, _batch_id FROM bronze")
q("json_extract", ("landing",), f"""
SELECT nullif(trim(json_extract_string(raw_json, '$.order_id')), '') AS order_id,
       TRY_CAST(json_extract(raw_json, '$.customer_id') AS BIGINT) AS customer_id,
       TRY_CAST(nullif(trim(json_extract_string(raw_json, '$.order_date')), '') AS DATE) AS order_date,
       nullif(trim(json_extract_string(raw_json, '$.order_status')), '') AS order_status,
       TRY_CAST(nullif(regexp_replace(trim(json_extract_string(raw_json, '$.total_price')), '[$,]', '', 'g'), '')
                AS DECIMAL(18,2)) AS total_price,
       nullif(trim(json_extract_string(raw_json, '$.meta.priority')), '') AS priority,
       TRY_CAST(json_extract(raw_json, '$.meta.clerk_no') AS INTEGER) AS clerk_no,
       nullif(trim(json_extract_string(raw_json, '$.tags[1]')), '') AS second_tag,
       nullif(trim(json_extract_string(raw_json, '$.missing.path')), '') AS missing_value
FROM landing""")
q("flatten_items", ("landing",), """
SELECT order_id, CAST(item_number AS INTEGER) AS item_number,
       nullif(trim(json_extract_string(item, '$.product_id')), '') AS product_id,
       coalesce(CAST(TRY_CAST(nullif(trim(json_extract_string(item, '$.quantity')), '') AS DECIMAL(38,0)) AS BIGINT), 0)
           AS quantity
FROM (SELECT order_id, generate_subscripts(arr, 1) AS item_number, unnest(arr) AS item
      FROM (SELECT nullif(trim(json_extract_string(raw_json, '$.order_id')), '') AS order_id,
                   json_extract(raw_json, '$.order_items[*]') AS arr
            FROM landing
            WHERE json_type(json_extract(raw_json, '$.order_items')) = 'ARRAY'))""")
q("incremental_anti_join", ("bronze",), f"""
SELECT s.order_id, s._source_file FROM bronze s
WHERE NOT EXISTS (SELECT 1 FROM bronze t
                  WHERE TRY_CAST(regexp_extract(t._source_file, '{config.FILE_DATE_PATTERN}') AS DATE)
                        < {lit_date(REG.INCREMENT_TARGET_BEFORE)}
                    AND t.order_id = s.order_id AND t._source_file = s._source_file)""")
q("merge_upsert", ("headers",), f"""
SELECT order_id, 'Pending' AS order_status, 'v1' AS version FROM headers
WHERE order_date < {lit_date(REG.MERGE_TARGET_BEFORE)}
  AND order_id NOT IN (SELECT order_id FROM headers WHERE order_date >= {lit_date(REG.MERGE_INCOMING_FROM)})
UNION ALL
SELECT order_id, order_status, 'v2' AS version FROM headers WHERE order_date >= {lit_date(REG.MERGE_INCOMING_FROM)}""")
q("logged_anti_join", ("bronze",), f"""
SELECT s.order_id, s._source_file FROM bronze s
WHERE NOT EXISTS (SELECT 1 FROM bronze t
                  WHERE TRY_CAST(regexp_extract(t._source_file, '{config.FILE_DATE_PATTERN}') AS DATE)
                        < {lit_date(REG.INCREMENT_TARGET_BEFORE)} AND t.order_id NOT LIKE '%7'
                    AND t.order_id = s.order_id AND t._source_file = s._source_file)""")
q("partitioned_merge", ("headers",), f"""
SELECT * FROM (WITH inc AS (SELECT order_id, order_date, order_status FROM headers
             WHERE order_date >= {lit_date(REG.MERGE_INCOMING_FROM)} AND order_id % 10 <> 3),
all_rows AS (
  SELECT order_id, order_date, 'Pending' AS order_status, 'v1' AS version FROM headers
  WHERE order_date < {lit_date(REG.MERGE_TARGET_BEFORE)} AND order_id NOT IN (SELECT order_id FROM inc)
  UNION ALL SELECT order_id, order_date, order_status, 'v2' FROM inc)
SELECT *, CAST(CASE WHEN strftime(order_date, '%Y-%m') IN (SELECT strftime(order_date, '%Y-%m') FROM inc) THEN 2 ELSE 1 END AS INTEGER)
            AS load_no
FROM all_rows)""")
q("high_watermark_filter", ("product_history",), f"""
SELECT product_id, source_snapshot_date, stock_quantity FROM product_history
WHERE source_snapshot_date > (SELECT coalesce(max(source_snapshot_date), DATE '1900-01-01') FROM product_history
                              WHERE source_snapshot_date <= {lit_date(REG.WATERMARK_TARGET_UNTIL)})""")
_FRESH = """
SELECT '{src}' AS source, m AS max_loaded_at,
       round(CAST(epoch_us({now}) - epoch_us(m) AS DOUBLE) / 3.6e9, 6) AS age_hours,
       CASE WHEN m IS NULL THEN 'error'
            WHEN round(CAST(epoch_us({now}) - epoch_us(m) AS DOUBLE) / 3.6e9, 6) > 48 THEN 'error'
            WHEN round(CAST(epoch_us({now}) - epoch_us(m) AS DOUBLE) / 3.6e9, 6) > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT CAST(max({col}) AS TIMESTAMP) AS m FROM {tbl})"""
q("source_freshness", (), _FRESH.format(src="events", now=lit_ts(REG.FRESHNESS_EVENTS_AS_OF), col="ts", tbl="events")
  + "\nUNION ALL\n" + _FRESH.format(src="orders", now=lit_ts(REG.FRESHNESS_ORDERS_AS_OF), col="o_orderdate", tbl="orders"))

# ---------------- history ----------------
q("latest_per_key", ("item_versions",), f"""
SELECT order_id, item_number, product_id, supplier_id, quantity, unit_price, version_date FROM item_versions
QUALIFY row_number() OVER (PARTITION BY order_id, item_number ORDER BY {ITEM_ORDER}) = 1""")
q("scd2_history", ("item_versions",), f"""
SELECT order_id, item_number, product_id, quantity, {sk('order_id', 'item_number', 'version_date')} AS scd_id,
       version_date AS valid_from,
       lead(version_date) OVER (PARTITION BY order_id, item_number ORDER BY version_date) AS valid_to,
       lead(version_date) OVER (PARTITION BY order_id, item_number ORDER BY version_date) IS NULL AS is_current
FROM (SELECT * FROM item_versions
      QUALIFY row_number() OVER (PARTITION BY order_id, item_number, version_date ORDER BY {ITEM_ORDER}) = 1)""")
q("snapshot_apply", ("item_versions",), f"""
SELECT * FROM (WITH delivered AS (
    SELECT * REPLACE (CASE WHEN (order_id + product_id) % 13 = 0 THEN NULL ELSE version_date END AS version_date),
           version_date >= DATE '1998-01-01' AS is_second
    FROM item_versions WHERE version_date IS NOT NULL),
latest AS (
    SELECT * FROM delivered
    QUALIFY row_number() OVER (PARTITION BY is_second, order_id, item_number
                               ORDER BY {ITEM_ORDER.replace("version_date DESC NULLS LAST", "version_date DESC NULLS FIRST", 1)}) = 1),
a AS (SELECT * FROM latest WHERE NOT is_second),
b AS (SELECT * FROM latest WHERE is_second),
versions AS (
    SELECT a.order_id, a.item_number, a.product_id, a.quantity, a.version_date,
           CASE WHEN b.version_date > a.version_date THEN b.version_date END AS valid_to
    FROM a LEFT JOIN b ON a.order_id = b.order_id AND a.item_number = b.item_number
    UNION ALL
    SELECT b.order_id, b.item_number, b.product_id, b.quantity, b.version_date, NULL
    FROM b LEFT JOIN a ON a.order_id = b.order_id AND a.item_number = b.item_number
    WHERE a.order_id IS NULL OR b.version_date > a.version_date)
SELECT order_id, item_number, product_id, quantity, {sk('order_id', 'item_number', 'version_date')} AS scd_id,
       version_date AS valid_from, valid_to, valid_to IS NULL AS is_current
FROM versions)""")
q("scd2_composite_key", ("product_history",), f"""
SELECT scd_key, product_id, source_snapshot_date, stock_quantity, {sk('scd_key', 'source_snapshot_date')} AS scd_id,
       source_snapshot_date AS valid_from,
       lead(source_snapshot_date) OVER (PARTITION BY scd_key ORDER BY source_snapshot_date) AS valid_to,
       lead(source_snapshot_date) OVER (PARTITION BY scd_key ORDER BY source_snapshot_date) IS NULL AS is_current
FROM (SELECT *, CAST(product_id AS VARCHAR) || '|' || CAST(source_snapshot_date AS VARCHAR) AS scd_key
      FROM product_history)""")

# ---------------- cleaning ----------------
q("blank_to_null", ("suppliers",), """
SELECT supplier_id, nullif(trim(email), '') AS email, nullif(trim(address), '') AS address FROM suppliers""")
q("full_name", ("customers",), """
SELECT customer_id,
       nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), '') AS full_name,
       CASE WHEN first_name IS NULL OR last_name IS NULL THEN NULL ELSE first_name || ' ' || last_name END
           AS full_name_strict
FROM customers""")
q("hierarchy_path", ("suppliers",), """
SELECT supplier_id,
       CASE WHEN nullif(trim(contact_person), '') IS NULL OR nullif(trim(email), '') IS NULL
                 OR nullif(trim(phone), '') IS NULL OR nullif(trim(address), '') IS NULL THEN NULL
            ELSE concat_ws(' | ', trim(contact_person), trim(email), trim(phone), trim(address)) END
           AS contact_information,
       concat_ws(' | ', nullif(trim(contact_person), ''), nullif(trim(email), ''), nullif(trim(phone), ''),
                 nullif(trim(address), '')) AS contact_information_skip
FROM suppliers""")
q("title_case", ("customers",), f"""
SELECT customer_id, {title('display_name')} AS display_name, {title('lower(email)')} AS email_title FROM customers""")
q("parse_money", ("customers",), """
SELECT customer_id, account_balance_text,
       TRY_CAST(nullif(regexp_replace(trim(account_balance_text), '[$,]', '', 'g'), '') AS DECIMAL(18,2))
           AS account_balance
FROM customers""")
q("parse_number", (), """
SELECT l_orderkey AS order_id, l_linenumber AS item_number, amount_text,
       CAST(TRY_CAST(nullif(trim(amount_text), '') AS DECIMAL(38,0)) AS BIGINT) AS amount_number
FROM (SELECT *, CASE WHEN l_linenumber % 7 = 0 THEN 'n/a'
                     ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount_text FROM lineitem)""")
q("normalize_phone", ("customers",), """
SELECT customer_id, phone, d AS phone_digits,
       CASE WHEN d IS NOT NULL AND length(d) = 10 THEN d END AS phone_exact10,
       CASE WHEN d IS NOT NULL AND length(d) >= 10 THEN d END AS phone_min10,
       (d IS NOT NULL AND length(d) = 10) AS phone_valid
FROM (SELECT *, nullif(regexp_replace(trim(phone), '[^0-9]', '', 'g'), '') AS d FROM customers)""")
q("file_date", ("bronze",), f"""
SELECT order_id, _source_file,
       TRY_CAST(nullif(regexp_extract(_source_file, '{config.FILE_DATE_PATTERN}'), '') AS DATE) AS source_snapshot_date,
       TRY_CAST(nullif(regexp_extract(_source_file, '{config.SUPPLIER_FILE_DATE_PATTERN}'), '') AS DATE)
           AS supplier_snapshot_date
FROM bronze""")
q("validate_email", ("customers",), f"""
SELECT customer_id,
       CASE WHEN e IS NOT NULL AND regexp_matches(e, '{config.EMAIL_PATTERN_STRICT}') THEN e END AS email_id,
       (e IS NOT NULL AND regexp_matches(e, '{config.EMAIL_PATTERN_STRICT}')) AS email_valid,
       CASE WHEN e IS NOT NULL AND regexp_matches(e, '{config.EMAIL_PATTERN_LENIENT}') THEN e END AS email_id_lenient,
       (e IS NOT NULL AND regexp_matches(e, '{config.EMAIL_PATTERN_LENIENT}')) AS email_valid_lenient
FROM (SELECT *, lower(nullif(trim(email), '')) AS e FROM customers)""")
q("surrogate_key", ("item_versions",), f"""
SELECT order_id, item_number, {sk('order_id', 'item_number')} AS order_item_key,
       {sk('order_id', 'CASE WHEN item_number % 5 <> 0 THEN item_number END')} AS partial_key
FROM item_versions""")

q("name_cleaning", ("customers",), f"""
SELECT customer_id,
       nullif({title("regexp_replace(trim(display_name), '[^A-Za-z'' -]', '', 'g')")}, '') AS customer_name,
       nullif({title("regexp_replace(trim(display_name), '[^A-Za-z0-9'' -]', '', 'g')")}, '') AS product_name,
       nullif(regexp_replace({title("trim(display_name)")}, '[^A-Za-z0-9]', '', 'g'), '') AS history_name,
       nullif(regexp_replace({title("trim(display_name)")}, '[^A-Za-z0-9'' -]', '', 'g'), '') AS store_name,
       opt_in_text,
       CASE WHEN lower(nullif(trim(opt_in_text), '')) IN ('true', 't', 'yes', 'y', 'on', '1') THEN TRUE
            WHEN lower(nullif(trim(opt_in_text), '')) IN ('false', 'f', 'no', 'n', 'off', '0') THEN FALSE END
           AS marketing_opt_in
FROM (SELECT *, CASE customer_id % 5 WHEN 0 THEN 'ON' WHEN 1 THEN ' yes' WHEN 2 THEN 'False' WHEN 3 THEN 'maybe'
                     ELSE '' END AS opt_in_text FROM customers)""")
q("typed_parsing", (), """
SELECT event_id,
       CAST(hour(timezone('UTC', CAST(zoned AS TIMESTAMPTZ))) AS INTEGER) AS utc_hour,
       CAST(hour(CAST(regexp_replace(zoned, '[+-]\\d\\d:\\d\\d$', '') AS TIMESTAMP)) AS INTEGER) AS local_hour,
       amount_text, TRY_CAST(nullif(trim(amount_text), '') AS DECIMAL(18,2)) AS amount
FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '-05:00' AS zoned,
             CAST(event_id % 1000 AS VARCHAR) || '.' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS amount_text
      FROM events)""")
q("percent_rate", (), """
SELECT l_orderkey, l_linenumber, percent_text,
       CAST(coalesce(TRY_CAST(nullif(trim(percent_text), '') AS DECIMAL(18,6)) * CAST(0.01 AS DECIMAL(3,2)), 0)
            AS DECIMAL(18,8)) AS rate
FROM (SELECT l_orderkey, l_linenumber,
             CASE l_orderkey % 6 WHEN 0 THEN '  ' WHEN 1 THEN ' ' || pct || ' ' WHEN 2 THEN 'n/a' WHEN 3 THEN NULL
                  ELSE pct END AS percent_text
      FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey % 100 AS VARCHAR) || '.'
                   || lpad(CAST((l_suppkey * 7919) % 1000000 AS VARCHAR), 6, '0') AS pct
            FROM lineitem))""")
q("order_window_days", ("headers",), """
SELECT order_id,
       CASE WHEN order_date IS NOT NULL AND delivery_date IS NOT NULL AND delivery_date >= order_date
            THEN CAST(delivery_date - order_date AS INTEGER) END AS order_to_delivery_days,
       CASE WHEN order_date IS NOT NULL AND delivery_date IS NOT NULL AND order_date >= delivery_date
            THEN CAST(order_date - delivery_date AS INTEGER) END AS reversed_days
FROM headers""")

# ---------------- orders ----------------
q("order_rollup", ("rollup",), "SELECT * FROM rollup")
q("order_header_items", ("orders_s",), """
SELECT order_id, customer_id, store_id, order_status, total_items, total_quantity, total_amount, total_cost,
       total_discount, line_revenue, line_cost FROM orders_s""")
q("order_profitability", ("orders_s",), f"""
SELECT order_id, line_revenue, order_discount_rate, line_cost, shipping_cost, tax_amount, profit_amount,
       {ratio('profit_amount', 'line_revenue', '100.0')} AS profit_margin_percentage
FROM orders_s""")
q("time_of_day", (), """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS event_hour,
       CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'Morning' WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'Afternoon'
            WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'Evening' ELSE 'Night' END AS time_of_day
FROM events""")
q("calendar_parts", (), """
SELECT event_id, CAST(weekofyear(CAST(ts AS DATE)) AS INTEGER) AS event_week,
       CAST(month(CAST(ts AS DATE)) AS INTEGER) AS event_month,
       CAST(quarter(CAST(ts AS DATE)) AS INTEGER) AS event_quarter, CAST(year(CAST(ts AS DATE)) AS INTEGER) AS event_year
FROM events""")
q("delivery_status", ("orders_s",), f"""
SELECT order_id, order_date, shipping_date, delivery_date, estimated_delivery_date,
       CAST(shipping_date - order_date AS INTEGER) AS processing_days,
       CAST(delivery_date - shipping_date AS INTEGER) AS shipping_days,
       CASE WHEN delivery_date IS NOT NULL AND delivery_date <= estimated_delivery_date THEN 'On Time'
            WHEN delivery_date IS NOT NULL AND delivery_date > estimated_delivery_date THEN 'Delayed'
            WHEN delivery_date IS NULL AND {AS_OF} > estimated_delivery_date THEN 'Potentially Delayed'
            ELSE 'In Transit' END AS delivery_status
FROM orders_s""")
q("profit_margin", ("product_history",), f"""
SELECT product_id, source_snapshot_date, unit_price, cost_price,
       {ratio('unit_price - cost_price', 'unit_price', '100.0')} AS profit_margin_percentage,
       CASE WHEN stock_quantity IS NOT NULL AND reorder_level IS NOT NULL AND stock_quantity < reorder_level
            THEN TRUE ELSE FALSE END AS low_stock_flag,
       stock_quantity < CASE WHEN reorder_level > 10 THEN reorder_level END AS low_stock_nullable
FROM product_history""")

# ---------------- entities ----------------
_AGE = ("CASE WHEN {d} IS NOT NULL AND {d} <= {a} THEN (year({a}) - year({d})) - "
        "CASE WHEN CAST({d} + to_months(CAST(12 * (year({a}) - year({d})) AS INTEGER)) AS DATE) > {a} "
        "THEN 1 ELSE 0 END END")
q("age_bands", ("customers",), f"""
SELECT customer_id, birth_date, CAST(age AS INTEGER) AS customer_age,
       CASE WHEN age BETWEEN 18 AND 35 THEN 'Young' WHEN age BETWEEN 36 AND 55 THEN 'Middle-aged'
            WHEN age >= 56 THEN 'Senior' END AS customer_segment
FROM (SELECT *, {_AGE.format(d='birth_date', a=AS_OF)} AS age FROM customers)""")
q("size_bands", ("stores",), f"""
SELECT store_id, size_sq_ft,
       CASE WHEN size_sq_ft < 5000 THEN 'Small' WHEN size_sq_ft >= 5000 AND size_sq_ft <= 10000 THEN 'Medium'
            WHEN size_sq_ft > 10000 THEN 'Large' END AS store_size_category,
       CAST({_AGE.format(d='opening_date', a=AS_OF)} AS INTEGER) AS store_age_years
FROM stores""")
q("store_performance", ("stores",), f"""
SELECT store_id, current_sales, sales_target, ach AS sales_target_achievement_percentage,
       {ratio('current_sales', 'size_sq_ft')} AS revenue_per_sq_ft,
       {ratio('current_sales', 'employee_count')} AS employee_efficiency,
       coalesce(ach < 90, FALSE) AS performance_issue_flag
FROM (SELECT *, CAST(CASE WHEN CAST(sales_target AS DOUBLE) > 0
                          THEN CAST(current_sales AS DOUBLE) / CAST(sales_target AS DOUBLE) * 100.0 END
                     AS DECIMAL(18,2)) AS ach
      FROM stores)""")
q("date_dimension", (), f"""
SELECT {dkey('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
       strftime(d, '%a') AS day_name, d IN ({HOLIDAYS}) AS holiday_flag,
       CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
            WHEN month(d) IN (6, 7, 8) THEN 'Summer' WHEN month(d) IN (9, 10, 11) THEN 'Fall' END AS season
FROM (SELECT CAST(range AS DATE) AS d
      FROM range((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
                 (SELECT max(CAST(l_shipdate AS DATE)) + 1 FROM lineitem), INTERVAL 1 DAY))""")

# ---------------- inventory ----------------
q("distinct_relationship", ("product_store",), "SELECT product_id, store_id FROM product_store")
q("inventory_fanout", ("inv_snap",), "SELECT product_id, store_id, inventory_date, ending_stock FROM inv_snap")
q("beginning_stock", ("inv_begin",), """
SELECT product_id, store_id, inventory_date, beginning_stock, ending_stock FROM inv_begin""")
q("segmented_previous", ("product_history",), """
SELECT product_id, source_snapshot_date, stock_quantity, lag(stock_quantity) OVER w AS previous_stock,
       lag(source_snapshot_date) OVER w AS previous_date
FROM product_history WINDOW w AS (PARTITION BY product_id ORDER BY source_snapshot_date)""")
q("completed_sales", ("completed",), "SELECT product_id, store_id, inventory_date, sold_quantity FROM completed")
q("inventory_movement", ("inventory",), """
SELECT inventory_key, product_id, store_id, inventory_date, beginning_stock, purchased_quantity, sold_quantity,
       ending_stock, inventory_value, stock_turnover_ratio, low_stock_flag, negative_inferred_purchase_flag
FROM inventory""")
q("contribution_share", ("inventory",), """
SELECT product_id, store_id, inventory_date, purchased_quantity, supplier_contribution_percentage FROM inventory""")
q("snapshot_gap", ("inventory",), """
SELECT product_id, store_id, inventory_date, snapshot_gap_flag, snapshot_gap_days FROM inventory""")
q("stock_turnover", ("inventory",), """
SELECT product_id, store_id, inventory_date, sold_quantity, round(average_inventory, 6) AS average_inventory,
       stock_turnover_ratio FROM inventory""")
q("star_lookup", ("fact_inventory",), "SELECT * FROM fact_inventory")

for _name, _table in (("dim_products", "dim_products"), ("dim_stores", "dim_stores"), ("dim_suppliers", "dim_suppliers"),
                      ("dim_marketing_campaign", "dim_campaign")):
    q(_name, (_table,), f"SELECT * FROM {_table}")

# ---------------- campaign ----------------
q("first_purchase", ("cph",), "SELECT customer_id, first_purchase_date FROM cph")
q("first_repeat_flags", ("fact_sales",), """
SELECT order_id, customer_id, order_date, is_first_purchase, is_repeat_purchase FROM fact_sales""")
q("campaign_calendar", ("campaign_dates",), """
SELECT campaign_key, campaign_id, budget, start_date, end_date, date_key, full_date FROM campaign_dates""")
q("campaign_customers", ("campaign_customers",), "SELECT * FROM campaign_customers")
q("campaign_customer_status", ("ccs",), "SELECT * FROM ccs")
q("sales_influenced", ("sales_infl",), "SELECT * FROM sales_infl")
q("new_customers_acquired", ("new_cust",), "SELECT * FROM new_cust")
q("repeat_purchase_rate", ("fact_marketing",), "SELECT campaign_key, date_key, repeat_purchase_rate FROM fact_marketing")
q("campaign_roi", ("fact_marketing",), "SELECT * FROM fact_marketing")

# ---------------- reports ----------------
q("inventory_valuation", ("fact_inventory", "dim_date", "dim_products", "dim_stores", "dim_suppliers"), """
SELECT fi.date_key, dd.full_date, fi.product_key, dp.product_id, dp.product_name, dp.category, dp.subcategory,
       fi.store_key, ds.store_id, ds.store_name, fi.supplier_key, dsp.supplier_id, dsp.supplier_name,
       fi.ending_stock, fi.inventory_value
FROM fact_inventory fi LEFT JOIN dim_date dd ON fi.date_key = dd.date_key
LEFT JOIN dim_products dp ON fi.product_key = dp.product_key
LEFT JOIN dim_stores ds ON fi.store_key = ds.store_key
LEFT JOIN dim_suppliers dsp ON fi.supplier_key = dsp.supplier_key""")
q("turnover_category", ("fact_inventory", "dim_date", "dim_products", "dim_stores"), """
SELECT fi.product_key, dp.product_id, dp.product_name, dp.category, dp.subcategory, fi.store_key, ds.store_id,
       ds.store_name, fi.date_key, dd.full_date, fi.sold_quantity, fi.beginning_stock, fi.ending_stock,
       fi.stock_turnover_ratio,
       CASE WHEN fi.stock_turnover_ratio IS NULL THEN 'No Turnover Data' WHEN fi.stock_turnover_ratio = 0 THEN 'No Movement'
            WHEN fi.stock_turnover_ratio >= 1 THEN 'High Turnover' ELSE 'Low Turnover' END AS turnover_category
FROM fact_inventory fi LEFT JOIN dim_products dp ON fi.product_key = dp.product_key
LEFT JOIN dim_stores ds ON fi.store_key = ds.store_key LEFT JOIN dim_date dd ON fi.date_key = dd.date_key""")
q("movement_quartiles", ("fact_inventory", "dim_products"), """
SELECT product_key, product_id, product_name, category, subcategory, total_sold_quantity,
       average_stock_turnover_ratio, total_inventory_value, turnover_quartile,
       CASE WHEN average_stock_turnover_ratio IS NULL THEN 'No Movement' WHEN turnover_quartile = 1 THEN 'Slow-Moving'
            WHEN turnover_quartile = 4 THEN 'Fast-Moving' ELSE 'Medium-Moving' END AS product_movement_category
FROM (SELECT *, CAST(ntile(4) OVER (ORDER BY average_stock_turnover_ratio ASC NULLS LAST, product_key ASC) AS INTEGER)
                    AS turnover_quartile
      FROM (SELECT fi.product_key, dp.product_id, dp.product_name, dp.category, dp.subcategory,
                   CAST(sum(fi.sold_quantity) AS BIGINT) AS total_sold_quantity,
                   round(avg(fi.stock_turnover_ratio), 6) AS average_stock_turnover_ratio,
                   CAST(sum(fi.inventory_value) AS DECIMAL(18,2)) AS total_inventory_value
            FROM fact_inventory fi LEFT JOIN dim_products dp ON fi.product_key = dp.product_key
            GROUP BY fi.product_key, dp.product_id, dp.product_name, dp.category, dp.subcategory))""")
q("ontime_vs_delayed", ("fact_inventory", "dim_suppliers", "dim_stores", "dim_date"), """
SELECT supplier_key, supplier_id, supplier_name, supplier_type, store_key, store_id, store_name, address_state,
       size_category, date_key, full_date, year, month, quarter, supply_status,
       COUNT(DISTINCT inventory_key) AS inventory_snapshot_count,
       CAST(sum(purchased_quantity) AS BIGINT) AS total_purchased_quantity,
       CAST(sum(sold_quantity) AS BIGINT) AS total_sold_quantity,
       CAST(sum(ending_stock) AS BIGINT) AS total_ending_inventory,
       CAST(sum(inventory_value) AS DECIMAL(18,2)) AS total_inventory_value,
       round(avg(snapshot_gap_days), 6) AS average_snapshot_gap_days,
       COUNT(DISTINCT CASE WHEN supply_status = 'On Time' THEN inventory_key END) AS on_time_snapshot_count,
       COUNT(DISTINCT CASE WHEN supply_status = 'Delayed' THEN inventory_key END) AS delayed_snapshot_count,
       round(CAST(COUNT(DISTINCT CASE WHEN supply_status = 'On Time' THEN inventory_key END) AS DOUBLE)
             / CAST(nullif(COUNT(DISTINCT inventory_key), 0) AS DOUBLE) * 100.0, 2) AS on_time_percentage,
       round(CAST(COUNT(DISTINCT CASE WHEN supply_status = 'Delayed' THEN inventory_key END) AS DOUBLE)
             / CAST(nullif(COUNT(DISTINCT inventory_key), 0) AS DOUBLE) * 100.0, 2) AS delayed_percentage
FROM (SELECT i.*, d.full_date, d.year, d.month, d.quarter, s.supplier_id, s.supplier_name, s.supplier_type,
             st.store_id, st.store_name, st.address_state, st.size_category,
             CASE WHEN coalesce(i.snapshot_gap_flag, FALSE) = TRUE THEN 'Delayed' ELSE 'On Time' END AS supply_status
      FROM fact_inventory i LEFT JOIN dim_suppliers s ON i.supplier_key = s.supplier_key
      LEFT JOIN dim_stores st ON i.store_key = st.store_key LEFT JOIN dim_date d ON i.date_key = d.date_key)
GROUP BY supplier_key, supplier_id, supplier_name, supplier_type, store_key, store_id, store_name, address_state,
         size_category, date_key, full_date, year, month, quarter, supply_status""")
q("supplier_concentration_risk", ("fact_inventory", "dim_suppliers"), f"""
SELECT supplier_key, supplier_id, supplier_name, total_purchased_quantity, all_supplier_purchased_quantity,
       share AS supplier_purchase_share_percentage,
       CASE WHEN share >= 50 THEN 'Very High' WHEN share >= 30 THEN 'High' WHEN share >= 15 THEN 'Medium' ELSE 'Low' END
           AS supplier_concentration_risk
FROM (SELECT sp.*, tp.t AS all_supplier_purchased_quantity,
             {ratio('sp.total_purchased_quantity', 'tp.t', '100.0')} AS share
      FROM (SELECT fi.supplier_key, dsp.supplier_id, dsp.supplier_name,
                   CAST(sum(fi.purchased_quantity) AS BIGINT) AS total_purchased_quantity
            FROM fact_inventory fi LEFT JOIN dim_suppliers dsp ON fi.supplier_key = dsp.supplier_key
            GROUP BY fi.supplier_key, dsp.supplier_id, dsp.supplier_name) sp
      CROSS JOIN (SELECT CAST(sum(total_purchased_quantity) AS BIGINT) AS t
                  FROM (SELECT sum(purchased_quantity) AS total_purchased_quantity FROM fact_inventory
                        GROUP BY supplier_key)) tp)""")
Q["supplier_category_contribution"] = with_ctes(("fact_inventory", "dim_products", "dim_suppliers"), f"""
SELECT sc.supplier_key, sc.supplier_id, sc.supplier_name, sc.category, sc.supplier_purchased_quantity,
       ct.total_category_purchased_quantity,
       {ratio('sc.supplier_purchased_quantity', 'ct.total_category_purchased_quantity', '100.0')}
           AS supplier_contribution_percentage
FROM (SELECT fi.supplier_key, dsp.supplier_id, dsp.supplier_name, fi.product_key, dp.product_id, dp.product_name,
             dp.category, CAST(sum(fi.purchased_quantity) AS BIGINT) AS supplier_purchased_quantity
      FROM fact_inventory fi LEFT JOIN dim_products dp ON fi.product_key = dp.product_key
      LEFT JOIN dim_suppliers dsp ON fi.supplier_key = dsp.supplier_key
      GROUP BY fi.supplier_key, dsp.supplier_id, dsp.supplier_name, fi.product_key, dp.product_id, dp.product_name,
               dp.category) sc
LEFT JOIN (SELECT category, CAST(sum(supplier_purchased_quantity) AS BIGINT) AS total_category_purchased_quantity
           FROM (SELECT dp.category, sum(fi.purchased_quantity) AS supplier_purchased_quantity
                 FROM fact_inventory fi LEFT JOIN dim_products dp ON fi.product_key = dp.product_key
                 GROUP BY fi.supplier_key, fi.product_key, dp.category)
           GROUP BY category) ct ON sc.category = ct.category""")
q("engagement_metrics", ("fact_marketing", "dim_campaign"), """
SELECT fmp.campaign_key, dmc.campaign_id, dmc.target_audience_segment,
       min(fmp.date_key) AS campaign_start_date_key, max(fmp.date_key) AS campaign_end_date_key,
       CAST(sum(fmp.new_customers_acquired) AS BIGINT) AS new_customers_acquired,
       round(avg(fmp.repeat_purchase_rate), 6) AS repeat_purchase_rate,
       round(avg(CAST(fmp.total_sales_influenced AS DOUBLE)), 6) AS average_daily_sales_influenced,
       CAST(sum(fmp.total_sales_influenced) AS DECIMAL(18,2)) AS total_sales_influenced
FROM fact_marketing fmp LEFT JOIN dim_campaign dmc ON fmp.campaign_key = dmc.campaign_key
GROUP BY fmp.campaign_key, dmc.campaign_id, dmc.target_audience_segment""")
q("roi_by_segment", ("fact_marketing", "dim_campaign"), f"""
SELECT target_audience_segment, campaign_count, total_sales_influenced, total_campaign_cost, average_roi,
       {ratio('total_sales_influenced - total_campaign_cost', 'total_campaign_cost', '100.0')} AS calculated_roi
FROM (SELECT dmc.target_audience_segment, COUNT(DISTINCT fmp.campaign_key) AS campaign_count,
             CAST(sum(fmp.total_sales_influenced) AS DECIMAL(18,2)) AS total_sales_influenced,
             CAST(sum(fmp.total_campaign_cost) AS DECIMAL(18,2)) AS total_campaign_cost,
             round(avg(fmp.roi), 6) AS average_roi
      FROM fact_marketing fmp LEFT JOIN dim_campaign dmc ON fmp.campaign_key = dmc.campaign_key
      GROUP BY dmc.target_audience_segment)""")
q("sales_impact", ("fact_marketing", "dim_campaign", "dim_date"), """
SELECT fmp.campaign_key, dmc.campaign_id, dmc.target_audience_segment, fmp.date_key, dd.full_date,
       fmp.total_sales_influenced, fmp.total_campaign_cost, fmp.roi
FROM fact_marketing fmp LEFT JOIN dim_campaign dmc ON fmp.campaign_key = dmc.campaign_key
LEFT JOIN dim_date dd ON fmp.date_key = dd.date_key""")

# ---------------- checks ----------------
def _nn(table: str, cols: list[str], label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'not_null' AS \"check\", '{label}' AS table_name, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {table}" for c in cols)


def _uq(src: str, key: str, label: str) -> str:
    return (f"SELECT 'unique' AS \"check\", '{label}' AS table_name, '{key}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM (SELECT {key} FROM {src} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} HAVING count(*) > 1)")


def _rel(child: str, fk: str, parent: str, pk: str, label: str) -> str:
    return (f"SELECT 'relationships' AS \"check\", '{label}' AS table_name, '{fk}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM {child} c WHERE c.{fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


Q["check_not_null"] = with_ctes(("fact_inventory", "items", "fact_marketing"), "\nUNION ALL\n".join([
    _nn("fact_inventory", ["inventory_key", "product_key", "date_key", "store_key", "supplier_key"], "fact_inventory"),
    _nn("items", ["order_item_key", "order_id", "product_id", "store_id"], "silver_order_items"),
    _nn("fact_marketing", ["marketing_performance_key", "campaign_key", "date_key"], "fact_marketing_performance"),
]))
Q["check_unique"] = with_ctes(("fact_inventory", "items", "product_history", "dim_products", "fact_marketing",
                               "item_versions"), "\nUNION ALL\n".join([
    _uq("fact_inventory", "inventory_key", "fact_inventory"),
    _uq("items", "order_item_key", "silver_order_items"),
    _uq("product_history", "product_history_key", "silver_product_history"),
    _uq("dim_products", "product_key", "dim_products"),
    _uq("fact_marketing", "marketing_performance_key", "fact_marketing_performance"),
    _uq(f"(SELECT {sk('order_id', 'item_number')} AS k FROM item_versions)", "k", "item_versions"),
]))
Q["check_relationships"] = with_ctes(("fact_inventory", "dim_products", "dim_stores", "dim_suppliers", "dim_date",
                                      "fact_marketing", "dim_campaign", "items", "customers"), "\nUNION ALL\n".join([
    _rel("fact_inventory", "product_key", "dim_products", "product_key", "fact_inventory"),
    _rel("fact_inventory", "store_key", "dim_stores", "store_key", "fact_inventory"),
    _rel("fact_inventory", "supplier_key", "dim_suppliers", "supplier_key", "fact_inventory"),
    _rel("fact_inventory", "date_key", "dim_date", "date_key", "fact_inventory"),
    _rel("fact_marketing", "campaign_key", "dim_campaign", "campaign_key", "fact_marketing_performance"),
    _rel("items", "customer_id", "customers", "customer_id", "silver_order_items"),
]))


def _declared(source: str, label: str, keys: str, required: str = "", parents: dict[str, tuple[str, str]] | None = None) -> str:
    """The declared checks of one table: keys are not null and unique, foreign keys name (CTE, label) of their parent."""
    parts = [(_nn(source, [c], label), None) for c in (keys + " " + required).split()]
    parts += [(_uq(source, c, label), None) for c in keys.split()]
    parts += [(_rel(source, c, p, c, label), name) for c, (p, name) in (parents or {}).items()]
    return "\nUNION ALL\n".join(
        f"SELECT \"check\", table_name, column_name, {'NULL' if name is None else repr(name)} AS parent, 'error' AS severity, "
        f"violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({sql})" for sql, name in parts)


Q["declared_checks"] = with_ctes(
    ("customers", "product_history", "items", "orders_s", "stores", "suppliers", "campaigns", "inventory", "dim_date",
     "dim_campaign", "dim_products", "dim_stores", "dim_suppliers", "fact_inventory", "fact_marketing"),
    "\nUNION ALL\n".join([
        _declared("customers", "silver_customers", "customer_id"),
        _declared("product_history", "silver_product_history", "product_history_key", "product_id source_snapshot_date"),
        _declared("items", "silver_order_items", "order_item_key", "order_id product_id"),
        _declared("orders_s", "silver_orders", "order_id"),
        _declared("stores", "silver_stores", "store_id"),
        _declared("suppliers", "silver_suppliers", "supplier_id"),
        _declared("campaigns", "silver_campaigns", "campaign_id"),
        _declared("inventory", "silver_inventory", "inventory_key", "product_id inventory_date"),
        _declared("dim_date", "dim_date", "date_key full_date"),
        _declared("dim_campaign", "dim_marketing_campaign", "campaign_key campaign_id", "start_date end_date"),
        _declared("dim_products", "dim_products", "product_key product_id"),
        _declared("dim_stores", "dim_stores", "store_key store_id"),
        _declared("dim_suppliers", "dim_suppliers", "supplier_key supplier_id"),
        _declared("fact_inventory", "fact_inventory", "inventory_key", "product_key date_key store_key supplier_key",
                  {"product_key": ("dim_products", "dim_products"), "date_key": ("dim_date", "dim_date"),
                   "store_key": ("dim_stores", "dim_stores"), "supplier_key": ("dim_suppliers", "dim_suppliers")}),
        _declared("fact_marketing", "fact_marketing_performance", "marketing_performance_key",
                  "campaign_key date_key campaign_id full_date",
                  {"campaign_key": ("dim_campaign", "dim_marketing_campaign"), "date_key": ("dim_date", "dim_date")}),
    ]))


def oracle_sql() -> dict[str, str]:
    return dict(Q)

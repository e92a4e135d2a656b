"""The same results as SQL over the test tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Views ----------------------------------------------------------------------------------------

ORDERS = """
orders_v AS (
  SELECT o.o_custkey AS customer_id,
         CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
         CAST(o.o_orderdate AS DATE) AS order_date,
         l.l_orderkey AS order_id,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price,
         l.l_partkey AS product_id,
         CAST(l.l_extendedprice AS DECIMAL(12,2))
           * (CAST(l.l_tax AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS profit,
         CAST(l.l_quantity AS BIGINT) AS quantity,
         CAST(l.l_linenumber AS BIGINT) AS row_id,
         CAST(l.l_shipdate AS DATE) AS ship_date,
         l.l_returnflag AS ship_mode
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

CUSTOMERS = """
all_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         n_name AS country, CAST(c_nationkey AS VARCHAR) AS state, r_name AS region,
         CAST(c_acctbal AS DECIMAL(12,2)) AS balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey
),
customers_v AS (SELECT * FROM all_customers WHERE balance >= 0),
repeated_customers AS (
  SELECT * FROM all_customers UNION ALL SELECT * FROM all_customers WHERE balance < 0
)"""

PRODUCTS = """
all_products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS sub_category,
         p_name AS product_name, CAST(p_size AS VARCHAR) AS state,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price_per_product
  FROM part
),
products_v AS (SELECT * FROM all_products WHERE price_per_product >= 910),
repeated_products AS (
  SELECT * FROM all_products
  UNION ALL
  SELECT product_id, category, 'Brand#0', product_name, state, price_per_product
  FROM all_products WHERE CAST(state AS INTEGER) <= 10
)"""


def wide(customers: str = "customers_v", products: str = "products_v") -> str:
    return f"""{ORDERS}, {CUSTOMERS}, {PRODUCTS},
wide_v AS (
  SELECT o.*, CAST(year(o.order_date) AS INTEGER) AS order_year,
         c.customer_name, c.segment, c.country, c.state AS customer_state, c.region,
         p.category, p.sub_category, p.product_name, p.state AS product_state, p.price_per_product
  FROM orders_v o
  LEFT JOIN {customers} c ON o.customer_id = c.customer_id
  LEFT JOIN {products} p ON o.product_id = p.product_id
)"""


def measured(source: str, name: str = "measured") -> str:
    return f"""
{name}_amounts AS (
  SELECT *, ROUND(price * quantity, 2) AS total_sales, ROUND(price * discount, 2) AS discount_amount FROM {source}
),
{name} AS (
  SELECT *, total_sales - discount_amount AS final_price FROM {name}_amounts
)"""


def half_up(amount: str, divisor: str) -> str:
    """Two-digit quotient of a two-digit amount, by whole-number arithmetic on cents."""
    cents = f"CAST(({amount}) * 100 AS HUGEINT)"
    by = f"CAST({divisor} AS HUGEINT)"
    return (
        f"CAST(CAST(sign({cents}) AS HUGEINT) * ((2 * abs({cents}) + {by}) // (2 * {by})) AS DOUBLE)"
        " / CAST(100 AS DOUBLE)"
    )


WIDE_COLUMNS = """
  product_id, customer_id, CAST(discount AS DOUBLE) AS discount, order_date, order_id,
  CAST(price AS DOUBLE) AS price, CAST(profit AS DOUBLE) AS profit, quantity, row_id, ship_date, ship_mode,
  customer_name, segment, country, customer_state, region, order_year,
  category, sub_category, product_name, product_state, CAST(price_per_product AS DOUBLE) AS price_per_product"""

MEASURE_COLUMNS = f"""
  CAST(total_sales AS DOUBLE) AS total_sales, CAST(discount_amount AS DOUBLE) AS discount_amount,
  CAST(final_price AS DOUBLE) AS final_price,
  CASE WHEN quantity <> 0 THEN {half_up("final_price", "quantity")} END AS unit_selling_price,
  CAST(datediff('day', order_date, ship_date) AS INTEGER) AS days_to_ship"""

CUSTOMER_METRICS = f"""
  CAST(ROUND(SUM(final_price), 2) AS DOUBLE) AS customer_lifetime_value,
  CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS customer_lifetime_profit,
  CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
  {half_up("SUM(quantity)", "COUNT(quantity)")} AS avg_bag_size,
  {half_up("SUM(final_price)", "COUNT(final_price)")} AS avg_order_value,
  MIN(order_date) AS first_order_date, MAX(order_date) AS latest_order_date"""

PRODUCT_METRICS = f"""
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  CAST(ROUND(SUM(final_price), 2) AS DOUBLE) AS total_revenue_generated,
  {half_up("SUM(discount_amount)", "COUNT(discount_amount)")} AS avg_discount,
  CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS distinct_customers_bought"""

# Profit tables --------------------------------------------------------------------------------

PROFITS = {
    "profit_by_year_cat_sub_customer": ("order_year, category, sub_category, customer_name", "total_profit"),
    "profit_by_year": ("order_year", "profit_per_year"),
    "profit_by_year_category": ("order_year, category", "profit_per_year_category"),
    "profit_by_customer": ("customer_name", "profit_per_customer"),
    "profit_by_customer_year": ("customer_name, order_year", "profit_per_customer_year"),
}


def profit(name: str, source: str) -> str:
    keys, alias = PROFITS[name]
    return (
        f"WITH {source} SELECT {keys}, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS {alias} FROM wide_v GROUP BY {keys}"
    )


for _name in PROFITS:
    ORACLE[_name] = profit(_name, wide())
    if _name != "profit_by_year_cat_sub_customer":
        ORACLE[f"{_name}_sql"] = ORACLE[_name]

ORACLE["profit_all_grains"] = f"""
WITH {wide()}
SELECT CASE GROUPING(order_year, category, sub_category, customer_name)
         WHEN 0 THEN 'profit_by_year_cat_sub_customer' WHEN 7 THEN 'profit_by_year'
         WHEN 3 THEN 'profit_by_year_category' WHEN 14 THEN 'profit_by_customer'
         WHEN 6 THEN 'profit_by_customer_year' END AS grain,
       order_year, category, sub_category, customer_name, CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS profit
FROM wide_v
GROUP BY GROUPING SETS ((order_year, category, sub_category, customer_name), (order_year),
                        (order_year, category), (customer_name), (customer_name, order_year))"""
REPEATED = wide("repeated_customers", "repeated_products")
ORACLE["profit_by_year_category_fan_out"] = profit("profit_by_year_category", REPEATED)
ORACLE["profit_cells_fan_out"] = profit("profit_by_year_cat_sub_customer", REPEATED)

# Enrichment -----------------------------------------------------------------------------------

ORACLE["wide_fact"] = f"WITH {wide()} SELECT {WIDE_COLUMNS} FROM wide_v"
ORACLE["wide_fact_salted"] = f"WITH {REPEATED} SELECT {WIDE_COLUMNS} FROM wide_v"
ORACLE["order_measures"] = f"""
WITH {ORDERS}, {measured("orders_v")}
SELECT customer_id, CAST(discount AS DOUBLE) AS discount, order_date, order_id, CAST(price AS DOUBLE) AS price,
       product_id, CAST(profit AS DOUBLE) AS profit, quantity, row_id, ship_date, ship_mode, {MEASURE_COLUMNS}
FROM measured"""
ORACLE["order_measures_double"] = ORACLE["order_measures"]
ORACLE["customer_metrics"] = f"""
WITH {wide()}, {measured("wide_v")} SELECT customer_id, {CUSTOMER_METRICS} FROM measured GROUP BY customer_id"""
ORACLE["customer_metrics_double"] = ORACLE["customer_metrics"]
ORACLE["customer_metrics_fan_out"] = f"""
WITH {REPEATED}, {measured("wide_v")} SELECT customer_id, {CUSTOMER_METRICS} FROM measured GROUP BY customer_id"""
ORACLE["product_metrics"] = f"""
WITH {wide()}, {measured("wide_v")} SELECT product_id, {PRODUCT_METRICS} FROM measured GROUP BY product_id"""
ORACLE["customer_metrics_by_loads"] = ORACLE["customer_metrics"]
ORACLE["product_metrics_by_loads"] = ORACLE["product_metrics"]
ORACLE["product_metrics_fan_out"] = f"""
WITH {REPEATED}, {measured("wide_v")} SELECT product_id, {PRODUCT_METRICS} FROM measured GROUP BY product_id"""
ORACLE["enriched_table"] = f"""
WITH {wide()}, {measured("wide_v")},
by_customer AS (SELECT customer_id AS cid, {CUSTOMER_METRICS} FROM measured GROUP BY customer_id),
by_product AS (SELECT product_id AS pid, {PRODUCT_METRICS} FROM measured GROUP BY product_id)
SELECT {WIDE_COLUMNS}, {MEASURE_COLUMNS},
       total_units_sold, total_revenue_generated, avg_discount, distinct_customers_bought,
       customer_lifetime_value, customer_lifetime_profit, total_orders, avg_bag_size, avg_order_value,
       first_order_date, latest_order_date
FROM measured LEFT JOIN by_product ON product_id = pid LEFT JOIN by_customer ON customer_id = cid"""
ORACLE["enriched_table_from_metrics"] = ORACLE["enriched_table"]
ORACLE["order_info"] = f"""
WITH {wide()}
SELECT order_id, customer_name, country, category, sub_category, quantity, CAST(price AS DOUBLE) AS price,
       CAST(discount AS DOUBLE) AS discount, CAST(ROUND(profit, 2) AS DOUBLE) AS profit
FROM wide_v"""
ORACLE["average_quantity_by_segment"] = f"""
WITH {wide()}
SELECT segment, {half_up("SUM(quantity)", "COUNT(quantity)")} AS avg_quantity FROM wide_v GROUP BY segment"""
ORACLE["largest_discount_by_region"] = f"""
WITH {wide()}
SELECT region, category, CAST(ROUND(MAX(discount), 1) AS DOUBLE) AS discount FROM wide_v GROUP BY region, category"""

# Rules and quarantine -------------------------------------------------------------------------

TEXT_ORDERS = f"""{ORDERS},
text_orders AS (
  SELECT CAST(customer_id AS VARCHAR) AS customer_id, CAST(discount AS VARCHAR) AS discount,
         CASE WHEN order_id % 10 = 0 THEN strftime(order_date, '%Y-13-%d')
              WHEN order_id % 2 = 0 THEN strftime(order_date, '%-d/%-m/%Y')
              ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
         CAST(order_id AS VARCHAR) AS order_id,
         CASE WHEN row_id = 6 THEN '-' || CAST(price AS VARCHAR) ELSE CAST(price AS VARCHAR) END AS price,
         CAST(product_id AS VARCHAR) AS product_id,
         CASE WHEN row_id <> 5 THEN CAST(profit AS VARCHAR) END AS profit,
         CASE WHEN row_id = 7 THEN 'abc' ELSE CAST(quantity AS VARCHAR) END AS quantity,
         CAST(row_id AS VARCHAR) AS row_id,
         strftime(ship_date, '%Y-%m-%d') AS ship_date,
         ship_mode
  FROM orders_v
)"""


def as_date(column: str) -> str:
    return f"""CAST(CASE
      WHEN regexp_full_match({column}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN try_strptime({column}, '%d/%m/%Y')
      WHEN regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_strptime({column}, '%Y-%m-%d')
    END AS DATE)"""


def as_long(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, ' *[+-]?[0-9]+ *') THEN TRY_CAST({column} AS BIGINT) END"


def flagged(name: str, source: str, types: dict[str, str], rules: list[tuple[str, str]]) -> str:
    """Typed columns beside the texts, then the names of the rules a row does not meet."""
    typed = ", ".join(f"{expression} AS {column}_t" for column, expression in types.items())
    failed = ", ".join(f"CASE WHEN NOT COALESCE({condition}, FALSE) THEN '{rule}' END" for rule, condition in rules)
    return f"""
{name}_typed AS (SELECT *, {typed} FROM {source}),
{name} AS (
  SELECT *, concat_ws('; ', {failed}) AS failed_rules, COALESCE({failed}) AS first_failed_rule FROM {name}_typed
)"""


ORDER_FLAGS = flagged(
    "flagged",
    "text_orders",
    {
        "discount": "TRY_CAST(discount AS DOUBLE)",
        "order_date": as_date("order_date"),
        "price": "TRY_CAST(price AS DOUBLE)",
        "profit": "TRY_CAST(profit AS DOUBLE)",
        "quantity": as_long("quantity"),
        "row_id": as_long("row_id"),
        "ship_date": as_date("ship_date"),
    },
    [
        ("discount as double", "discount_t IS NOT NULL"),
        ("order_date as date", "order_date_t IS NOT NULL"),
        ("price as double", "price_t IS NOT NULL"),
        ("profit as double", "profit_t IS NOT NULL"),
        ("quantity as long", "quantity_t IS NOT NULL"),
        ("row_id as long", "row_id_t IS NOT NULL"),
        ("ship_date as date", "ship_date_t IS NOT NULL"),
        ("price >= 0", "price_t >= 0"),
        ("quantity >= 0", "quantity_t >= 0"),
        ("ship_date >= order_date", "ship_date_t >= order_date_t"),
    ],
)
TYPE_FLAGS = flagged(
    "flagged",
    "text_orders",
    {"quantity": as_long("quantity"), "profit": "TRY_CAST(profit AS DOUBLE)"},
    [("quantity as long", "quantity_t IS NOT NULL"), ("profit as double", "profit_t IS NOT NULL")],
)
DATE_FLAGS = flagged(
    "flagged",
    "text_orders",
    {"order_date": as_date("order_date")},
    [("order_date as date", "order_date_t IS NOT NULL")],
)

ORACLE["type_rules_valid"] = f"""
WITH {TEXT_ORDERS}, {TYPE_FLAGS}
SELECT order_id, row_id, product_id, quantity_t AS quantity, profit_t AS profit
FROM flagged WHERE first_failed_rule IS NULL"""
ORACLE["type_rules_quarantine"] = f"""
WITH {TEXT_ORDERS}, {TYPE_FLAGS}
SELECT order_id, row_id, product_id, quantity, profit, first_failed_rule, failed_rules
FROM flagged WHERE first_failed_rule IS NOT NULL"""
ORACLE["date_rule_valid"] = f"""
WITH {TEXT_ORDERS}, {DATE_FLAGS}
SELECT order_id, row_id, product_id, order_date_t AS order_date FROM flagged WHERE first_failed_rule IS NULL"""
ORACLE["date_rule_quarantine"] = f"""
WITH {TEXT_ORDERS}, {DATE_FLAGS}
SELECT order_id, row_id, product_id, order_date FROM flagged WHERE first_failed_rule IS NOT NULL"""
ORACLE["orders_clean"] = f"""
WITH {TEXT_ORDERS}, {ORDER_FLAGS}
SELECT customer_id, discount_t AS discount, order_date_t AS order_date, order_id, price_t AS price, product_id,
       profit_t AS profit, quantity_t AS quantity, row_id_t AS row_id, ship_date_t AS ship_date, ship_mode
FROM flagged WHERE first_failed_rule IS NULL"""
ORACLE["orders_quarantine"] = f"""
WITH {TEXT_ORDERS}, {ORDER_FLAGS}
SELECT customer_id, discount, order_date, order_id, price, product_id, profit, quantity, row_id, ship_date,
       ship_mode, first_failed_rule, failed_rules
FROM flagged WHERE first_failed_rule IS NOT NULL"""
ORACLE["staged_orders"] = f"""
WITH {TEXT_ORDERS}, {ORDER_FLAGS}
SELECT order_id, row_id_t AS row_id, product_id, order_date_t AS order_date
FROM flagged WHERE first_failed_rule IS NULL"""

TEXT_CUSTOMERS = """
text_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
         CASE c_custkey % 5 WHEN 0 THEN 'buyer.' || c_custkey || '@shop.example.com'
                            WHEN 1 THEN 'buyer' || c_custkey || ' at example.com'
                            WHEN 3 THEN c_name || '@example.com'
                            WHEN 4 THEN 'b' || c_custkey || '@-x.co' END AS email,
         c_mktsegment AS segment,
         CASE c_custkey % 7 WHEN 0 THEN '12.5' WHEN 1 THEN '0' WHEN 2 THEN '00' || c_custkey
                            ELSE CAST(c_custkey + 1000 AS VARCHAR) END AS postal_code
  FROM customer
)"""
EMAIL = "'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$'"
CUSTOMER_FLAGS = flagged(
    "flagged",
    "text_customers",
    {"postal_code": as_long("postal_code")},
    [
        ("postal_code as long", "postal_code_t IS NOT NULL"),
        ("postal_code > 0", "postal_code_t > 0"),
        ("email is an email", f"regexp_matches(email, {EMAIL})"),
    ],
)
TEXT_PRODUCTS = """
text_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_brand AS sub_category,
         p_name AS product_name,
         CASE p_partkey % 11 WHEN 0 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || ' EUR'
                             WHEN 1 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
                             ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_per_product
  FROM part
)"""
PRODUCT_FLAGS = flagged(
    "flagged",
    "text_products",
    {"price_per_product": "TRY_CAST(price_per_product AS DOUBLE)"},
    [
        ("price_per_product as double", "price_per_product_t IS NOT NULL"),
        ("price_per_product >= 0", "price_per_product_t >= 0"),
    ],
)
ORACLE["customers_clean"] = f"""
WITH {TEXT_CUSTOMERS}, {CUSTOMER_FLAGS}
SELECT customer_id, customer_name, email, segment, postal_code_t AS postal_code
FROM flagged WHERE first_failed_rule IS NULL"""
ORACLE["customers_quarantine"] = f"""
WITH {TEXT_CUSTOMERS}, {CUSTOMER_FLAGS}
SELECT customer_id, email, postal_code, first_failed_rule, failed_rules
FROM flagged WHERE first_failed_rule IS NOT NULL"""
ORACLE["products_clean"] = f"""
WITH {TEXT_PRODUCTS}, {PRODUCT_FLAGS}
SELECT product_id, category, sub_category, product_name, price_per_product_t AS price_per_product
FROM flagged WHERE first_failed_rule IS NULL"""
ORACLE["products_quarantine"] = f"""
WITH {TEXT_PRODUCTS}, {PRODUCT_FLAGS}
SELECT product_id, category, sub_category, product_name, price_per_product, first_failed_rule, failed_rules
FROM flagged WHERE first_failed_rule IS NOT NULL"""


def renamed(flags: str, name: str) -> str:
    return flags.replace("flagged_typed", f"{name}_typed").replace("flagged AS", f"{name} AS")


ORACLE["quarantine_counts"] = f"""
WITH {TEXT_ORDERS}, {renamed(ORDER_FLAGS, "order_flags")},
{TEXT_CUSTOMERS}, {renamed(CUSTOMER_FLAGS, "customer_flags")},
{TEXT_PRODUCTS}, {renamed(PRODUCT_FLAGS, "product_flags")},
everything AS (
  SELECT 'orders' AS dataset, first_failed_rule FROM order_flags
  UNION ALL SELECT 'customers', first_failed_rule FROM customer_flags
  UNION ALL SELECT 'products', first_failed_rule FROM product_flags
)
SELECT dataset, first_failed_rule, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(COUNT(*) AS BIGINT) AS with_raw_values
FROM everything WHERE first_failed_rule IS NOT NULL GROUP BY dataset, first_failed_rule"""

for _word, _symbol in {"gt": ">", "lt": "<", "ge": ">=", "le": "<=", "eq": "=", "ne": "<>"}.items():
    ORACLE[f"compare_literal_{_word}"] = (
        f"SELECT c_custkey AS customer_id, CAST(c_acctbal AS DECIMAL(12,2)) {_symbol} 1000.5 AS flag FROM customer"
    )
    ORACLE[f"compare_text_{_word}"] = f"SELECT o_orderkey, o_orderpriority {_symbol} '3' AS flag FROM orders"
    ORACLE[f"compare_date_{_word}"] = (
        f"WITH {ORDERS} SELECT order_id, row_id, order_date {_symbol} DATE '1995-01-01' AS flag FROM orders_v"
    )
    ORACLE[f"compare_columns_{_word}"] = (
        f"WITH {ORDERS} SELECT order_id, row_id, ship_date {_symbol} order_date AS flag FROM orders_v"
    )
ORACLE["ship_before_order_quarantine"] = f"""
WITH {ORDERS}
SELECT order_id, row_id, product_id, order_date, ship_date FROM orders_v
WHERE NOT COALESCE(ship_date >= order_date, FALSE)"""
ORACLE["email_flag"] = f"""
WITH {TEXT_CUSTOMERS} SELECT customer_id, email, regexp_matches(email, {EMAIL}) AS flag FROM text_customers"""
ORACLE["email_tokens"] = f"""
WITH tokens AS (SELECT doc_id, unnest(string_split_regex(text, '[ \\t\\r\\n\\f]+')) AS token FROM documents)
SELECT doc_id, token, regexp_matches(token, {EMAIL}) AS flag FROM tokens WHERE contains(token, '@')"""

# Key, null and reference reports ----------------------------------------------------------------

ORACLE["duplicate_order_lines"] = f"""
WITH {ORDERS},
repeated AS (SELECT order_id, product_id FROM orders_v GROUP BY order_id, product_id HAVING COUNT(*) > 1)
SELECT o.order_id, o.product_id, o.row_id, o.quantity, CAST(o.price AS DOUBLE) AS price
FROM orders_v o JOIN repeated r ON o.order_id = r.order_id AND o.product_id = r.product_id"""
ORACLE["duplicate_key_counts"] = f"""
WITH {ORDERS}
SELECT order_id, row_id, CAST(COUNT(*) AS BIGINT) AS copies FROM orders_v
GROUP BY order_id, row_id HAVING COUNT(*) > 1"""
NULLABLE = [
    "product_id", "customer_id", "discount", "order_date", "order_id", "price", "profit", "quantity", "row_id",
    "ship_date", "ship_mode", "customer_name", "segment", "country", "customer_state", "region", "order_year",
    "category", "sub_category", "product_name", "product_state", "price_per_product",
]
ORACLE["null_counts"] = f"WITH {wide()}, counts AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM wide_v"
    for c in NULLABLE
) + ") SELECT column_name, null_count FROM counts WHERE null_count > 0"
ORACLE["null_counts_wide"] = f"WITH {TEXT_ORDERS} SELECT " + ", ".join(
    f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS {c}" for c in NULLABLE[:11]
) + " FROM text_orders"
ORACLE["null_report"] = f"""
WITH {TEXT_ORDERS} SELECT CAST(COUNT(*) FILTER (WHERE profit IS NULL) AS BIGINT) AS profit FROM text_orders"""
ORACLE["orphans_by_customer"] = f"""
WITH {ORDERS}, {CUSTOMERS}
SELECT customer_id, CAST(discount AS DOUBLE) AS discount, order_date, order_id, CAST(price AS DOUBLE) AS price,
       product_id, CAST(profit AS DOUBLE) AS profit, quantity, row_id, ship_date, ship_mode
FROM orders_v o WHERE NOT EXISTS (SELECT 1 FROM customers_v c WHERE c.customer_id = o.customer_id)"""
ORACLE["orphans_by_customer_and_product"] = f"""
WITH {ORDERS}
SELECT order_id, row_id, customer_id, product_id FROM orders_v o
WHERE NOT EXISTS (SELECT 1 FROM orders_v r WHERE r.ship_mode = 'N' AND r.customer_id = o.customer_id AND r.product_id = o.product_id)"""
ORACLE["orphans_by_stored_filter"] = f"""
WITH {ORDERS}, {CUSTOMERS}
SELECT order_id, row_id, customer_id, product_id FROM orders_v o
WHERE NOT EXISTS (SELECT 1 FROM customers_v c WHERE c.customer_id = o.customer_id)"""
ORACLE["orphans_by_product"] = f"""
WITH {ORDERS}, {PRODUCTS}
SELECT order_id, row_id, product_id, customer_id
FROM orders_v o WHERE NOT EXISTS (SELECT 1 FROM products_v p WHERE p.product_id = o.product_id)"""
ORACLE["conform_types"] = f"""
WITH {TEXT_ORDERS}
SELECT customer_id, TRY_CAST(discount AS DOUBLE) AS discount,
       CASE WHEN contains(order_date, '-') THEN TRY_CAST(order_date AS DATE) END AS order_date,
       order_id, TRY_CAST(price AS DOUBLE) AS price, product_id,
       TRY_CAST(profit AS DOUBLE) AS profit, {as_long("quantity")} AS quantity, {as_long("row_id")} AS row_id,
       TRY_CAST(ship_date AS DATE) AS ship_date, ship_mode
FROM text_orders"""

# Sources and sinks ------------------------------------------------------------------------------

ORACLE["csv_products"] = f"""
WITH {TEXT_PRODUCTS} SELECT product_id, category, sub_category, product_name, price_per_product FROM text_products"""
ORACLE["json_orders"] = f"""
WITH {TEXT_ORDERS}
SELECT customer_id, discount, order_date, order_id, price, product_id, profit, quantity, row_id, ship_date, ship_mode
FROM text_orders"""
ORACLE["xlsx_customers"] = f"""
WITH {TEXT_CUSTOMERS} SELECT customer_id, customer_name, email, segment, postal_code FROM text_customers"""
ORACLE["table_roundtrip"] = f"""
WITH {ORDERS}
SELECT customer_id, CAST(discount AS DOUBLE) AS discount, order_date, order_id, CAST(price AS DOUBLE) AS price,
       product_id, CAST(profit AS DOUBLE) AS profit, quantity, row_id, ship_date, ship_mode
FROM orders_v"""
ORACLE["ingested_quarantine"] = ORACLE["quarantine_counts"]
ORACLE["ingested_profit_by_year_category"] = f"""
WITH {TEXT_ORDERS}, {renamed(ORDER_FLAGS, "order_flags")}, {TEXT_PRODUCTS}, {renamed(PRODUCT_FLAGS, "product_flags")}
SELECT CAST(year(o.order_date_t) AS INTEGER) AS order_year, p.category,
       CAST(ROUND(SUM(CAST(o.profit AS DECIMAL(17,4))), 2) AS DOUBLE) AS profit_per_year_category
FROM order_flags o
LEFT JOIN product_flags p ON o.product_id = p.product_id AND p.first_failed_rule IS NULL
WHERE o.first_failed_rule IS NULL
GROUP BY 1, 2"""

ORACLE["ingested_counts"] = f"""
WITH {TEXT_ORDERS}, {renamed(ORDER_FLAGS, "order_flags")},
{TEXT_CUSTOMERS}, {renamed(CUSTOMER_FLAGS, "customer_flags")},
{TEXT_PRODUCTS}, {renamed(PRODUCT_FLAGS, "product_flags")},
everything AS (
  SELECT 'orders' AS dataset, first_failed_rule FROM order_flags
  UNION ALL SELECT 'customers', first_failed_rule FROM customer_flags
  UNION ALL SELECT 'products', first_failed_rule FROM product_flags
),
counters AS (
  SELECT dataset, 'rows' AS counter FROM everything
  UNION ALL SELECT dataset, COALESCE(first_failed_rule, 'kept') FROM everything
)
SELECT dataset, counter, CAST(COUNT(*) AS BIGINT) AS row_count FROM counters GROUP BY dataset, counter"""
ORACLE["batched_quarantine"] = f"""
WITH {TEXT_ORDERS}, {renamed(ORDER_FLAGS, "order_flags")},
{TEXT_CUSTOMERS}, {renamed(CUSTOMER_FLAGS, "customer_flags")},
{TEXT_PRODUCTS}, {renamed(PRODUCT_FLAGS, "product_flags")},
loads(load_batch) AS (VALUES ('first load'), ('second load')),
everything AS (
  SELECT CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'first load' ELSE 'second load' END AS load_batch,
         'orders' AS dataset, first_failed_rule FROM order_flags
  UNION ALL SELECT load_batch, 'customers', first_failed_rule FROM customer_flags, loads
  UNION ALL SELECT load_batch, 'products', first_failed_rule FROM product_flags, loads
)
SELECT load_batch, dataset, first_failed_rule, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(COUNT(*) AS BIGINT) AS with_raw_values
FROM everything WHERE first_failed_rule IS NOT NULL GROUP BY load_batch, dataset, first_failed_rule"""
ORACLE["batched_orders"] = ORACLE["staged_orders"]

ORACLE["streamed_orders"] = ORACLE["staged_orders"]
ORACLE["streamed_counts"] = f"""
WITH {TEXT_ORDERS}, {ORDER_FLAGS}
SELECT 'orders' AS dataset, first_failed_rule, CAST(COUNT(*) AS BIGINT) AS row_count
FROM flagged WHERE first_failed_rule IS NOT NULL GROUP BY first_failed_rule"""

PRICES = """
price_list AS (
  SELECT p_partkey AS product_id, v AS version,
         DATE '1992-01-01' + CAST(v * 420 + p_partkey % 90 AS INTEGER) AS valid_from,
         CASE WHEN v < 5 THEN DATE '1992-01-01' + CAST(v * 420 + p_partkey % 90 + 379 AS INTEGER) END AS valid_to
  FROM part, (VALUES (0), (1), (2), (3), (4), (5)) AS versions(v)
),
dated_lines AS (
  SELECT order_id, row_id, CASE WHEN order_id % 3 = 0 THEN 1 ELSE product_id END AS product_id, order_date FROM orders_v
)"""
ORACLE["list_price_at_order"] = f"""
WITH {ORDERS}, {PRICES}
SELECT order_id, row_id, d.product_id, order_date, valid_from, valid_to, version
FROM dated_lines d LEFT JOIN price_list p
  ON p.product_id = d.product_id AND order_date BETWEEN valid_from AND COALESCE(valid_to, DATE '9999-12-31')"""
ORACLE["last_price_before_order"] = f"""
WITH {ORDERS}, {PRICES}
SELECT order_id, row_id, d.product_id, order_date, p.valid_from, p.version
FROM dated_lines d LEFT JOIN price_list p ON p.product_id = d.product_id AND p.valid_from = (
  SELECT max(valid_from) FROM price_list q WHERE q.product_id = d.product_id AND q.valid_from <= order_date)"""

# Profiles, sessions, differences and greatest rows ------------------------------------------------

ORACLE["line_profile"] = f"""
WITH {ORDERS}, lines AS (SELECT customer_id, product_id, quantity, price, ship_mode, order_date FROM orders_v)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER ({c} IS NULL) AS null_count, "
    "TRUE AS distinct_close, TRUE AS median_close, TRUE AS frequent_close FROM lines"
    for c in ("customer_id", "product_id", "quantity", "price", "ship_mode", "order_date")
)
ORACLE["event_sessions"] = """
WITH placed AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, ts, CAST(value AS DECIMAL(12,2)) AS value, event_id FROM events
), marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS begins FROM placed
), numbered AS (
  SELECT *, SUM(begins) OVER (PARTITION BY user_id ORDER BY ts) AS number FROM marked
)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS events, CAST(SUM(value) AS DOUBLE) AS total_value,
       MIN(event_id) AS first_event, MAX(event_id) AS last_event
FROM numbered GROUP BY user_id, number"""

LOADS = """
old_lines AS (SELECT order_id, row_id, product_id, price, ship_mode FROM orders_v),
kept AS (
  SELECT order_id, row_id, product_id, CAST(CASE WHEN product_id % 50 = 0 THEN price + 1 ELSE price END AS DECIMAL(12,2)) AS price,
         CASE WHEN order_id % 40 <> 1 THEN ship_mode END AS ship_mode
  FROM old_lines WHERE row_id <> 7
),
new_lines AS (
  SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE order_id % 30 = 2 UNION ALL SELECT * FROM kept WHERE order_id % 30 = 2
),
removed AS (SELECT * FROM old_lines EXCEPT ALL SELECT * FROM new_lines),
added AS (SELECT * FROM new_lines EXCEPT ALL SELECT * FROM old_lines)"""
ORACLE["line_differences"] = f"""
WITH {ORDERS}, {LOADS}, both_ways AS (SELECT *, -1 AS copy FROM removed UNION ALL SELECT *, 1 FROM added)
SELECT order_id, row_id, product_id, CAST(price AS DOUBLE) AS price, ship_mode, CAST(SUM(copy) AS BIGINT) AS copies
FROM both_ways GROUP BY order_id, row_id, product_id, price, ship_mode"""
ORACLE["line_changes"] = f"""
WITH {ORDERS}, {LOADS},
both_ways AS (SELECT *, -1 AS copy FROM removed UNION ALL SELECT *, 1 FROM added),
totals AS (
  SELECT order_id, row_id, COUNT(*) FILTER (copy < 0) AS removed, COUNT(*) FILTER (copy > 0) AS added
  FROM both_ways GROUP BY order_id, row_id
),
differing AS (
  SELECT DISTINCT order_id, row_id, place, name FROM (
    SELECT order_id, row_id, 1 AS place, 'product_id' AS name FROM both_ways GROUP BY order_id, row_id, product_id HAVING SUM(copy) <> 0
    UNION ALL SELECT order_id, row_id, 2, 'price' FROM both_ways GROUP BY order_id, row_id, price HAVING SUM(copy) <> 0
    UNION ALL SELECT order_id, row_id, 3, 'ship_mode' FROM both_ways GROUP BY order_id, row_id, ship_mode HAVING SUM(copy) <> 0)
),
listed AS (SELECT order_id, row_id, string_agg(name, ',' ORDER BY place) AS columns FROM differing GROUP BY order_id, row_id)
SELECT t.order_id, t.row_id, removed, added, columns,
       CASE WHEN NOT EXISTS (SELECT 1 FROM new_lines n WHERE n.order_id = t.order_id AND n.row_id = t.row_id) THEN 'removed' ELSE 'changed' END AS change
FROM totals t JOIN listed l ON l.order_id = t.order_id AND l.row_id = t.row_id"""
ORACLE["top_lines_by_customer"] = f"""
WITH {ORDERS}, placed AS (
  SELECT CASE WHEN order_id % 3 = 0 THEN 1 ELSE customer_id END AS customer_id, order_id, row_id, quantity FROM orders_v
), ranked AS (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY quantity DESC NULLS LAST) AS place FROM placed)
SELECT customer_id, order_id, row_id, quantity FROM ranked WHERE place <= 3"""

# Layouts that files really have, and reports over them -------------------------------------------

ORACLE["json_array_orders"] = ORACLE["json_orders"]
ORACLE["json_array_divided_orders"] = ORACLE["json_array_orders"]
ORACLE["xlsx_folder_customers"] = ORACLE["xlsx_customers"]
ORACLE["xlsx_mixed_headers"] = f"""
WITH {TEXT_CUSTOMERS}
SELECT customer_id, email, CASE WHEN CAST(customer_id AS BIGINT) % 3 < 2 THEN segment END AS segment, postal_code,
       CAST(customer_id AS BIGINT) % 3 < 2 AS readable
FROM text_customers"""
ORACLE["csv_malformed_products"] = f"""
WITH {TEXT_PRODUCTS}
SELECT product_id, CASE
  WHEN CAST(product_id AS BIGINT) % 13 = 0 OR CAST(product_id AS BIGINT) % 17 = 0 THEN 'readable record'
  WHEN TRY_CAST(price_per_product AS DOUBLE) IS NULL THEN 'price_per_product as double'
  WHEN TRY_CAST(price_per_product AS DOUBLE) < 0 THEN 'price_per_product >= 0' END AS first_failed_rule
FROM text_products"""
ORACLE["long_decimal_measures"] = f"""
WITH {ORDERS},
lines AS (SELECT order_id, row_id, quantity, CAST(price AS DOUBLE) / CAST(7.31 AS DOUBLE) AS price, CAST(discount AS DOUBLE) / CAST(3.7 AS DOUBLE) AS discount FROM orders_v)
SELECT order_id, row_id, ROUND(price * quantity, 2) AS total_sales, ROUND(price * discount, 2) AS discount_amount FROM lines"""
ORACLE["enriched_orders"] = f"""
WITH {wide()}, {measured("wide_v")} SELECT {WIDE_COLUMNS}, {MEASURE_COLUMNS} FROM measured"""
ORACLE["orders_key_report"] = f"""
WITH {TEXT_ORDERS}, {ORDER_FLAGS},
keyed AS (SELECT * FROM flagged WHERE first_failed_rule IS NULL OR failed_rules = 'ship_date >= order_date'),
repeated AS (SELECT order_id, product_id FROM keyed GROUP BY ALL HAVING COUNT(*) > 1)
SELECT k.order_id, k.product_id, row_id_t AS row_id, order_date_t AS order_date, ship_date_t AS ship_date
FROM keyed k JOIN repeated r ON k.order_id = r.order_id AND k.product_id = r.product_id"""
ORACLE["products_key_report"] = f"""
WITH {PRODUCTS}
SELECT product_id, category, sub_category FROM repeated_products
WHERE product_id IN (SELECT product_id FROM repeated_products GROUP BY product_id HAVING COUNT(*) > 1)"""
ORACLE["customers_key_report"] = f"""
WITH {CUSTOMERS}
SELECT customer_id, segment FROM repeated_customers
WHERE customer_id IN (SELECT customer_id FROM repeated_customers GROUP BY customer_id HAVING COUNT(*) > 1)"""
ORACLE["products_null_counts"] = f"""
WITH {TEXT_PRODUCTS},
counts AS (
  SELECT 'state' AS column_name, COUNT(*) AS null_count FROM text_products
  UNION ALL
  SELECT 'price_per_product', COUNT(*) FILTER (WHERE TRY_CAST(price_per_product AS DOUBLE) IS NULL) FROM text_products
)
SELECT column_name, CAST(null_count AS BIGINT) AS null_count FROM counts WHERE null_count > 0"""
ORACLE["has_missing_references"] = f"""
WITH {ORDERS}, {CUSTOMERS}, {PRODUCTS},
missing AS (
  SELECT 'customer_id' AS key, COUNT(*) AS lines FROM orders_v WHERE customer_id NOT IN (SELECT customer_id FROM customers_v)
  UNION ALL
  SELECT 'product_id', COUNT(*) FROM orders_v WHERE product_id NOT IN (SELECT product_id FROM products_v)
)
SELECT key, lines, lines > 0 AS missing FROM missing"""

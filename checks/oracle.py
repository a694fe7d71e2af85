"""The registered queries once more, as plain SQL for DuckDB over the same Parquet tables."""

from __future__ import annotations

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_key, 'C' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS customer_id,
         c_name AS customer_name, r_name AS region, c_mktsegment AS segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_key, 'P' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS product_id,
         p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS list_price
  FROM part
)"""

# money: the integer is widened first so that every product is exact
def measures(quantity: str, price: str, rate: str) -> str:
    gross = f"CAST({quantity} AS DECIMAL(10,0)) * CAST({price} AS DECIMAL(12,2))"
    discount = f"CAST({gross} AS DECIMAL(16,2)) * CAST({rate} AS DECIMAL(5,4))"
    return f"""
         CAST(round({gross}, 2) AS DECIMAL(14,2)) AS gross_sales,
         CAST(round({discount}, 2) AS DECIMAL(14,2)) AS discount_amount,
         CAST(round({gross} - {discount}, 2) AS DECIMAL(14,2)) AS net_sales"""


FACTS = f"""
lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         o_custkey AS customer_key, l_partkey AS product_key,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(5,4)) AS discount_rate
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
),
facts AS (
  SELECT *, {measures("quantity", "unit_price", "discount_rate")} FROM lines
)"""

FEED = """
placed AS (SELECT *, row_number() OVER () + 1 AS row_num FROM lineitem),
lined AS (
  SELECT *, l_orderkey * 10 + l_linenumber AS oid, l_partkey % 97 AS k,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
         lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS cust
  FROM placed LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
),
feed AS (
  SELECT row_num, l_returnflag,
    'sales_' || coalesce(strftime(o_orderdate, '%Y_%m'), 'unknown') || '.csv' AS source_file,
    CASE k WHEN 1 THEN 'ORD-' || oid WHEN 2 THEN '' ELSE CAST(oid AS VARCHAR) END AS order_id,
    CASE k WHEN 3 THEN '15/01/2026' WHEN 4 THEN '2199-01-01' WHEN 5 THEN '1990-02-03'
           WHEN 24 THEN '' ELSE coalesce(strftime(o_orderdate, '%Y-%m-%d'), '') END AS order_date,
    CASE k WHEN 6 THEN '' WHEN 7 THEN 'C999999999' WHEN 8 THEN ' c' || cust || ' '
           ELSE coalesce('C' || cust, '') END AS customer_id,
    CASE k WHEN 9 THEN 'P999999999'
           ELSE 'P' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') END AS product_id,
    CASE k WHEN 1 THEN '-2' WHEN 10 THEN 'three' WHEN 11 THEN '0' WHEN 12 THEN '5000'
           WHEN 13 THEN '-2' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE k WHEN 14 THEN 'abc' WHEN 15 THEN '$' || price WHEN 16 THEN '1,299.00'
           WHEN 17 THEN '19.999' WHEN 18 THEN '0.00' WHEN 19 THEN 'NaN' ELSE coalesce(price, '') END
      AS unit_price,
    CASE k WHEN 20 THEN 'ten percent' WHEN 21 THEN '1.00' WHEN 22 THEN '1.50' WHEN 23 THEN '-0.10'
           WHEN 25 THEN '1.0000000000001'
           ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount_rate
  FROM lined
)"""

NUMBER = r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?"

FIELDS = ("order_id", "order_date", "customer_id", "product_id", "quantity", "unit_price",
          "discount_rate")

_ROW_RULES = [
    *[("MISSING_FIELD", f"trim({f}) = ''", f"'{f} is required but absent or empty'")
      for f in FIELDS],
    ("BAD_INT_ORDER_ID", "trim(order_id) <> '' AND n_order IS NULL",
     "'order_id ''' || order_id || ''' is not an integer'"),
    ("BAD_DATE_FORMAT", "trim(order_date) <> '' AND n_date IS NULL",
     "'order_date ''' || order_date || ''' is not YYYY-MM-DD'"),
    ("BAD_INT_QUANTITY", "trim(quantity) <> '' AND n_quantity IS NULL",
     "'quantity ''' || quantity || ''' is not an integer'"),
    ("NON_NUMERIC_CURRENCY", "marked",
     "'unit_price ''' || unit_price || ''' carries currency formatting; expected a bare decimal'"),
    ("BAD_DECIMAL_PRICE", "trim(unit_price) <> '' AND NOT marked AND n_price IS NULL",
     "'unit_price ''' || unit_price || CASE WHEN upper(unit_price) = 'NAN' "
     "THEN ''' is not a finite decimal' ELSE ''' is not a decimal' END"),
    ("BAD_DECIMAL_DISCOUNT", "trim(discount_rate) <> '' AND n_rate IS NULL",
     "'discount_rate ''' || discount_rate || ''' is not a decimal'"),
    ("DATE_IN_FUTURE", "n_date > DATE '2026-08-17'",
     "'order_date ' || strftime(n_date, '%Y-%m-%d') || ' is after today (2026-08-17)'"),
    ("DATE_OUT_OF_PERIOD", "strftime(n_date, '%Y-%m') <> period",
     "'order_date ' || strftime(n_date, '%Y-%m-%d') || ' is outside the file''s period ' || period"),
    ("QTY_NOT_POSITIVE", "n_quantity <= 0",
     "'quantity ' || n_quantity || ' must be greater than zero'"),
    ("QTY_EXCEEDS_THRESHOLD", "n_quantity > 1000",
     "'quantity ' || n_quantity || ' exceeds the 1000 outlier threshold'"),
    ("PRICE_NOT_POSITIVE", "n_price <= 0",
     "'unit_price ' || unit_price || ' must be greater than zero'"),
    ("PRICE_PRECISION",
     "n_price IS NOT NULL AND length(regexp_extract(unit_price, '[.]([0-9]*)', 1)) > 2",
     "'unit_price ' || unit_price || ' has more than two decimal places'"),
    ("DISCOUNT_EQ_ONE", "n_rate = 1",
     "'discount_rate is exactly 1.0, which posts zero revenue'"),
    ("DISCOUNT_OUT_OF_RANGE", "n_rate < 0 OR n_rate > 1",
     "'discount_rate ' || discount_rate || ' is outside [0, 1)'"),
    ("UNKNOWN_CUSTOMER", "n_customer IS NOT NULL AND known_customer IS NULL",
     "'customer_id ''' || n_customer || ''' is not in the customer reference set'"),
    ("UNKNOWN_PRODUCT", "n_product IS NOT NULL AND known_product IS NULL",
     "'product_id ''' || n_product || ''' is not in the product reference set'"),
]
_DUPLICATE = ("DUPLICATE_ORDER_ID", "row_num > first_accepted",
              "'order_id ' || n_order || ' already appeared in this file'")


def _list(with_detail: bool) -> str:
    def text(code: str, detail: str) -> str:
        return f"'{code}: ' || {detail}" if with_detail else f"'{code}'"

    return ",\n      ".join(
        f"CASE WHEN {cond} THEN {text(code, detail)} END" for code, cond, detail in _ROW_RULES
    )


def _dup(with_detail: bool) -> str:
    code, cond, detail = _DUPLICATE
    text = f"'{code}: ' || {detail}" if with_detail else f"'{code}'"
    return f"CASE WHEN {cond} THEN {text} END"


def judged_from(feed: str, tag: str = "") -> str:
    """CTEs that judge the rows of ``feed``; their names end in ``tag``."""
    return f"""
typed{tag} AS (
  SELECT *,
    CASE WHEN regexp_full_match(trim(order_id), '[+-]?[0-9]+')
         THEN TRY_CAST(trim(order_id) AS BIGINT) END AS n_order,
    CASE WHEN regexp_full_match(trim(order_date), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')
         THEN TRY_CAST(trim(order_date) AS DATE) END AS n_date,
    nullif(upper(trim(customer_id)), '') AS n_customer,
    nullif(upper(trim(product_id)), '') AS n_product,
    CASE WHEN regexp_full_match(trim(quantity), '[+-]?[0-9]+')
         THEN TRY_CAST(trim(quantity) AS BIGINT) END AS n_quantity,
    regexp_matches(unit_price, '[$€£¥,]') AS marked,
    CASE WHEN regexp_full_match(trim(unit_price), '{NUMBER}')
         THEN TRY_CAST(trim(unit_price) AS DECIMAL(38,12)) END AS n_price,
    CASE WHEN regexp_full_match(trim(discount_rate), '{NUMBER}')
         THEN TRY_CAST(trim(discount_rate) AS DECIMAL(38,20)) END AS n_rate,
    nullif(regexp_extract(source_file, '([0-9]{{4}})_([0-9]{{2}})', 1) || '-'
      || regexp_extract(source_file, '([0-9]{{4}})_([0-9]{{2}})', 2), '-') AS period
  FROM {feed}
),
checked{tag} AS (
  SELECT t.*,
    concat_ws(' | ', {_list(False)}) AS row_codes,
    concat_ws(' | ', {_list(True)}) AS row_details
  FROM typed{tag} t
    LEFT JOIN (SELECT customer_id AS known_customer FROM customers) ON n_customer = known_customer
    LEFT JOIN (SELECT product_id AS known_product FROM products) ON n_product = known_product
),
reserved{tag} AS (
  SELECT *, CASE WHEN n_order IS NOT NULL
                 THEN min(CASE WHEN row_codes = '' THEN row_num END)
                      OVER (PARTITION BY source_file, n_order) END AS first_accepted
  FROM checked{tag}
),
judged{tag} AS (
  SELECT *, concat_ws(' | ', nullif(row_codes, ''), {_dup(False)}) AS codes,
            concat_ws(' | ', nullif(row_details, ''), {_dup(True)}) AS details
  FROM reserved{tag}
),
stg{tag} AS (
  SELECT source_file, row_num, n_order AS order_id, n_date AS order_date,
         n_customer AS customer_id, n_product AS product_id, CAST(n_quantity AS INTEGER) AS quantity,
         CAST(n_price AS DECIMAL(12,2)) AS unit_price, CAST(n_rate AS DECIMAL(5,4)) AS discount_rate
  FROM judged{tag} WHERE codes = ''
),
measured{tag} AS (
  SELECT *, {measures("quantity", "unit_price", "discount_rate")} FROM stg{tag}
),
rejects{tag} AS (
  SELECT source_file, row_num, split_part(codes, ' | ', 1) AS reason_code, codes, details,
         order_id, order_date, customer_id, product_id, quantity, unit_price, discount_rate
  FROM judged{tag} WHERE codes <> ''
)"""


JUDGED = f"{CUSTOMERS},{PRODUCTS},{FEED},{judged_from('feed')}"
STAR = f"{CUSTOMERS},{PRODUCTS},{FACTS}"

RUNS = """
runs AS (
  SELECT source_file, count(*) AS rows_extracted,
         count(*) FILTER (WHERE codes = '') AS rows_valid,
         count(*) FILTER (WHERE codes <> '') AS rows_rejected
  FROM judged GROUP BY source_file
)"""

_EXACT_NET = (
    "CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price AS DECIMAL(16,2)) - "
    "CAST(CAST(quantity AS DECIMAL(10,0)) * unit_price AS DECIMAL(16,2)) * discount_rate"
)


# stored tables with the planted faults of tampered()
TAMPERED = """
t_stg AS (SELECT * FROM stg WHERE order_id % 103 <> 11),
t_facts AS (
  SELECT m.* REPLACE (CAST(CASE WHEN order_id % 97 = 5 THEN net_sales + 0.01 ELSE net_sales END
                           AS DECIMAL(14,2)) AS net_sales), ck.customer_key, pk.product_key
  FROM measured m
    JOIN (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM customers) ck
      USING (customer_id)
    JOIN (SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM products) pk
      USING (product_id)
  WHERE order_id % 107 <> 13
),
t_rejects AS (
  SELECT source_file, row_num FROM rejects
  UNION ALL SELECT source_file, row_num FROM stg WHERE order_id % 101 = 7
)"""


def _stored_constraints() -> str:
    from tallyworks.operators.audit import UNIQUE
    from tallyworks.schemas import NULLABLE, TABLES

    rows, values = [], ("quantity > 0", "unit_price > 0", "0 <= discount_rate < 1")
    for name, columns in TABLES.items():
        labels = [f"{c} not null" for c in columns if c not in NULLABLE[name]]
        labels += values if name in ("stg_sales", "fact_sales") else ()
        labels += [f"{c} unique" for c in UNIQUE.get(name, ())]
        rows += [f"SELECT '{name}' AS table_name, '{label}' AS constraint_name, "
                 "CAST(0 AS BIGINT) AS violations" for label in labels]
    for key, fault in (("customer_key", "% 89 = 3"), ("product_key", "% 83 = 2")):
        rows.append(f"SELECT 'fact_sales', '{key} references dimension', count(*) FROM t_facts "
                    f"WHERE {key} {fault}")
    return f"WITH {JUDGED},{TAMPERED}\n" + "\nUNION ALL ".join(rows)


def _load_report(returned: str) -> str:
    """Returned lines come again in a file of their own: their facts move."""
    return f"""WITH {JUDGED},{judged_from(returned, "_2")},
moved AS (SELECT count(*) AS n FROM measured WHERE order_id IN (SELECT order_id FROM measured_2))
SELECT 'dim_customers' AS table_name, CAST(0 AS BIGINT) AS removed, CAST(0 AS BIGINT) AS inserted,
  (SELECT count(*) FROM customers) AS updated
UNION ALL SELECT 'dim_products', 0, 0, (SELECT count(*) FROM products)
UNION ALL SELECT 'stg_sales', 0, (SELECT count(*) FROM stg_2), 0
UNION ALL SELECT 'fact_sales', (SELECT n FROM moved), (SELECT count(*) FROM measured_2), 0
UNION ALL SELECT 'etl_rejected_sales', 0, (SELECT count(*) FROM rejects_2), 0"""


def _per_file(facts: str, lines: str = "facts", net: str = "net_sales") -> str:
    return (
        f"SELECT source_file, count(*) AS {lines}, CAST(sum(net_sales) AS DOUBLE) AS {net} "
        f"FROM {facts} GROUP BY source_file"
    )


def _conservation(order: str) -> str:
    return f"""WITH {JUDGED},{RUNS},{TAMPERED}
SELECT r.source_file, r.rows_extracted,
  (SELECT count(*) FROM t_stg s WHERE s.source_file = r.source_file) AS staged,
  (SELECT count(*) FROM t_facts s WHERE s.source_file = r.source_file) AS facts,
  (SELECT count(*) FROM t_rejects s WHERE s.source_file = r.source_file) AS rejected,
  r.rows_extracted = (SELECT count(*) FROM t_stg s WHERE s.source_file = r.source_file)
    + (SELECT count(*) FROM t_rejects s WHERE s.source_file = r.source_file) AS conservation_holds,
  (SELECT count(*) FROM t_stg s WHERE s.source_file = r.source_file)
    = (SELECT count(*) FROM t_facts s WHERE s.source_file = r.source_file) AS staged_equals_facts
FROM runs r {order}"""


def _both(order: str) -> str:
    return f"""WITH {JUDGED},{RUNS},{TAMPERED},
pairs AS (
  SELECT s.source_file, count(*) AS n
  FROM t_stg s JOIN t_rejects x ON x.source_file = s.source_file AND x.row_num = s.row_num
  GROUP BY s.source_file
)
SELECT r.source_file, CAST(coalesce(p.n, 0) AS BIGINT) AS in_both,
  CAST(r.rows_extracted
    - (SELECT count(*) FROM t_stg s WHERE s.source_file = r.source_file)
    - (SELECT count(*) FROM t_rejects s WHERE s.source_file = r.source_file) AS BIGINT) AS in_neither
FROM runs r LEFT JOIN pairs p ON p.source_file = r.source_file {order}"""


_LATEST = "ORDER BY r.source_file DESC LIMIT 1"
_MEASURES = """CAST(gross_sales AS DOUBLE) AS gross_sales,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_sales AS DOUBLE) AS net_sales"""
_INPUTS = """quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_rate AS DOUBLE) AS discount_rate"""


def _audit() -> str:
    facts = ("order_id", "order_date", "customer_key", "product_key", "quantity", "unit_price",
             "discount_rate", "gross_sales", "discount_amount", "net_sales", "source_file")
    customers = ("customer_key", "customer_id", "customer_name", "region")
    products = ("product_key", "product_id", "product_name", "category")
    filed = ("facts2 AS (SELECT *, 'sales_' || strftime(order_date, '%Y_%m') || '.csv' "
             "AS source_file FROM facts)")

    def count(name: str, label: str, source: str, bad: str) -> str:
        return (f"SELECT '{name}' AS table_name, '{label}' AS constraint_name, "
                f"count(*) FILTER (WHERE {bad}) AS violations FROM {source}")

    rows = [count("fact_sales", f"{c} not null", "facts2", f"{c} IS NULL") for c in facts]
    rows += [
        count("fact_sales", "quantity > 0", "facts2", "NOT quantity > 0"),
        count("fact_sales", "unit_price > 0", "facts2", "NOT unit_price > 0"),
        count("fact_sales", "0 <= discount_rate < 1", "facts2",
              "NOT (discount_rate >= 0 AND discount_rate < 1)"),
    ]
    rows += [count("dim_customers", f"{c} not null", "customers", f"{c} IS NULL")
             for c in customers]
    rows += [count("dim_products", f"{c} not null", "products", f"{c} IS NULL") for c in products]
    for name, source, column in (
        ("fact_sales", "facts2", "order_id"),
        ("dim_customers", "customers", "customer_id"),
        ("dim_products", "products", "product_id"),
    ):
        repeated = f"(SELECT {column} FROM {source} GROUP BY {column} HAVING count(*) > 1)"
        rows.append(count(name, f"{column} unique", repeated, "true"))
    for dim, key in (("customers", "customer_key"), ("products", "product_key")):
        rows.append(
            count("fact_sales", f"{key} references dimension", "facts2",
                  f"{key} NOT IN (SELECT {key} FROM {dim})")
        )
    return f"WITH {STAR}, {filed}\n" + "\nUNION ALL ".join(rows)


def oracle() -> dict[str, str]:
    returned = "(SELECT * REPLACE ('returns.csv' AS source_file) FROM feed WHERE l_returnflag = 'R')"
    kept = "(SELECT * FROM feed WHERE l_returnflag <> 'R')"
    again = "(SELECT * FROM feed WHERE l_returnflag <> 'R' AND source_file LIKE 'sales_%_06.csv')"
    payload = ", ".join(FIELDS)
    return {
        "q1_revenue_per_day": f"""WITH {FACTS}
SELECT order_date, count(*) AS order_lines, CAST(sum(quantity) AS BIGINT) AS units,
  CAST(sum(gross_sales) AS DOUBLE) AS gross_sales,
  CAST(sum(discount_amount) AS DOUBLE) AS discount_given,
  CAST(sum(net_sales) AS DOUBLE) AS net_revenue
FROM facts GROUP BY order_date ORDER BY order_date""",
        "q2_product_revenue": f"""WITH {STAR}
SELECT product_id, product_name, category, CAST(sum(quantity) AS BIGINT) AS units_sold,
  CAST(sum(net_sales) AS DOUBLE) AS net_revenue,
  CAST((2 * CAST(sum(discount_rate) * 10000 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE)
    / 10000 AS avg_discount_rate
FROM facts JOIN products USING (product_key)
GROUP BY product_id, product_name, category ORDER BY net_revenue DESC, product_id""",
        "q3_region_revenue_share": f"""WITH {STAR}
SELECT region, count(DISTINCT customer_id) AS customers, count(*) AS order_lines,
  CAST(sum(net_sales) AS DOUBLE) AS net_revenue,
  CAST(round(sum(net_sales) / sum(sum(net_sales)) OVER () * 100, 2) AS DOUBLE) AS pct_of_total
FROM facts JOIN customers USING (customer_key) GROUP BY region ORDER BY net_revenue DESC, region""",
        "q4_customer_ltv": f"""WITH {STAR}
SELECT customer_id, customer_name, region, segment, count(*) AS order_lines,
  CAST(sum(net_sales) AS DOUBLE) AS lifetime_value,
  min(order_date) AS first_order, max(order_date) AS last_order
FROM facts JOIN customers USING (customer_key)
GROUP BY customer_id, customer_name, region, segment ORDER BY lifetime_value DESC, customer_id""",
        "q5_rejections_by_reason": f"""WITH {JUDGED}
SELECT reason_code, count(*) AS rejections,
  CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS DOUBLE) AS pct_of_rejections,
  min(row_num) AS first_row, max(row_num) AS last_row
FROM rejects GROUP BY reason_code ORDER BY rejections DESC, reason_code""",
        "q5b_rejected_payload_fields": f"""WITH {JUDGED}
SELECT row_num, reason_code, order_id AS raw_order_id, quantity AS raw_quantity,
  unit_price AS raw_unit_price, discount_rate AS raw_discount_rate, details AS reason_detail
FROM rejects ORDER BY row_num""",
        "r1_row_conservation": _conservation(""),
        "r1_row_conservation_latest": _conservation(_LATEST),
        "r2_measure_recompute": f"""WITH {JUDGED},{TAMPERED}
SELECT count(*) AS rows_compared,
  count(*) FILTER (WHERE m.net_sales <> round({_EXACT_NET}, 2)) AS mismatched_rows,
  CAST(sum(m.net_sales) AS DOUBLE) AS stored_net,
  CAST(sum(round({_EXACT_NET}, 2)) AS DOUBLE) AS recomputed_net,
  sum(m.net_sales) = sum(round({_EXACT_NET}, 2)) AS control_total_matches,
  CAST(round(sum({_EXACT_NET}), 2) AS DOUBLE) AS exact_then_rounded
FROM t_stg s JOIN (SELECT order_id, source_file, net_sales FROM t_facts) m
  USING (order_id, source_file)""",
        "r3_orphans": f"""WITH {JUDGED},{TAMPERED}
SELECT count(*) FILTER (WHERE customer_key % 89 = 3) AS orphan_customers,
  count(*) FILTER (WHERE product_key % 83 = 2) AS orphan_products
FROM t_facts""",
        "r4_missing_lines": f"""WITH {JUDGED},{TAMPERED}
SELECT source_file, row_num FROM judged EXCEPT
(SELECT source_file, row_num FROM t_stg UNION SELECT source_file, row_num FROM t_rejects)""",
        "r4_both_neither": _both(""),
        "r4_both_neither_latest": _both(_LATEST),
        "r5_additivity_gap": f"""WITH {FACTS}
SELECT CAST(sum(gross_sales) AS DOUBLE) AS gross, CAST(sum(discount_amount) AS DOUBLE) AS discount,
  CAST(sum(net_sales) AS DOUBLE) AS net,
  CAST(sum(gross_sales) - sum(discount_amount) - sum(net_sales) AS DOUBLE) AS additivity_gap,
  sum(gross_sales) - sum(discount_amount) - sum(net_sales) = -0.03 AS gap_as_expected,
  count(*) FILTER (WHERE gross_sales <> discount_amount + net_sales) AS half_cent_rows
FROM facts""",
        "r6_half_cent_rows": f"""WITH {JUDGED},{TAMPERED}
SELECT row_num, {_INPUTS}, {_MEASURES},
  CAST(gross_sales - discount_amount - net_sales AS DOUBLE) AS row_gap
FROM t_facts WHERE order_id % 103 <> 11 AND gross_sales <> discount_amount + net_sales ORDER BY row_num""",
        "r7_key_roundtrip": f"""WITH {STAR}
SELECT customer_id, product_id, order_id, order_date, {_INPUTS}, {_MEASURES}
FROM facts JOIN customers USING (customer_key) JOIN products USING (product_key)
ORDER BY order_id""",
        "r7_preview_compare": f"""WITH {JUDGED},
shown AS (SELECT * REPLACE (CAST(CASE WHEN order_id % 97 = 5 THEN net_sales + 0.01 ELSE net_sales END AS DECIMAL(14,2)) AS net_sales)
  FROM measured WHERE order_id % 103 <> 11),
sides AS (
  SELECT order_id, customer_id, net_sales, 1 AS f, 0 AS p FROM measured
  UNION ALL SELECT order_id, customer_id, net_sales, 0, 1 FROM shown
  UNION ALL SELECT order_id, customer_id, net_sales, 0, 1 FROM shown WHERE order_id % 101 = 7
)
SELECT order_id, customer_id, CAST(net_sales AS DOUBLE) AS net_sales, sum(f)::BIGINT AS in_facts, sum(p)::BIGINT AS in_preview
FROM sides GROUP BY order_id, customer_id, sides.net_sales HAVING sum(f) <> sum(p)""",
        "v_judge_primary_code": f"""WITH {JUDGED}
SELECT source_file, row_num, nullif(split_part(codes, ' | ', 1), '') AS reason_code FROM judged""",
        "v_defect_codes": f"WITH {JUDGED} SELECT source_file, row_num, codes FROM rejects",
        "v_split_counts": f"WITH {JUDGED},{RUNS} SELECT * FROM runs",
        "v_dedup_first_accepted": f"WITH {JUDGED} SELECT source_file, order_id, row_num FROM stg",
        "v_unknown_fk": f"""WITH {JUDGED}
SELECT source_file, row_num, customer_id AS raw_customer_id, product_id AS raw_product_id
FROM rejects WHERE codes LIKE '%UNKNOWN_CUSTOMER%' OR codes LIKE '%UNKNOWN_PRODUCT%'""",
        "v_secondary_code_counts": f"""WITH {JUDGED}
SELECT code AS reason_code, count(*) AS fired,
  count(*) FILTER (WHERE code = primary_code) AS as_primary
FROM (SELECT unnest(string_split(codes, ' | ')) AS code, reason_code AS primary_code FROM rejects)
GROUP BY code""",
        "v_rows_with_code": f"""WITH {JUDGED}
SELECT source_file, row_num, reason_code FROM rejects WHERE codes LIKE '%DUPLICATE_ORDER_ID%'""",
        "p_key_normalized_audit": f"""WITH {FEED}
SELECT source_file, row_num, field, before, upper(trim(before)) AS after, 'KEY_NORMALIZED' AS code
FROM (SELECT source_file, row_num, 'customer_id' AS field, customer_id AS before FROM feed
      UNION ALL SELECT source_file, row_num, 'product_id', product_id FROM feed)
WHERE trim(before) <> '' AND upper(trim(before)) <> before""",
        "p_typed_parse": f"""WITH {JUDGED}
SELECT row_num, n_order AS order_id, n_date AS order_date, n_customer AS customer_id,
  n_product AS product_id, n_quantity AS quantity,
  CAST(CASE WHEN NOT marked THEN n_price END AS DOUBLE) AS unit_price,
  CAST(CASE WHEN n_rate = CAST(n_rate AS DECIMAL(38,12)) THEN n_rate END AS DOUBLE) AS discount_rate
FROM typed""",
        "p_decimal_scale": f"""WITH {FEED}
SELECT CAST(CASE WHEN regexp_full_match(trim(unit_price), '{NUMBER}')
       THEN length(regexp_extract(trim(unit_price), '[.]([0-9]*)', 1)) END AS BIGINT)
       AS decimal_places, count(*) AS n
FROM feed GROUP BY 1""",
        "p_measures": f"""WITH {JUDGED}
SELECT source_file, row_num, order_id, {_MEASURES} FROM measured""",
        "s_period_from_filename": f"""WITH {FEED}
SELECT source_file, replace(source_file[7:13], '_', '-') AS period, count(*) AS n
FROM feed GROUP BY source_file""",
        "s_csv_scan": f"WITH {FEED} SELECT {payload} FROM feed",
        "s_csv_row_numbers": "SELECT count(*) AS rows_read, CAST(0 AS BIGINT) AS misplaced "
                             "FROM lineitem",
        "s_file_gate": """SELECT * FROM (VALUES
  ('sound', '', '', CAST(NULL AS BIGINT), true),
  ('short', 'discount_rate', '', NULL, false),
  ('wide', '', '', 2, false)) t(shape, missing, unexpected, surplus_line, sound)""",
        "s_file_shapes": f"""WITH {FEED}
SELECT {", ".join(f for f in FIELDS if f != "discount_rate")},
  CASE WHEN row_num % 41 = 0 THEN '' ELSE discount_rate END AS discount_rate
FROM feed""",
        "s_reference_shapes": """WITH files AS (SELECT count(DISTINCT c_custkey // 100000) AS n FROM customer)
SELECT shape, 'not valid JSON' AS fault, n
FROM files, (VALUES ('second array'), ('text behind'), ('second field')) AS shapes(shape)
UNION ALL SELECT 'wide price', 'list_price does not fit decimal(12,2)', count(*) FROM part""",
        "s_json_reference": f"WITH {CUSTOMERS} SELECT customer_id, customer_name, region, segment "
                            "FROM customers",
        "s_array_over_splits": f"""WITH {CUSTOMERS}
SELECT customer_id, customer_name, region, segment, '}} "],[{{ ' || customer_name AS said, customer_key AS deep_key
FROM customers""",
        "s_json_lines_reference": f"WITH {CUSTOMERS} SELECT customer_id, customer_name, region, "
                                  "segment FROM customers",
        "s_product_reference": f"WITH {PRODUCTS} SELECT product_id, product_name, category, "
                               "CAST(list_price AS DOUBLE) AS list_price FROM products",
        "k_dim_upsert_customers": f"""WITH {CUSTOMERS},
old AS (SELECT * FROM customers WHERE customer_key IN
        (SELECT o_custkey FROM orders WHERE o_orderdate < '1996-01-01')),
new AS (SELECT * FROM customers WHERE customer_key IN
        (SELECT o_custkey FROM orders WHERE o_orderdate >= '2001-01-01')
        OR customer_id NOT IN (SELECT customer_id FROM old)),
ids AS (
  SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS k FROM old
  UNION ALL
  SELECT customer_id, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY customer_id)
  FROM new WHERE customer_id NOT IN (SELECT customer_id FROM old)
)
SELECT i.k AS customer_key, i.customer_id,
  CASE WHEN n.customer_id IS NOT NULL THEN n.customer_name ELSE 'was ' || o.customer_name END
    AS customer_name,
  CASE WHEN n.customer_id IS NOT NULL THEN n.region ELSE 'UNKNOWN' END AS region,
  CASE WHEN n.customer_id IS NOT NULL THEN n.segment ELSE 'NONE' END AS segment,
  CASE WHEN n.customer_id IS NULL THEN DATE '1995-01-01' END AS signup_date
FROM ids i LEFT JOIN old o USING (customer_id) LEFT JOIN new n USING (customer_id)""",
        "k_dim_upsert_products": f"""WITH {PRODUCTS},
old AS (SELECT * FROM products WHERE product_key IN
        (SELECT l_partkey FROM lineitem WHERE l_shipdate < '1996-01-01')),
ids AS (
  SELECT product_id, row_number() OVER (ORDER BY product_id) AS k FROM old
  UNION ALL
  SELECT product_id, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY product_id)
  FROM products WHERE product_id NOT IN (SELECT product_id FROM old)
)
SELECT k AS product_key, product_id, product_name, category,
  CAST(list_price AS DOUBLE) AS list_price
FROM ids JOIN products USING (product_id)""",
        "k_surrogate_resolve": f"""WITH {JUDGED},
ck AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM customers),
pk AS (SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM products)
SELECT source_file, order_id, ck.customer_key, pk.product_key
FROM stg JOIN ck USING (customer_id) JOIN pk USING (product_id)""",
        "k_reload_idempotent": f"""WITH {JUDGED}
SELECT source_file, count(*) AS facts_before, CAST(sum(net_sales) AS DOUBLE) AS net_before,
  count(*) AS facts_after, CAST(sum(net_sales) AS DOUBLE) AS net_after
FROM measured GROUP BY source_file""",
        "k_reload_stale_removed": f"""WITH {JUDGED},{judged_from(kept, "_2")}
SELECT source_file, count(*) AS facts, CAST(sum(net_sales) AS DOUBLE) AS net_sales,
  CAST(0 AS BIGINT) AS stale
FROM measured_2 GROUP BY source_file""",
        "k_reload_cross_file": f"""WITH {JUDGED},{judged_from(returned, "_2")},
after AS (
  SELECT source_file, net_sales FROM measured
  WHERE order_id NOT IN (SELECT order_id FROM measured_2)
  UNION ALL SELECT source_file, net_sales FROM measured_2
),
staged AS (
  SELECT source_file, count(*) AS staged
  FROM (SELECT source_file FROM stg UNION ALL SELECT source_file FROM stg_2) GROUP BY source_file
)
SELECT * FROM ({_per_file("after")}) FULL JOIN staged USING (source_file)""",
        "k_sums_after_reload": f"""WITH {JUDGED},{judged_from(returned, "_2")},
after AS (
  SELECT order_date, customer_id, product_id, quantity, discount_rate, discount_amount, net_sales FROM measured
  WHERE order_id NOT IN (SELECT order_id FROM measured_2)
  UNION ALL SELECT order_date, customer_id, product_id, quantity, discount_rate, discount_amount, net_sales FROM measured_2
)
SELECT 'day' AS report, CAST(order_date AS VARCHAR) AS name, CAST(sum(quantity) AS BIGINT) AS n,
  CAST(sum(net_sales) AS DOUBLE) AS amount, CAST(sum(discount_amount) AS DOUBLE) AS more FROM after GROUP BY order_date
UNION ALL SELECT 'product', product_id, CAST(sum(quantity) AS BIGINT), CAST(sum(net_sales) AS DOUBLE),
  CAST((2 * CAST(sum(discount_rate) * 10000 AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000
FROM after GROUP BY product_id
UNION ALL SELECT 'region', region, count(DISTINCT customer_id), CAST(sum(net_sales) AS DOUBLE),
  CAST(round(sum(net_sales) / sum(sum(net_sales)) OVER () * 100, 2) AS DOUBLE)
FROM after JOIN customers USING (customer_id) GROUP BY region
UNION ALL SELECT 'customer', customer_id, count(*), CAST(sum(net_sales) AS DOUBLE),
  CAST(max(order_date) - min(order_date) AS DOUBLE) FROM after GROUP BY customer_id""",
        "k_load_report": _load_report(returned),
        "k_fact_preview": f"""WITH {JUDGED}
SELECT order_id, order_date, customer_id, product_id, {_INPUTS}, {_MEASURES}, row_num, source_file
FROM measured""",
        "k_rejected_records": f"""WITH {JUDGED}
SELECT source_file, row_num, reason_code, details AS reason_detail,
  CAST(json_object({", ".join(f"'{f}', {f}" for f in FIELDS)}) AS VARCHAR) AS raw_payload
FROM rejects""",
        "k_run_log": f"""WITH {JUDGED},{RUNS}
SELECT source_file, 'SUCCESS' AS status, CAST(2 AS BIGINT) AS runs, 2 * rows_extracted AS rows_extracted,
  2 * rows_valid AS rows_valid, 2 * rows_rejected AS rows_rejected, 2 * rows_valid AS rows_loaded
FROM runs""",
        "t_arriving_files": f"""WITH {JUDGED},{judged_from(again, "_2")},
counted AS (
  SELECT source_file, count(*) FILTER (WHERE codes = '') AS staged, count(*) FILTER (WHERE codes <> '') AS rejected
  FROM (SELECT source_file, codes FROM judged WHERE source_file NOT LIKE 'sales_%_06.csv'
        UNION ALL SELECT source_file, codes FROM judged_2) GROUP BY source_file
)
SELECT c.source_file, CASE WHEN c.source_file LIKE 'sales_%_06.csv' THEN 2 ELSE 1 END::BIGINT AS runs, f.facts, f.net_sales,
  nullif(c.staged, 0) AS staged, nullif(c.rejected, 0) AS rejected
FROM counted c LEFT JOIN ({_per_file("(SELECT source_file, net_sales FROM measured WHERE source_file NOT LIKE 'sales_%_06.csv' "
                                     "UNION ALL SELECT source_file, net_sales FROM measured_2)")}) f USING (source_file)""",
        "s_records_over_lines": f"""WITH {FEED},
lines AS (SELECT *, CASE WHEN row_num % 7 = 0 THEN 3 WHEN row_num % 2 = 0 THEN 2 ELSE 1 END AS n FROM feed)
SELECT source_file, (1 + sum(n) OVER (PARTITION BY source_file ORDER BY row_num))::BIGINT AS last_line, order_id,
  CASE n WHEN 3 THEN chr(10) || customer_id || chr(10) || '", x' WHEN 2 THEN customer_id || ',' || chr(10) || 'y'
    ELSE customer_id END AS customer_id, discount_rate
FROM lines""",
        "c_constraint_audit": _audit(),
        "c_unique_violations": f"""WITH {FACTS}
SELECT order_id, count(*) AS n FROM facts GROUP BY order_id HAVING count(*) > 1""",
        "c_fk_violations": f"""WITH {CUSTOMERS},{PRODUCTS},{FEED}
SELECT 'product_id' AS field, upper(trim(product_id)) AS id, count(*) AS n FROM feed
WHERE trim(product_id) <> ''
  AND upper(trim(product_id)) NOT IN (SELECT product_id FROM products) GROUP BY 2
UNION ALL
SELECT 'customer_id', upper(trim(customer_id)), count(*) FROM feed
WHERE trim(customer_id) <> ''
  AND upper(trim(customer_id)) NOT IN (SELECT customer_id FROM customers) GROUP BY 2""",
        "c_stored_constraints": _stored_constraints(),
    }

"""DuckDB SQL that each query must agree with.

The statements spell the definitions out: every pairing of sales with stock is
really joined, every report starts again from the lines. Sums are exact decimals
and become doubles last.
"""

from __future__ import annotations

import re

from martloom.schemas import RAW_SCHEMAS, is_key

_SQL_TYPE = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


def _key(day: str) -> str:
    return f"CAST(({day}) - DATE '1970-01-01' + 2440588 AS BIGINT)"


def _sunday(day: str) -> str:
    return f"(({day}) - CAST(dayofweek({day}) AS INTEGER))"


def _padded_week(day: str) -> str:
    return f"lpad(CAST(week({day}) AS VARCHAR), 2, '0')"


def _sales(prefix: str, remainder: int) -> str:
    store = prefix == "ss"
    site, customer, order = (
        ("store_sk", "customer_sk", "ticket_number")
        if store
        else ("warehouse_sk", "bill_customer_sk", "order_number")
    )
    ship = "" if store else (
        f", CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE {_key('d + 3')} END AS {prefix}_ship_date_sk"
    )
    return f"""
        SELECT CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE {_key('d')} END AS {prefix}_sold_date_sk,
               l_partkey AS {prefix}_item_sk,
               CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE l_suppkey END AS {prefix}_{site},
               CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE o_custkey END AS {prefix}_{customer},
               l_orderkey + 3000000000 AS {prefix}_{order},
               CASE WHEN l_discount = 0 THEN NULL
                    ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS BIGINT) END AS {prefix}_promo_sk,
               CASE WHEN l_orderkey % 37 = 0 THEN NULL WHEN l_orderkey % 41 = 0 THEN 0
                    WHEN copy = 1 THEN CAST(1 AS DECIMAL(10,0))
                    ELSE CAST(l_quantity AS DECIMAL(10,0)) END AS {prefix}_quantity,
               CAST(p_retailprice AS DECIMAL(10,2)) AS {prefix}_sales_price,
               ext * CAST(0.70 AS DECIMAL(4,2)) AS {prefix}_ext_wholesale_cost,
               ext * (CAST(0.30 AS DECIMAL(4,2)) - 5 * CAST(l_discount AS DECIMAL(4,2)))
                   AS {prefix}_net_profit{ship}
        FROM base WHERE l_linenumber % 3 = {remainder}"""


def _returns(prefix: str, amount: str, remainder: int) -> str:
    half = "CAST(CAST(l_quantity AS INTEGER) // 2 AS DECIMAL(10,0))"
    return f"""
        SELECT {_key('d + CAST(l_partkey % 20 AS INTEGER)')} AS {prefix}_returned_date_sk,
               l_partkey AS {prefix}_item_sk,
               {half} AS {prefix}_return_quantity,
               {half} * CAST(p_retailprice AS DECIMAL(10,2)) AS {amount},
               ext * CAST(0.10 AS DECIMAL(4,2)) AS {prefix}_net_loss
        FROM base WHERE l_linenumber % 3 = {remainder} AND l_returnflag = 'R' AND copy = 0"""


def _stock_and_sales_lines(prefix: str) -> str:
    return f"""
        SELECT {prefix}_warehouse_sk AS warehouse_sk, {prefix}_item_sk AS item_sk,
               {prefix}_sold_date_sk AS sold_date_sk, {prefix}_quantity AS daily_qty,
               {prefix}_quantity * {prefix}_sales_price AS daily_sales_amt,
               {prefix}_net_profit AS daily_net_profit
        FROM {prefix}
        WHERE {prefix}_quantity IS NOT NULL AND {prefix}_quantity * {prefix}_sales_price IS NOT NULL
          AND {prefix}_sold_date_sk IS NOT NULL AND {prefix}_warehouse_sk IS NOT NULL
          AND {prefix}_quantity > 0 AND {prefix}_quantity * {prefix}_sales_price > 0
          AND {prefix}_bill_customer_sk IS NOT NULL"""


def _channel_lines(prefix: str, channel: str, customer: str, site: str, order: str, promo: str) -> str:
    return f"""
        SELECT {customer} AS customer_sk, {prefix}_item_sk AS item_sk, {promo} AS promo_sk,
               {order} AS order_number, '{channel}' AS channel_key, {prefix}_sold_date_sk AS sold_date_sk,
               {prefix}_quantity AS daily_qty, {prefix}_quantity * {prefix}_sales_price AS daily_sales_amt,
               {prefix}_net_profit AS daily_net_profit, {prefix}_ext_wholesale_cost AS daily_cogs
        FROM {prefix}
        WHERE {prefix}_quantity > 0 AND {prefix}_sales_price IS NOT NULL
          AND {prefix}_sold_date_sk IS NOT NULL AND {site} IS NOT NULL
          AND {prefix}_quantity * {prefix}_sales_price > 0 AND {customer} IS NOT NULL"""


def _calendar(name: str, week_day: str, year_day: str) -> str:
    return f"""
        SELECT d_date_sk AS date_sk, d_date AS date, d_year AS year, d_moy AS month, d_dom AS day,
               d_day_name AS day_name, d_qoy AS quarter, d_quarter_name AS quarter_name,
               {_padded_week(week_day)} AS week_of_year,
               CAST(year({year_day}) AS VARCHAR) || {_padded_week(week_day)} AS yr_wk_num,
               {_sunday('d_date')} AS week_start_date, {_sunday('d_date')} + 6 AS week_end_date
        FROM {name}"""


def _rate(part: str, whole: str) -> str:
    """Percentage, rounded half up on the decimal text of the double.

    A shorter decimal in between would turn 40.62499999999999 into a tie.
    """
    share = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"
    exact = f"CAST(CAST({share} AS VARCHAR) AS DECIMAL(38,17))"
    return f"CASE WHEN {whole} > 0 THEN CAST(round({exact}, 2) AS DOUBLE) ELSE 0 END"


def _filler(kind: str, name: str, position: int, key: str) -> str:
    """Value of a dimension column without a formula of its own: see FIXTURES.md, part C."""
    value = {
        "string": f"'{name} ' || CAST({key} % {position + 3} AS VARCHAR)",
        "double": f"CAST({key} * {position + 1} % 97 AS DOUBLE)",
        "int": f"CAST({key} * {position + 1} % 89 AS INTEGER)",
        "date": f"DATE '1995-01-01' + CAST({key} * {position + 1} % 1000 AS INTEGER)",
        "key": f"CAST(2450400 + {key} * {position + 1} % 2000 AS BIGINT)",
    }[kind]
    return f"CASE WHEN {key} % 31 <> {position} THEN {value} END"


def _dimension(table: str, key: str, source: str, **formulas: str) -> str:
    """All columns of a raw dimension: by formula, or filled from the row's key."""
    columns = []
    for position, field in enumerate(RAW_SCHEMAS[table].fields):
        kind = "key" if is_key(field.name) else field.dataType.simpleString()
        value = formulas.get(field.name) or _filler(kind, field.name, position, f"CAST({key} AS BIGINT)")
        columns.append(f"CAST({value} AS BIGINT) AS {field.name}" if kind == "key" else f"{value} AS {field.name}")
    return f"SELECT {', '.join(columns)} FROM {source}"


_MIDWEEK = f"{_sunday('d_date')} + 4"

# Named sub-queries; each statement pulls in the ones it mentions.
_PARTS: dict[str, str] = {
    "base": """
        SELECT l.*, o_custkey, p_retailprice, CAST(l_shipdate AS DATE) AS d,
               unnest(range(0, 1 + l_orderkey % 2)) AS copy,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS ext
        FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "cs": _sales("cs", 1),
    "ws": _sales("ws", 2),
    "ss": _sales("ss", 0),
    "cr": _returns("cr", "cr_return_amount", 1),
    "wr": _returns("wr", "wr_return_amt", 2),
    "sr": _returns("sr", "sr_return_amt", 0),
    "every_day": """
        SELECT CAST(unnest(range(DATE '1995-01-01', (SELECT max(d) + 1 FROM base), INTERVAL 1 DAY)) AS DATE)
               AS d_date""",
    "days": f"SELECT d_date FROM every_day WHERE {_key('d_date')} % 97 <> 0",
    "date_raw": f"""
        SELECT {_key('d_date')} AS d_date_sk, d_date, CAST(year(d_date) AS INTEGER) AS d_year,
               CAST(month(d_date) AS INTEGER) AS d_moy, CAST(day(d_date) AS INTEGER) AS d_dom,
               CAST(quarter(d_date) AS INTEGER) AS d_qoy,
               CASE dayofweek(d_date) WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
                    WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday'
                    ELSE 'Saturday' END AS d_day_name,
               CAST(year(d_date) AS VARCHAR) || 'Q' || CAST(quarter(d_date) AS VARCHAR) AS d_quarter_name
        FROM days""",
    "cal": _calendar("date_raw", "d_date - 1", "d_date"),
    "cal_sunday": _calendar("date_raw", _MIDWEEK, _MIDWEEK),
    "inv": f"""
        SELECT {_key('w + weekday')} AS inv_date_sk, p AS inv_item_sk, s AS inv_warehouse_sk,
               CASE WHEN (p * 7 + s * 13) % 17 = 0 THEN NULL
                    ELSE CAST((p * 7 + s * 13 + {_key('w')} + weekday) % 60 AS DECIMAL(10,0)) END
                    AS inv_quantity_on_hand
        FROM (SELECT *, unnest(CASE WHEN (p + s) % 2 = 0 THEN [4, 2] ELSE [4] END) AS weekday
              FROM (SELECT DISTINCT l_partkey AS p, l_suppkey AS s, {_sunday('d')} AS w FROM base))""",
    "combined": _stock_and_sales_lines("cs") + " UNION ALL " + _stock_and_sales_lines("ws"),
    "daily": """
        SELECT warehouse_sk, item_sk, sold_date_sk, sum(daily_qty) AS daily_qty,
               sum(daily_sales_amt) AS daily_sales_amt, sum(daily_net_profit) AS daily_net_profit
        FROM combined GROUP BY ALL""",
    "daily_dated": """
        SELECT daily.*, date, week_start_date, week_end_date, yr_wk_num
        FROM daily JOIN cal ON sold_date_sk = date_sk""",
    "inv_dated": """
        SELECT inv_date_sk AS date_sk, inv_item_sk AS item_sk, inv_warehouse_sk AS warehouse_sk,
               inv_quantity_on_hand AS quantity_on_hand, date, yr_wk_num
        FROM inv JOIN cal ON inv_date_sk = cal.date_sk""",
    "weekly": """
        SELECT yr_wk_num, warehouse_sk, item_sk, week_start_date, week_end_date,
               sum(daily_qty) AS sum_qty_wk, sum(daily_sales_amt) AS sum_amt_wk,
               sum(daily_net_profit) AS sum_profit_wk, coalesce(sum(quantity_on_hand), 0) AS inv_on_hand_qty_wk
        FROM daily_dated JOIN inv_dated USING (yr_wk_num, warehouse_sk, item_sk) GROUP BY ALL""",
    "weekly_once": """
        SELECT * FROM (
            SELECT yr_wk_num, warehouse_sk, item_sk, week_start_date, week_end_date,
                   sum(daily_qty) AS sum_qty_wk, sum(daily_sales_amt) AS sum_amt_wk,
                   sum(daily_net_profit) AS sum_profit_wk
            FROM daily_dated GROUP BY ALL)
        JOIN (SELECT yr_wk_num, warehouse_sk, item_sk, coalesce(sum(quantity_on_hand), 0) AS inv_on_hand_qty_wk
              FROM inv_dated GROUP BY ALL) USING (yr_wk_num, warehouse_sk, item_sk)""",
    "item_weekly": """
        SELECT yr_wk_num, item_sk, week_start_date, week_end_date, sum(sum_qty_wk) AS sum_qty_wk,
               sum(sum_amt_wk) AS sum_amt_wk, sum(sum_profit_wk) AS sum_profit_wk
        FROM weekly GROUP BY ALL""",
    "returned": """
        SELECT cr_returned_date_sk AS returned_date_sk, cr_item_sk AS item_sk, cr_return_quantity AS return_qty,
               cr_return_amount AS return_amt, cr_net_loss AS return_loss
        FROM cr WHERE cr_returned_date_sk IS NOT NULL AND cr_item_sk IS NOT NULL
          AND cr_return_quantity > 0 AND cr_return_amount > 0
        UNION ALL
        SELECT wr_returned_date_sk, wr_item_sk, wr_return_quantity, wr_return_amt, wr_net_loss
        FROM wr WHERE wr_returned_date_sk IS NOT NULL AND wr_item_sk IS NOT NULL
          AND wr_return_quantity > 0 AND wr_return_amt > 0""",
    "returned_weekly": """
        SELECT yr_wk_num, item_sk, week_start_date, week_end_date, sum(return_qty) AS sum_return_qty_wk,
               sum(return_amt) AS sum_return_amt_wk, sum(return_loss) AS sum_return_loss_wk
        FROM returned LEFT JOIN cal ON returned_date_sk = date_sk GROUP BY ALL""",
    "against_sales": """
        SELECT s.yr_wk_num, s.item_sk, s.week_start_date, s.week_end_date, r.sum_return_qty_wk,
               r.sum_return_amt_wk, r.sum_return_loss_wk, s.sum_amt_wk AS sum_sales_amt_wk,
               s.sum_qty_wk AS sum_sales_qty_wk
        FROM item_weekly s LEFT JOIN returned_weekly r
          ON s.yr_wk_num = r.yr_wk_num AND s.item_sk = r.item_sk""",
    "all_lines": " UNION ALL ".join(
        [
            _channel_lines(
                "cs", "Catalog", "cs_bill_customer_sk", "cs_warehouse_sk", "cs_order_number", "cs_promo_sk"
            ),
            _channel_lines("ws", "Web", "ws_bill_customer_sk", "ws_warehouse_sk", "ws_order_number", "ws_promo_sk"),
            _channel_lines("ss", "Store", "ss_customer_sk", "ss_store_sk", "ss_ticket_number", "CAST(NULL AS BIGINT)"),
        ]
    ),
    "sold": """
        SELECT customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, date AS sold_date, year AS sold_yr_num,
               month AS sold_mnth_num, week_of_year AS sold_wk_num, daily_qty, daily_sales_amt,
               daily_net_profit, daily_cogs, order_number
        FROM all_lines LEFT JOIN cal ON sold_date_sk = date_sk""",
    "newest": "SELECT max(sold_date) AS max_sold_date FROM sold",
    "rfm": """
        SELECT customer_sk, max(sold_date) AS recent_purchase, count(DISTINCT order_number) AS frequency,
               sum(daily_sales_amt) AS monetary
        FROM sold GROUP BY customer_sk""",
    "banded": """
        SELECT *,
               CASE WHEN recent_purchase >= (SELECT max_sold_date FROM newest) - 30 THEN 'Active'
                    WHEN recent_purchase >= (SELECT max_sold_date FROM newest) - 100 THEN 'Lapsing'
                    ELSE 'Inactive' END AS recency_segment,
               CASE WHEN frequency > 11 THEN 'High Frequency' WHEN frequency BETWEEN 8 AND 11
                    THEN 'Medium Frequency' ELSE 'Low Frequency' END AS frequency_segment,
               CASE WHEN monetary > 1000000 THEN 'High Value' WHEN monetary BETWEEN 600000 AND 1000000
                    THEN 'Medium Value' ELSE 'Low Value' END AS monetary_segment
        FROM rfm""",
    "segmented": """
        SELECT *,
               CASE WHEN recency_segment = 'Active' AND monetary_segment = 'High Value'
                         AND frequency_segment IN ('High Frequency', 'Medium Frequency') THEN 'Champions'
                    WHEN recency_segment = 'Lapsing' AND frequency_segment = 'High Frequency'
                         AND monetary_segment = 'High Value' THEN 'Potential Loyalists'
                    WHEN recency_segment = 'Lapsing' AND frequency_segment = 'Medium Frequency'
                         AND monetary_segment <> 'Low Value' THEN 'Hibernating'
                    WHEN recency_segment = 'Active' AND frequency_segment = 'Low Frequency' THEN 'New User'
                    ELSE 'At Risk' END AS customer_segment
        FROM banded""",
    "cohorts": """
        SELECT customer_sk, min(sold_date) AS first_purchase_date, max(sold_date) AS last_purchase_date
        FROM sold GROUP BY customer_sk""",
    "churn": """
        SELECT CAST(year(first_purchase_date) AS INTEGER) AS cohort_year, count(*) AS total_customers,
               CAST(sum(CASE WHEN last_purchase_date < (SELECT max_sold_date FROM newest) - 300 THEN 1 ELSE 0 END)
                    AS BIGINT) AS churned_customers
        FROM cohorts GROUP BY 1
        HAVING cohort_year < (SELECT year(max_sold_date) FROM newest)""",
    "lifespan": """
        SELECT list_reduce(list(total_customers / CASE WHEN churned_customers = 0 THEN 1 ELSE churned_customers END
                                ORDER BY cohort_year), lambda total, one: total + one) / count(*)
               AS avg_estimated_lifespan
        FROM churn""",
    "summary": """
        SELECT customer_sk, sum(daily_sales_amt)::DOUBLE AS total_sales,
               sum(daily_net_profit)::DOUBLE AS total_profit, count(DISTINCT order_number) AS total_orders,
               sum(daily_sales_amt)::DOUBLE / count(daily_sales_amt) AS avg_order_value,
               sum(daily_net_profit)::DOUBLE / count(daily_net_profit) AS avg_profit_per_order
        FROM sold GROUP BY customer_sk""",
    "segments": """
        SELECT DISTINCT c_mktsegment AS segment,
               CAST(ascii(c_mktsegment) * 256 + ascii(substr(c_mktsegment, 2, 1)) AS BIGINT) AS cd_demo_sk
        FROM customer""",
    "item_raw": _dimension(
        "item",
        "p_partkey",
        "part",
        i_item_sk="p_partkey",
        i_item_id="'I' || CAST(p_partkey AS VARCHAR)",
        i_product_name="p_name",
        i_brand="p_brand",
        i_class="p_type",
        i_size="CAST(p_size AS VARCHAR)",
        i_current_price="p_retailprice",
        i_item_desc="""'  ' || p_name || chr(10) || '"quoted", ' || chr(92) || 'n ' || p_partkey || chr(13) || ' '""",
        i_formulation="CASE WHEN p_partkey % 2 = 0 THEN '' END",
    ),
    "warehouse_raw": _dimension(
        "warehouse",
        "s_suppkey",
        "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
        w_warehouse_sk="s_suppkey",
        w_warehouse_name="s_name",
        w_city="n_name",
        w_country="r_name",
    ),
    "customer_raw": _dimension(
        "customer",
        "c_custkey",
        "customer JOIN segments ON c_mktsegment = segment",
        c_customer_sk="c_custkey",
        c_customer_id="c_name",
        c_current_addr_sk="c_nationkey",
        c_current_cdemo_sk="cd_demo_sk",
        c_current_hdemo_sk="c_custkey % 20",
    ),
    "address_raw": _dimension(
        "customer_address",
        "n_nationkey",
        "nation JOIN region ON n_regionkey = r_regionkey",
        ca_address_sk="n_nationkey",
        ca_city="n_name",
        ca_country="r_name",
    ),
    "demographics_raw": _dimension(
        "customer_demographics", "cd_demo_sk", "segments", cd_demo_sk="cd_demo_sk", cd_credit_rating="segment"
    ),
    "household_raw": _dimension(
        "household_demographics",
        "id",
        "(SELECT unnest(range(20)) AS id)",
        hd_demo_sk="id",
        hd_income_band_sk="CASE WHEN id <> 13 THEN id % 5 END",
        hd_dep_count="CAST(id % 7 AS INTEGER)",
        hd_vehicle_count="CAST(id % 4 AS INTEGER)",
    ),
    "band_raw": """
        SELECT id AS ib_income_band_sk, CAST(id * 10000 AS INTEGER) AS ib_lower_bound,
               CAST(id * 10000 + 9999 AS INTEGER) AS ib_upper_bound
        FROM (SELECT unnest(range(5)) AS id)""",
    "customer_sides": """
        SELECT c_customer_sk AS customer_sk, c_customer_id AS customer_id, c_salutation AS salutation,
               c_first_name AS first_name, c_last_name AS last_name, c_preferred_cust_flag AS preferred_cust_flag,
               c_birth_day AS birth_day, c_birth_month AS birth_month, c_birth_year AS birth_year,
               c_login AS login, c_email_address AS email_address, ca_street_number AS street_number,
               ca_street_name AS street_name, ca_street_type AS street_type, ca_suite_number AS suite_number,
               ca_city AS city, ca_county AS county, ca_state AS state, ca_zip AS zip, ca_country AS country,
               ca_gmt_offset AS gmt_offset, ca_location_type AS location_type, cd_gender AS gender,
               cd_marital_status AS marital_status, cd_education_status AS education_status,
               cd_purchase_estimate AS purchase_estimate, cd_credit_rating AS credit_rating,
               cd_dep_count AS customer_dep_count, cd_dep_employed_count AS dep_employed_count,
               cd_dep_college_count AS dep_college_count, hd_buy_potential AS buy_potential,
               hd_dep_count AS household_dep_count, hd_vehicle_count AS vehicle_count,
               ib_lower_bound AS income_lower_bound, ib_upper_bound AS income_upper_bound
        FROM customer_raw
        JOIN address_raw ON c_current_addr_sk = ca_address_sk
        JOIN demographics_raw ON c_current_cdemo_sk = cd_demo_sk
        JOIN household_raw ON c_current_hdemo_sk = hd_demo_sk
        JOIN band_raw ON hd_income_band_sk = ib_income_band_sk""",
    "recency": """
        SELECT date_diff('day', last_purchase_date, (SELECT max_sold_date FROM newest)) AS days
        FROM cohorts WHERE last_purchase_date IS NOT NULL""",
    "recency_ranked": "SELECT days, row_number() OVER (ORDER BY days) AS r, count(*) OVER () AS n FROM recency",
}


def _raw_columns(table: str, mapped: set[str]) -> str:
    """All columns of a raw table: mapped ones by name with decimals as doubles, others null."""
    out = []
    for field in RAW_SCHEMAS[table].fields:
        kind = "BIGINT" if is_key(field.name) else _SQL_TYPE[field.dataType.simpleString()]
        value = field.name if field.name in mapped else "NULL"
        out.append(f"CAST({value} AS {kind}) AS {field.name}")
    return ", ".join(out)


def _doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_ITEM = """
    SELECT i_item_sk AS item_sk, i_item_id AS item_id, i_rec_start_date AS rec_start_date,
           i_rec_end_date AS rec_end_date, i_item_desc AS item_desc, i_current_price AS current_price,
           i_wholesale_cost AS wholesale_cost, i_brand_id AS brand_id, i_brand AS brand, i_class_id AS class_id,
           i_class AS class, i_category_id AS category_id, i_category AS category, i_manufact_id AS manufact_id,
           i_manufact AS manufact, i_size AS size, i_formulation AS formulation, i_color AS color,
           i_units AS units, i_container AS container, i_manager_id AS manager_id,
           i_product_name AS product_name
    FROM item_raw"""
_AS_OF_KEY = f"(SELECT {_key('d_date')} FROM days WHERE d_date = DATE '1999-06-30')"


def _known(prefix: str) -> str:
    return (
        f"({prefix}_sold_date_sk IS NOT NULL AND {prefix}_sold_date_sk <= {_AS_OF_KEY}) "
        f"AND ({prefix}_ship_date_sk IS NULL OR {prefix}_ship_date_sk <= {_AS_OF_KEY})"
    )


def _returned(prefix: str) -> str:
    return f"{prefix}_returned_date_sk <= {_AS_OF_KEY}"


def _or_null(*columns: str) -> str:
    return " AND ".join(f"({c} IS NULL OR {c} <= {_AS_OF_KEY})" for c in columns)


# Source and as-of condition of every raw table.
_EXTRACTED = {
    "catalog_returns": ("cr", _returned("cr")),
    "catalog_sales": ("cs", _known("cs")),
    "customer": ("customer_raw", _or_null("c_first_shipto_date_sk", "c_first_sales_date_sk")),
    "customer_address": ("address_raw", "true"),
    "customer_demographics": ("demographics_raw", "true"),
    "date_dim": ("days", "d_date BETWEEN DATE '1990-01-01' AND DATE '2030-01-01'"),
    "household_demographics": ("household_raw", "true"),
    "income_band": ("band_raw", "true"),
    "inventory": ("inv", _or_null("inv_date_sk")),
    "item": ("item_raw", "true"),
    "store_returns": ("sr", _returned("sr")),
    "store_sales": ("ss", f"ss_sold_date_sk <= {_AS_OF_KEY}"),
    "warehouse": ("warehouse_raw", "true"),
    "web_returns": ("wr", _returned("wr")),
    "web_sales": ("ws", _known("ws")),
}
# Tables with a day key, and the one that is summed up as a check.
_DAY_KEYS = {
    "catalog_returns": "cr_returned_date_sk",
    "catalog_sales": "cs_sold_date_sk",
    "customer": "c_first_sales_date_sk",
    "inventory": "inv_date_sk",
    "store_returns": "sr_returned_date_sk",
    "store_sales": "ss_sold_date_sk",
    "web_returns": "wr_returned_date_sk",
    "web_sales": "ws_sold_date_sk",
}


def _weekly(source: str) -> str:
    return f"""
        SELECT yr_wk_num, warehouse_sk, item_sk, week_start_date, week_end_date,
               {_doubles('sum_qty_wk', 'sum_amt_wk', 'sum_profit_wk', 'inv_on_hand_qty_wk')},
               CAST(sum_qty_wk AS DOUBLE) / 7 AS avg_qty_dy,
               CASE WHEN sum_qty_wk > 0 THEN CAST(inv_on_hand_qty_wk AS DOUBLE) / CAST(sum_qty_wk AS DOUBLE) END
                   AS wks_sply,
               CAST(sum_qty_wk AS DOUBLE) / 7 > 0
                   AND CAST(sum_qty_wk AS DOUBLE) / 7 > CAST(inv_on_hand_qty_wk AS DOUBLE) AS low_stock_flg_wk
        FROM {source}"""


_CATALOG_MAPPED = {
    "cs_sold_date_sk",
    "cs_ship_date_sk",
    "cs_item_sk",
    "cs_warehouse_sk",
    "cs_bill_customer_sk",
    "cs_order_number",
    "cs_promo_sk",
    "cs_quantity",
    "cs_sales_price",
    "cs_ext_wholesale_cost",
    "cs_net_profit",
}
_DAY = "sold_date, sold_yr_num, sold_mnth_num, sold_wk_num"
_MEASURES = ("daily_qty", "daily_sales_amt", "daily_net_profit", "daily_cogs")

_STATEMENTS: dict[str, str] = {
    "csv_roundtrip": f"SELECT {_raw_columns('catalog_sales', _CATALOG_MAPPED)} FROM cs",
    "parquet_roundtrip": _ITEM,
    "published_sql": """
        SELECT quarter_name, channel_key, CAST(sum(lines) AS BIGINT) AS order_lines,
               CAST(sum(qty) AS DOUBLE) AS qty
        FROM (SELECT sold_date_sk, channel_key, count(order_number) AS lines, sum(daily_qty) AS qty
              FROM sold GROUP BY ALL) JOIN cal ON sold_date_sk = date_sk
        GROUP BY quarter_name, channel_key""",
    "csv_rejects": " UNION ALL ".join(
        f"""SELECT 'item' AS table_name, '{column}' AS "column", '{text}' || i_item_sk AS cell, '{reason}' AS reason,
                   CASE WHEN i_item_sk % 17 = 0 THEN 'K' ELSE '' END || i_item_sk AS record_key
            FROM item_raw WHERE i_item_sk % {every} = 0"""
        for column, every, text, reason in (
            ("i_current_price", 7, "n/a ", "type"),
            ("i_brand_id", 11, "12x", "type"),
            ("i_rec_start_date", 13, "soon, ", "type"),
            ("i_item_sk", 17, "K", "key"),
        )
    ),
    "as_of_history": """
        SELECT DATE '1999-01-15' AS as_of, i_item_sk, i_current_price, i_item_desc, i_formulation, i_rec_start_date
        FROM item_raw WHERE i_item_sk % 5 <> 1
        UNION ALL
        SELECT DATE '1999-02-01', i_item_sk, CASE WHEN i_item_sk % 7 = 0 THEN i_current_price + 1 ELSE i_current_price END,
               i_item_desc, i_formulation, i_rec_start_date
        FROM item_raw
        UNION ALL
        SELECT DATE '1999-03-31', i_item_sk, CASE WHEN i_item_sk % 7 = 0 THEN i_current_price + 1 ELSE i_current_price END,
               i_item_desc, i_formulation, i_rec_start_date
        FROM item_raw CROSS JOIN range(2) copies(n) WHERE i_item_sk % 9 <> 0 AND (n = 0 OR i_item_sk % 10 = 0)""",
    "snapshot_verified": """
        SELECT 'item' AS table_name, count(*) AS row_count, CAST(0 AS BIGINT) AS files_lost FROM item_raw
        UNION ALL SELECT 'catalog_sales', count(*), CAST(0 AS BIGINT) FROM cs""",
    "published_version": """
        SELECT channel_key, sold_yr_num, CAST(count(order_number) AS BIGINT) AS order_lines,
               CAST(sum(daily_qty) AS DOUBLE) AS qty
        FROM sold GROUP BY channel_key, sold_yr_num""",
    "as_of_key": "SELECT d_date_sk FROM date_raw WHERE d_date = DATE '1999-06-30'",
    "as_of_filter": f"""
        SELECT cs_sold_date_sk, cs_ship_date_sk, cs_bill_customer_sk, cs_warehouse_sk, cs_item_sk, cs_promo_sk,
               cs_order_number, {_doubles('cs_quantity', 'cs_net_profit')}
        FROM cs WHERE {_known('cs')}""",
    "calendar_range": """
        SELECT d_date_sk, d_date, d_year, d_moy, d_dom, d_qoy, d_day_name, d_quarter_name
        FROM date_raw WHERE d_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    "full_extract": "SELECT * FROM item_raw",
    "csv_roundtrip_text": "SELECT * FROM item_raw",
    "extract_snapshot": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, 'exported' AS status FROM {source} WHERE {kept}"
        for table, (source, kept) in _EXTRACTED.items()
    ),
    "as_of_filter_all": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, CAST(sum({key}) AS BIGINT) AS day_keys "
        f"FROM {_EXTRACTED[table][0]} WHERE {_EXTRACTED[table][1]}"
        for table, key in _DAY_KEYS.items()
    ),
    "dim_date": "SELECT * FROM cal",
    "dim_date_sunday": "SELECT * FROM cal_sunday",
    "dim_item": _ITEM,
    "dim_warehouse": """
        SELECT w_warehouse_sk AS warehouse_sk, w_warehouse_id AS warehouse_id, w_warehouse_name AS warehouse_name,
               w_warehouse_sq_ft AS warehouse_sq_ft, w_street_number AS street_number,
               w_street_name AS street_name, w_street_type AS street_type, w_suite_number AS suite_number,
               w_city AS city, w_county AS county, w_state AS state, w_zip AS zip, w_country AS country,
               w_gmt_offset AS gmt_offset
        FROM warehouse_raw""",
    "dim_customer": "SELECT * FROM customer_sides",
    "combined_daily_sales": f"""
        SELECT warehouse_sk, item_sk, sold_date_sk, {_doubles(*_MEASURES[:3])} FROM combined""",
    "daily_sales_dated": f"""
        SELECT warehouse_sk, item_sk, sold_date_sk, {_doubles(*_MEASURES[:3])}, date, week_start_date,
               week_end_date, yr_wk_num
        FROM daily_dated""",
    "inventory_with_date": f"""
        SELECT date_sk, item_sk, warehouse_sk, {_doubles('quantity_on_hand')}, date, yr_wk_num FROM inv_dated""",
    "fact_sales_inv_weekly": _weekly("weekly"),
    "fact_sales_inv_weekly_preagg": _weekly("weekly_once"),
    "fact_sales_inv_weekly_bucketed": _weekly("weekly"),
    "fact_sales_inv_weekly_clustered": _weekly("weekly"),
    "sales_item_weekly": f"""
        SELECT yr_wk_num, item_sk, week_start_date, week_end_date,
               {_doubles('sum_qty_wk', 'sum_amt_wk', 'sum_profit_wk')}
        FROM item_weekly""",
    "combined_returns": f"""
        SELECT returned_date_sk, item_sk, {_doubles('return_qty', 'return_amt', 'return_loss')} FROM returned""",
    "returns_weekly": f"""
        SELECT yr_wk_num, item_sk, week_start_date, week_end_date,
               {_doubles('sum_return_qty_wk', 'sum_return_amt_wk', 'sum_return_loss_wk')}
        FROM returned_weekly""",
    "fact_returns_with_sales": f"""
        SELECT *, CASE WHEN return_rate_amt > 25 THEN true ELSE false END AS high_return_flag_wk
        FROM (SELECT yr_wk_num, item_sk, week_start_date, week_end_date,
                     {_doubles('sum_return_qty_wk', 'sum_return_amt_wk', 'sum_return_loss_wk',
                               'sum_sales_amt_wk', 'sum_sales_qty_wk')},
                     CAST(sum_return_qty_wk AS DOUBLE) / 7 AS avg_return_qty_dy,
                     {_rate('sum_return_amt_wk', 'sum_sales_amt_wk')} AS return_rate_amt,
                     {_rate('sum_return_qty_wk', 'sum_sales_qty_wk')} AS return_rate_qty
              FROM against_sales)""",
    "incremental_sales": f"""
        SELECT customer_sk, item_sk, promo_sk, order_number, channel_key, sold_date_sk, {_doubles(*_MEASURES)}
        FROM all_lines""",
    "sales_with_date": f"""
        SELECT customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, {_DAY}, {_doubles(*_MEASURES)},
               order_number
        FROM sold""",
    "fact_sales_daily": f"""
        SELECT customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, {_DAY},
               {', '.join(f'CAST(sum({m}) AS DOUBLE) AS {m}' for m in _MEASURES)},
               count(order_number) AS daily_orders
        FROM sold GROUP BY customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, {_DAY}""",
    "fact_sales_daily_refreshed": f"""
        SELECT customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, {_DAY},
               {', '.join(f'CAST(sum({m}) AS DOUBLE) AS {m}' for m in _MEASURES)},
               count(order_number) AS daily_orders
        FROM sold GROUP BY customer_sk, item_sk, promo_sk, channel_key, sold_date_sk, {_DAY}""",
    "max_sold_date": "SELECT max_sold_date FROM newest",
    "customer_rfm": f"SELECT customer_sk, recent_purchase, frequency, {_doubles('monetary')} FROM rfm",
    "customer_rfm_merged": f"SELECT customer_sk, recent_purchase, frequency, {_doubles('monetary')} FROM rfm",
    "rfm_segments": f"""
        SELECT customer_sk, recent_purchase, frequency, {_doubles('monetary')}, recency_segment,
               frequency_segment, monetary_segment, customer_segment
        FROM segmented""",
    "customer_cohorts": "SELECT * FROM cohorts",
    "churn_by_cohort": "SELECT * FROM churn",
    "avg_lifespan": "SELECT * FROM lifespan",
    "customer_summary": "SELECT * FROM summary",
    "customer_clv": """
        SELECT summary.*, avg_estimated_lifespan AS estimated_lifespan,
               avg_profit_per_order * total_orders * avg_estimated_lifespan AS "CLV"
        FROM summary CROSS JOIN lifespan""",
    "dim_customer_marketing": """
        SELECT customer_sides.*, recency_segment, frequency_segment, monetary_segment, customer_segment
        FROM customer_sides JOIN segmented USING (customer_sk)""",
    "recency_quantiles": """
        SELECT CAST(p AS DOUBLE) AS probability, CAST(min(days) AS INTEGER) AS days_since_last_purchase
        FROM recency_ranked, (SELECT unnest([0.25, 0.5, 0.75]) AS p)
        WHERE r >= p * n GROUP BY p""",
}


def _with_parts(statement: str) -> str:
    """Put the named sub-queries a statement mentions, directly or not, in front of it."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                visit(_PARTS[name])
                needed[name] = None

    visit(statement)
    parts = ", ".join(f"{name} AS ({_PARTS[name]})" for name in needed)
    return f"WITH {parts} {statement}" if parts else statement


def oracle_sql() -> dict[str, str]:
    return {name: _with_parts(sql) for name, sql in _STATEMENTS.items()}

"""Column layout of the 15 raw retail tables.

The raw files bind by position, so order matters. Facts arrive with every
number as a double (nullable integer keys are dumped as ``1.0``); the readers
turn keys into longs once, on load.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}

# Column names, order and types of the raw retail star schema.
_LAYOUTS = {
    "catalog_returns": """
        cr_returned_date_sk double
        cr_returned_time_sk double
        cr_item_sk double
        cr_refunded_customer_sk double
        cr_refunded_cdemo_sk double
        cr_refunded_hdemo_sk double
        cr_refunded_addr_sk double
        cr_returning_customer_sk double
        cr_returning_cdemo_sk double
        cr_returning_hdemo_sk double
        cr_returning_addr_sk double
        cr_call_center_sk double
        cr_catalog_page_sk double
        cr_ship_mode_sk double
        cr_warehouse_sk double
        cr_reason_sk double
        cr_order_number double
        cr_return_quantity double
        cr_return_amount double
        cr_return_tax double
        cr_return_amt_inc_tax double
        cr_fee double
        cr_return_ship_cost double
        cr_refunded_cash double
        cr_reversed_charge double
        cr_store_credit double
        cr_net_loss double
    """,
    "catalog_sales": """
        cs_sold_date_sk double
        cs_sold_time_sk double
        cs_ship_date_sk double
        cs_bill_customer_sk double
        cs_bill_cdemo_sk double
        cs_bill_hdemo_sk double
        cs_bill_addr_sk double
        cs_ship_customer_sk double
        cs_ship_cdemo_sk double
        cs_ship_hdemo_sk double
        cs_ship_addr_sk double
        cs_call_center_sk double
        cs_catalog_page_sk double
        cs_ship_mode_sk double
        cs_warehouse_sk double
        cs_item_sk double
        cs_promo_sk double
        cs_order_number int
        cs_quantity double
        cs_wholesale_cost double
        cs_list_price double
        cs_sales_price double
        cs_ext_discount_amt double
        cs_ext_sales_price double
        cs_ext_wholesale_cost double
        cs_ext_list_price double
        cs_ext_tax double
        cs_coupon_amt double
        cs_ext_ship_cost double
        cs_net_paid double
        cs_net_paid_inc_tax double
        cs_net_paid_inc_ship double
        cs_net_paid_inc_ship_tax double
        cs_net_profit double
    """,
    "customer_address": """
        ca_address_sk int
        ca_address_id string
        ca_street_number string
        ca_street_name string
        ca_street_type string
        ca_suite_number string
        ca_city string
        ca_county string
        ca_state string
        ca_zip string
        ca_country string
        ca_gmt_offset double
        ca_location_type string
    """,
    "customer": """
        c_customer_sk int
        c_customer_id string
        c_current_cdemo_sk double
        c_current_hdemo_sk double
        c_current_addr_sk double
        c_first_shipto_date_sk double
        c_first_sales_date_sk double
        c_salutation string
        c_first_name string
        c_last_name string
        c_preferred_cust_flag string
        c_birth_day string
        c_birth_month string
        c_birth_year string
        c_birth_country string
        c_login string
        c_email_address string
        c_last_review_date string
    """,
    "customer_demographics": """
        cd_demo_sk int
        cd_gender string
        cd_marital_status string
        cd_education_status string
        cd_purchase_estimate double
        cd_credit_rating string
        cd_dep_count double
        cd_dep_employed_count double
        cd_dep_college_count double
    """,
    "date_dim": """
        d_date_sk int
        d_date_id string
        d_date date
        d_month_seq int
        d_week_seq int
        d_quarter_seq int
        d_year int
        d_dow int
        d_moy int
        d_dom int
        d_qoy int
        d_fy_year int
        d_fy_quarter_seq int
        d_fy_week_seq int
        d_day_name string
        d_quarter_name string
        d_holiday string
        d_weekend string
        d_following_holiday string
        d_first_dom int
        d_last_dom int
        d_same_day_ly int
        d_same_day_lq int
        d_current_day string
        d_current_week string
        d_current_month string
        d_current_quarter string
        d_current_year string
    """,
    "household_demographics": """
        hd_demo_sk int
        hd_income_band_sk double
        hd_buy_potential string
        hd_dep_count int
        hd_vehicle_count int
    """,
    "income_band": """
        ib_income_band_sk int
        ib_lower_bound int
        ib_upper_bound int
    """,
    "inventory": """
        inv_date_sk int
        inv_item_sk int
        inv_warehouse_sk int
        inv_quantity_on_hand double
    """,
    "item": """
        i_item_sk int
        i_item_id string
        i_rec_start_date date
        i_rec_end_date date
        i_item_desc string
        i_current_price double
        i_wholesale_cost double
        i_brand_id double
        i_brand string
        i_class_id double
        i_class string
        i_category_id double
        i_category string
        i_manufact_id double
        i_manufact string
        i_size string
        i_formulation string
        i_color string
        i_units string
        i_container string
        i_manager_id double
        i_product_name string
    """,
    "store_returns": """
        sr_returned_date_sk double
        sr_return_time_sk double
        sr_item_sk double
        sr_customer_sk double
        sr_cdemo_sk double
        sr_hdemo_sk double
        sr_addr_sk double
        sr_store_sk double
        sr_reason_sk double
        sr_ticket_number double
        sr_return_quantity double
        sr_return_amt double
        sr_return_tax double
        sr_return_amt_inc_tax double
        sr_fee double
        sr_return_ship_cost double
        sr_refunded_cash double
        sr_reversed_charge double
        sr_store_credit double
        sr_net_loss double
    """,
    "store_sales": """
        ss_sold_date_sk double
        ss_sold_time_sk double
        ss_item_sk double
        ss_customer_sk double
        ss_cdemo_sk double
        ss_hdemo_sk double
        ss_addr_sk double
        ss_store_sk double
        ss_promo_sk double
        ss_ticket_number double
        ss_quantity double
        ss_wholesale_cost double
        ss_list_price double
        ss_sales_price double
        ss_ext_discount_amt double
        ss_ext_sales_price double
        ss_ext_wholesale_cost double
        ss_ext_list_price double
        ss_ext_tax double
        ss_coupon_amt double
        ss_net_paid double
        ss_net_paid_inc_tax double
        ss_net_profit double
    """,
    "warehouse": """
        w_warehouse_sk int
        w_warehouse_id string
        w_warehouse_name string
        w_warehouse_sq_ft double
        w_street_number string
        w_street_name string
        w_street_type string
        w_suite_number string
        w_city string
        w_county string
        w_state string
        w_zip double
        w_country string
        w_gmt_offset double
    """,
    "web_returns": """
        wr_returned_date_sk double
        wr_returned_time_sk double
        wr_item_sk double
        wr_refunded_customer_sk double
        wr_refunded_cdemo_sk double
        wr_refunded_hdemo_sk double
        wr_refunded_addr_sk double
        wr_returning_customer_sk double
        wr_returning_cdemo_sk double
        wr_returning_hdemo_sk double
        wr_returning_addr_sk double
        wr_web_page_sk double
        wr_reason_sk double
        wr_order_number double
        wr_return_quantity double
        wr_return_amt double
        wr_return_tax double
        wr_return_amt_inc_tax double
        wr_fee double
        wr_return_ship_cost double
        wr_refunded_cash double
        wr_reversed_charge double
        wr_account_credit double
        wr_net_loss double
    """,
    "web_sales": """
        ws_sold_date_sk double
        ws_sold_time_sk double
        ws_ship_date_sk double
        ws_item_sk double
        ws_bill_customer_sk double
        ws_bill_cdemo_sk double
        ws_bill_hdemo_sk double
        ws_bill_addr_sk double
        ws_ship_customer_sk double
        ws_ship_cdemo_sk double
        ws_ship_hdemo_sk double
        ws_ship_addr_sk double
        ws_web_page_sk double
        ws_web_site_sk double
        ws_ship_mode_sk double
        ws_warehouse_sk double
        ws_promo_sk double
        ws_order_number double
        ws_quantity double
        ws_wholesale_cost double
        ws_list_price double
        ws_sales_price double
        ws_ext_discount_amt double
        ws_ext_sales_price double
        ws_ext_wholesale_cost double
        ws_ext_list_price double
        ws_ext_tax double
        ws_coupon_amt double
        ws_ext_ship_cost double
        ws_net_paid double
        ws_net_paid_inc_tax double
        ws_net_paid_inc_ship double
        ws_net_paid_inc_ship_tax double
        ws_net_profit double
    """,
}

RAW_SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType(
        [T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, layout.strip().splitlines())]
    )
    for table, layout in _LAYOUTS.items()
}

# The columns that tell the rows of each raw table apart. None of them may be null.
ROW_KEYS = {
    "catalog_returns": ("cr_item_sk", "cr_order_number"),
    "catalog_sales": ("cs_item_sk", "cs_order_number"),
    "customer": ("c_customer_sk",),
    "customer_address": ("ca_address_sk",),
    "customer_demographics": ("cd_demo_sk",),
    "date_dim": ("d_date_sk",),
    "household_demographics": ("hd_demo_sk",),
    "income_band": ("ib_income_band_sk",),
    "inventory": ("inv_date_sk", "inv_item_sk", "inv_warehouse_sk"),
    "item": ("i_item_sk",),
    "store_returns": ("sr_item_sk", "sr_ticket_number"),
    "store_sales": ("ss_item_sk", "ss_ticket_number"),
    "warehouse": ("w_warehouse_sk",),
    "web_returns": ("wr_item_sk", "wr_order_number"),
    "web_sales": ("ws_item_sk", "ws_order_number"),
}

SALES_MART = (
    "dim_customer_sales",
    "dim_date",
    "dim_item_sales",
    "dim_warehouse_sales",
    "fact_returns_with_sales",
    "fact_sales_inv_weekly",
)
MARKETING_MART = ("dim_customer_marketing", "rpt_clv_marketing", "fact_sales_marketing_daily")

_KEY_SUFFIXES = ("_sk", "_order_number", "_ticket_number")


def is_key(column: str) -> bool:
    """Surrogate keys and order numbers: whole numbers that joins and groups use."""
    return column.endswith(_KEY_SUFFIXES)

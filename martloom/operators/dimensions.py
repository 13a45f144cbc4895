"""Item, warehouse and customer dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martloom.schemas import RAW_SCHEMAS

_LABELS = ("recency_segment", "frequency_segment", "monetary_segment", "customer_segment")


def _unprefixed(
    table: str, prefix: str, without: tuple[str, ...] = (), rename: dict[str, str] | None = None
) -> list[str]:
    """Documented columns of a raw table, and no others, under their names without the table prefix."""
    renamed = rename or {}
    names = [c.removeprefix(prefix) for c in RAW_SCHEMAS[table].names]
    return [f"{prefix}{n} AS `{renamed.get(n, n)}`" for n in names if n not in without]


def dim_item(item: DataFrame) -> DataFrame:
    return item.selectExpr(*_unprefixed("item", "i_"))


def dim_warehouse(warehouse: DataFrame) -> DataFrame:
    return warehouse.selectExpr(*_unprefixed("warehouse", "w_"))


def dim_customer(
    customer: DataFrame,
    customer_address: DataFrame,
    customer_demographics: DataFrame,
    household_demographics: DataFrame,
    income_band: DataFrame,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Customers with address, demographics, household and income band on one row.

    All joins are inner: a customer with any missing link drops out. Households
    meet their income band before the customers do, and the large address table
    comes last. No side is hinted, as address grows with the customers; Spark
    broadcasts a side only under its own size threshold and splits skewed keys.

    Args:
        segments: ``rfm_segments``; when given, only customers with a segment are
            kept and the four labels are added. Labels are never null.
    """
    households = household_demographics.join(
        income_band,
        household_demographics["hd_income_band_sk"] == income_band["ib_income_band_sk"],
    )
    linked = (
        customer.join(households, customer["c_current_hdemo_sk"] == households["hd_demo_sk"])
        .join(customer_demographics, customer["c_current_cdemo_sk"] == customer_demographics["cd_demo_sk"])
        .join(customer_address, customer["c_current_addr_sk"] == customer_address["ca_address_sk"])
    )
    columns = [
        *_unprefixed(
            "customer",
            "c_",
            without=(
                "current_cdemo_sk",
                "current_hdemo_sk",
                "current_addr_sk",
                "first_shipto_date_sk",
                "first_sales_date_sk",
                "birth_country",
                "last_review_date",
            ),
        ),
        *_unprefixed("customer_address", "ca_", without=("address_sk", "address_id")),
        *_unprefixed(
            "customer_demographics",
            "cd_",
            without=("demo_sk",),
            rename={"dep_count": "customer_dep_count"},
        ),
        *_unprefixed(
            "household_demographics",
            "hd_",
            without=("demo_sk", "income_band_sk"),
            rename={"dep_count": "household_dep_count"},
        ),
        *_unprefixed(
            "income_band",
            "ib_",
            without=("income_band_sk",),
            rename={"lower_bound": "income_lower_bound", "upper_bound": "income_upper_bound"},
        ),
    ]
    if segments is None:
        return linked.selectExpr(*columns)
    labels = segments.selectExpr("customer_sk AS segment_customer_sk", *_LABELS)
    return linked.join(labels, customer["c_customer_sk"] == labels["segment_customer_sk"]).selectExpr(
        *columns, *_LABELS
    )

import re
from pathlib import Path

import pytest

from martloom.schemas import RAW_SCHEMAS, is_key

COUNTS = {
    "catalog_returns": 27,
    "catalog_sales": 34,
    "customer_address": 13,
    "customer": 18,
    "customer_demographics": 9,
    "date_dim": 28,
    "household_demographics": 5,
    "income_band": 3,
    "inventory": 4,
    "item": 22,
    "store_returns": 20,
    "store_sales": 23,
    "warehouse": 14,
    "web_returns": 24,
    "web_sales": 34,
}


def test_column_counts():
    assert {name: len(schema) for name, schema in RAW_SCHEMAS.items()} == COUNTS


@pytest.mark.parametrize("name", sorted(RAW_SCHEMAS))
def test_layout_is_the_documented_one(name):
    listed = Path(__file__).resolve().parents[1].joinpath("FIXTURES.md").read_text()
    row = re.search(rf"^\| `{name}` \| \d+ \| [^|]+ \| ([^|]+) \|$", listed, re.MULTILINE)
    ours = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMAS[name].fields)
    assert ours == row[1].strip()


def test_keys():
    assert is_key("cs_item_sk") and is_key("cs_order_number") and is_key("ss_ticket_number")
    assert not is_key("i_brand_id") and not is_key("cs_quantity")

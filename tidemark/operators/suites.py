"""The rule sets of the layers, as data."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.quality import (
    FEATURE_TYPES,
    ColumnCount,
    HasColumn,
    NotNull,
    RowCount,
    TypeIn,
    Unique,
    ValueLength,
)

# Compound keys of the sales tables.
PRIMARY_KEYS = {
    "web_returns": ("wr_item_sk", "wr_order_number"),
    "catalog_returns": ("cr_item_sk", "cr_order_number"),
    "store_returns": ("sr_item_sk", "sr_ticket_number"),
    "web_sales": ("ws_item_sk", "ws_order_number"),
    "inventory": ("inv_date_sk", "inv_item_sk", "inv_warehouse_sk"),
    "catalog_sales": ("cs_item_sk", "cs_order_number"),
    "store_sales": ("ss_item_sk", "ss_ticket_number"),
}

# The curated cube's columns that must exist, and its sums.
CURATED_TOTALS = (
    "total_sold_quantity", "total_ext_wholesale_cost", "total_ext_list_price",
    "total_ext_ship_cost", "total_ext_tax", "total_coupon_amt", "total_net_paid",
    "total_net_paid_inc_tax",
)
CURATED_MANDATORY = (
    "date", "year", "quarter_name", "brand", "manufact", "product_name", "source",
    "store_name", "total_sold_quantity", "total_ext_wholesale_cost",
    "total_ext_ship_cost", "total_ext_tax", "total_coupon_amt", "total_net_paid",
    "total_net_paid_inc_tax",
)


def key_rules(table: str) -> list:
    """Key columns present and, together, unique."""
    keys = PRIMARY_KEYS[table]
    return [*[NotNull(k) for k in keys], Unique(keys)]


# Expected shapes, length bounds and null limits per table.
SALES_SUITES = {
    "store_sales": [
        *key_rules("store_sales"), ValueLength("ss_promo_sk", 0, 1),
        RowCount(2880404), ColumnCount(246), NotNull("ss_net_profit", 1, "WARN"),
    ],
    "catalog_sales": [
        *key_rules("catalog_sales"), ValueLength("cs_promo_sk", 0, 350),
        RowCount(1441548), ColumnCount(35), NotNull("cs_net_profit", 0.9, "WARN"),
    ],
    "web_sales": [
        *key_rules("web_sales"), ValueLength("ws_promo_sk", 0, 350),
        NotNull("ws_net_profit", 0.9, "WARN"),
    ],
    "inventory": [
        *key_rules("inventory"), ValueLength("inv_quantity_on_hand", 0, 350),
        RowCount(11745000), ColumnCount(5), NotNull("inv_quantity_on_hand", 0.9, "WARN"),
    ],
    "web_returns": [
        *key_rules("web_returns"), ValueLength("wr_item_sk", 0, 0),
        RowCount(653844), ColumnCount(25), NotNull("wr_order_number", 1, "WARN"),
    ],
    "catalog_returns": [
        *key_rules("catalog_returns"), ValueLength("cr_item_sk", 0, 3503),
        NotNull("cr_order_number", 0.9, "WARN"),
    ],
}


def curated_suite() -> list:
    """Rules of the curated sales cube: its schema only."""
    return [
        *[HasColumn(c) for c in CURATED_MANDATORY],
        *[TypeIn(c) for c in CURATED_TOTALS],
        *[TypeIn(c, ("DateType",)) for c in ("date", "partition_date")],
    ]


def house_suite(columns: Sequence[str], keys: Sequence[str], day_col: str = "Date",
                category: str = "ocean_proximity") -> list:
    """Rules of the cleaned daily table: keys present, the rest numeric."""
    numeric = [c for c in columns if c not in (day_col, category)]
    return [
        *[NotNull(k) for k in keys],
        *[TypeIn(c, FEATURE_TYPES) for c in numeric],
        TypeIn(day_col, ("DateType",)),
    ]


def feature_suite(columns: Sequence[str], keys: Sequence[str], day_col: str = "Date") -> list:
    """Rules that gate a feature table."""
    return [
        *[NotNull(c) for c in columns],
        Unique(tuple(keys), severity="ERROR"),
        *[TypeIn(c, FEATURE_TYPES) for c in columns if c != day_col],
        TypeIn(day_col, ("DateType",)),
    ]

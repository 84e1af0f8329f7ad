"""Column-name mapping (S4-S6): vendor headers -> the standard schema.

The resolver works on ``df.columns`` only (driver-side metadata, no data) and
emits one ``select`` with aliases, so the mapping costs nothing at run time and
Catalyst still prunes unused source columns.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Alias lists of the pipeline loader (orders / products / customers).
ORDERS_ALIASES = {
    "order_id": ["Order.ID", "Order ID", "order_id", "Order_ID"],
    "order_date": ["Order.Date", "Order Date", "Date", "order_date", "Order_Date"],
    "customer_id": ["Customer.ID", "Customer ID", "Customer.", "customer_id", "Customer_ID"],
    "product_id": ["Product.ID", "Product ID", "product_id", "Product_ID", "product_id", "productid"],
    "quantity": ["Quantity", "quantity", "Qty", "qty", "quantity_ordered", "QuantityOrdered", "units", "Units"],
    "order_value": ["Sales", "sales", "Order Value", "order_value", "actual_price", "discounted_price", "price"],
    "discount_pct": ["Discount", "discount", "discount_percentage", "discounted_price"],
    "ship_date": ["Ship.Date", "Ship Date", "ship_date"],
}
PRODUCTS_ALIASES = {
    "product_id": ["Product.ID", "Product ID", "product_id", "Product_ID"],
    "category": ["Category", "category"],
    "base_price": ["Sales", "sales", "Price", "price"],
    "rating": ["Rating", "rating"],
}
CUSTOMERS_ALIASES = {
    "customer_id": ["Customer.ID", "Customer ID", "Customer.", "customer_id", "Customer_ID"],
    "city": ["City", "city"],
    "signup_date": ["Order.Date", "Order Date", "Date", "First Order"],
    "lifetime_value": ["Sales", "sales"],
}

# Alias lists of the wide-sheet splitter (case-sensitive contains).
SPLIT_ORDER_ALIASES = {
    "order_id": ["Order.ID", "Order ID", "order_id", "Order_ID", "orderId"],
    "order_date": ["Date", "Order Date", "order_date", "Order Date", "Order_Date"],
    "customer_id": ["Customer.", "Customer ID", "customer_id", "Customer_ID", "Customer"],
    "product_id": ["Product.ID", "Product ID", "product_id", "Product_ID"],
    "quantity": ["Quantity", "quantity"],
    "sales": ["Sales", "sales", "order_value"],
    "discount": ["Discount", "discount", "discount_pct"],
    "profit": ["Profit", "profit"],
    "ship_date": ["Ship. Date", "Ship Date", "ship_date", "Ship_Date"],
    "ship_mode": ["Ship. Mode", "Ship Mode", "ship_mode"],
}
SPLIT_PRODUCT_ALIASES = {
    "category": ["Category", "category"],
    "base_price": ["Sales", "sales", "Price", "price"],
    "rating": ["Rating", "rating"],
    "product_name": ["Product. N.", "Product Name", "Product_Name", "Product"],
}
SPLIT_CUSTOMER_ALIASES = {
    "city": ["City", "city"],
    "region": ["Region", "region"],
    "country": ["Country", "country"],
    "state": ["State", "state"],
    "segment": ["Segment", "segment"],
}

SHORT_ALIAS_LEN = 4   # alphabetic aliases this short must match exactly


def _fuzzy_hit(alias: str, col: str) -> bool:
    a, c = alias.strip(), str(col).strip()
    if not c:
        return False
    if len(a) <= SHORT_ALIAS_LEN and a.isalpha():
        return a.lower() == c.lower()
    # a short header (e.g. 'ID') may only match exactly, never as part of an alias
    if len(c) <= SHORT_ALIAS_LEN and c.lower() != a.lower():
        return a.lower() in c.lower()
    return a.lower() in c.lower() or c.lower() in a.lower()


def resolve_columns(columns: Sequence[str], mapping: Mapping[str, Sequence[str]],
                    mode: str = "fuzzy") -> dict[str, str]:
    """Return {standard_name: source_column}.

    ``fuzzy`` (S4): a standard name already present is kept; otherwise an exact
    case-insensitive alias match wins, then the first column (in column order)
    where alias is contained in the column or the column in the alias; short
    alphabetic aliases need an exact match, and so do short headers on the
    column side (a bare 'ID' is not part of 'Customer.ID'); empty names are
    ignored; a source
    column is used for at most one standard name.
    ``contains`` (S5): case-sensitive ``alias in column``, exact matches first;
    a source column may feed several targets (values are copied).
    """
    cols = [c for c in columns]
    used: set[str] = set()
    out: dict[str, str] = {}
    for std, aliases in mapping.items():
        if mode == "fuzzy" and std in cols:
            out[std] = std
            used.add(std)
            continue
        free = [c for c in cols if str(c).strip() and (mode == "contains" or c not in used)]
        if mode == "fuzzy" and any(c in mapping and c != std for c in free):
            free = [c for c in free if not (c in mapping and c != std)]
        hit = None
        for c in free:  # exact first
            if any(str(c).strip().lower() == a.strip().lower() if mode == "fuzzy" else str(c) == a
                   for a in aliases):
                hit = c
                break
        if hit is None:
            for c in free:
                if (any(_fuzzy_hit(a, c) for a in aliases) if mode == "fuzzy"
                        else any(a in str(c) for a in aliases)):
                    hit = c
                    break
        if hit is not None:
            out[std] = hit
            used.add(hit)
    return out


def map_columns(df: DataFrame, mapping: Mapping[str, Sequence[str]], keep_unmapped: bool = True) -> DataFrame:
    """Rename vendor columns to standard names in one projection."""
    hits = resolve_columns(df.columns, mapping, "fuzzy")
    renamed = {src: std for std, src in hits.items()}
    sel = [F.col(f"`{c}`").alias(renamed.get(c, c)) for c in df.columns
           if keep_unmapped or c in renamed]
    return df.select(*sel)


def load_mapping(path_or_text: str) -> dict[str, list[str]]:
    """A per-supplier mapping stored as JSON {standard: [aliases]}."""
    text = path_or_text
    if not path_or_text.lstrip().startswith("{"):
        with open(path_or_text, encoding="utf-8") as fh:
            text = fh.read()
    data = json.loads(text)
    return {str(k): [str(a) for a in v] for k, v in data.items()}

"""Reporting metrics.  Revenue is quantity x unit price and cost is quantity x
unit cost (never the source's SalesAmount / TotalCost columns); INT x
DECIMAL(10,2) is DECIMAL(21,2) and is kept exact end to end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revenue(qty: str = "SalesQuantity", price: str = "UnitPrice") -> Column:
    return F.col(qty) * F.col(price)


def cost(qty: str = "SalesQuantity", unit_cost: str = "UnitCost") -> Column:
    return F.col(qty) * F.col(unit_cost)


def profit(qty: str = "SalesQuantity", price: str = "UnitPrice",
           unit_cost: str = "UnitCost") -> Column:
    return revenue(qty, price) - cost(qty, unit_cost)


def total(c: Column, alias: str) -> Column:
    """Exact decimal total, widened to DECIMAL(38,2)."""
    return F.sum(c).cast("decimal(38,2)").alias(alias)

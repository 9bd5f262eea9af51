"""Revenue bands such as ``100M-500M``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpweave.functions.text import strip

# The multiplier behind each unit letter.
UNIT_FACTORS = {"k": 10**3, "m": 10**6, "b": 10**9, "t": 10**12}


def _side(raw: Column) -> tuple[Column, Column]:
    unit = F.regexp_extract(raw, "([a-zA-Z]+)", 1)
    quantity = strip(F.replace(raw, unit, F.lit("")))
    valid = (unit != "") & quantity.rlike("^[0-9]+$")
    return F.when(valid, quantity.try_cast("bigint")), F.when(valid, unit)


def parse_revenue(c: Column) -> dict[str, Column]:
    """Quantity and unit of both bounds; each side stands alone, and a side without a unit gives nothing."""
    lower = strip(F.substring_index(c, "-", 1))
    upper = strip(F.regexp_replace(c, "(?s)^[^-]*-", ""))
    usable = F.contains(c, F.lit("-")) & (lower != "") & (upper != "")
    low_quantity, low_unit = _side(lower)
    high_quantity, high_unit = _side(upper)
    return {
        "revenue_quantity_lower_bound": F.when(usable, low_quantity),
        "revenue_quantity_upper_bound": F.when(usable, high_quantity),
        "revenue_unit_lower_bound": F.when(usable, low_unit),
        "revenue_unit_upper_bound": F.when(usable, high_unit),
    }


def revenue_amount(quantity: Column, unit: Column) -> Column:
    """Quantity with its unit applied (``500 M`` = 500 000 000); null for an unknown unit."""
    factor = F.create_map(*[F.lit(x) for pair in UNIT_FACTORS.items() for x in pair])
    return quantity.cast("decimal(38,0)") * F.try_element_at(factor, F.lower(unit))

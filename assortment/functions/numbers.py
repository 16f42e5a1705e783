"""Rounding and percentage columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from assortment import fixed


def round2(value: Column | str) -> Column:
    """Two decimals, halves up, for values >= 0.

    The small nudge makes sums that differ in the last bit (other task order) round alike.
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.floor(col * 100 + 0.5 + 1e-7) / F.lit(100.0)


def percent(count: Column, total: Column) -> Column:
    """Whole percent, halves up; NULL for a zero total."""
    return F.when(total != 0, F.floor(count / total * 100 + 0.5))


def band(pct: Column) -> Column:
    """Colour band of a percentage."""
    return (
        F.when(pct >= fixed.BAND_GREEN, "green")
        .when(pct >= fixed.BAND_ACCENT, "accent")
        .when(pct.isNotNull(), "red")
    )


def whole_number(value: Column) -> Column:
    """Text with no decimals, halves to even."""
    return F.bround(value, 0).cast("bigint").cast("string")


def valid_price(price: Column | str) -> Column:
    """Strictly between the price floor and ceiling; NULL price gives NULL."""
    col = F.col(price) if isinstance(price, str) else price
    return (col > fixed.PRICE_FLOOR) & (col < fixed.PRICE_CEILING)


def price_range(price: str, min_price: float | None, max_price: float | None) -> Column:
    """Inclusive optional bounds."""
    keep = F.lit(True)
    if max_price is not None:
        keep = keep & (F.col(price) <= max_price)
    if min_price is not None:
        keep = keep & (F.col(price) >= min_price)
    return keep

"""Price limits written in search texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from assortment import fixed


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    found = F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
    return F.replace(found, F.lit(","), F.lit(".")).cast("double")


def phrase_patterns(strict: bool = False) -> dict[str, str]:
    """Regular expressions for limits in front of, behind and around a number."""
    before_max = fixed.STRICT_MAX_BEFORE if strict else fixed.MAX_BEFORE
    before_min = fixed.STRICT_MIN_BEFORE if strict else fixed.MIN_BEFORE
    ws, sign, number = fixed.WS, fixed.SIGN, fixed.NUMBER
    return {
        "max_before": before_max + ws + sign + ws + number,
        "max_after": number + ws + sign + ws + fixed.MAX_AFTER,
        "min_before": before_min + ws + sign + ws + number,
        "min_after": number + ws + sign + ws + fixed.MIN_AFTER,
        "range": fixed.RANGE_OPEN + ws + sign + ws + number + ws + fixed.RANGE_JOIN + ws + sign + ws + number,
    }


def price_limits(text: Column, strict: bool = False) -> tuple[Column, Column]:
    """(min_price, max_price) of a text; a range phrase outranks single limits."""
    low = F.lower(text)
    p = phrase_patterns(strict)
    max_price = F.coalesce(
        _number(low, p["range"], 2), _number(low, p["max_before"]), _number(low, p["max_after"])
    )
    min_price = F.coalesce(
        _number(low, p["range"], 1), _number(low, p["min_before"]), _number(low, p["min_after"])
    )
    return min_price, max_price

"""String cleaning helpers (built-in expressions only, no UDF)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lastmile import fixed


def canonical_city(city: Column) -> Column:
    """``initcap(trim(city))``: '  MADRID ' and 'madrid' become 'Madrid'."""
    return F.initcap(F.trim(city))


def pad_zip(zip_code: Column, width: int = fixed.ZIP_WIDTH, pad: str = fixed.ZIP_PAD) -> Column:
    """Left-pad a postal code to ``width`` (longer values are cut to ``width``, like lpad)."""
    return F.lpad(zip_code, width, pad)


def fix_decimal_comma(number_text: Column) -> Column:
    """Replace every decimal comma by a point: '2,4' -> '2.4'."""
    return F.replace(number_text, F.lit(","), F.lit("."))


def to_double(number_text: Column) -> Column:
    """Numeric cast that yields null on text that is not a number (ANSI-safe)."""
    return number_text.try_cast("double")


def canonical_value(value: Column, canon: Mapping[str, Sequence[str]]) -> Column:
    """Map upper-cased variants onto canonical values.

    Values outside the map are kept upper-cased; null stays null.
    """
    upper = F.upper(value)
    expr = None
    for canonical, variants in canon.items():
        cond = upper.isin(*variants)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return upper if expr is None else expr.otherwise(upper)


def canonical_contract(contract: Column,
                       canon: Mapping[str, Sequence[str]] = fixed.CONTRACT_CANON) -> Column:
    return canonical_value(contract, canon)

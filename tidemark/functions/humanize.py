"""Large numbers as short text: 5000000 -> ``5 Million``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
UNITS = ("", " Thousand", " Million", " Billion", " Trillion")
PRECISIONS = (0, 1, 2)


def kpi_humanize(number: Column, precision: int = 0) -> Column:
    """Number with its thousands unit; a precision other than 0, 1, 2 means 0."""
    digits = precision if precision in PRECISIONS else 0
    value = number.cast("double")
    power = F.floor(F.log10(F.abs(value)) / 3)
    unit = F.when(value == 0, F.lit(0)).otherwise(
        F.least(F.lit(len(UNITS) - 1), F.greatest(F.lit(0), power))
    ).cast("int")
    scaled = F.bround(value / F.pow(F.lit(1000.0), unit), digits)
    names = F.array(*[F.lit(name) for name in UNITS])
    text = F.concat(F.format_string(f"%.{digits}f", scaled), F.get(names, unit))
    return F.when(value.isNotNull(), text)

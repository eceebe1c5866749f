"""Casts that turn junk into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"
_ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}"
_JAVA_SUFFIX = r"[0-9.][dDfF]$"
_INT_LIMIT = 2147483647.0


def to_date_safe(c: Column) -> Column:
    """`6/7/2024`, `06/07/2024` and ISO text become dates, anything else NULL.

    The shape is tested first: a failed parse costs an exception per row.
    """
    text = F.trim(c)
    return F.when(text.rlike(_SLASH_DATE), F.try_to_date(text, "M/d/yyyy")).when(
        text.rlike(_ISO_DATE), text.try_cast("date")
    )


def to_double_safe(c: Column) -> Column:
    """Numeric text to double; Java's `1d`/`1f` spellings are not numbers here."""
    text = F.trim(c)
    return F.when(~text.rlike(_JAVA_SUFFIX), text.try_cast("double"))


def to_int_safe(c: Column) -> Column:
    """Numeric text to int, fractions rounded half away from zero, out of range NULL."""
    value = F.round(to_double_safe(c))
    return F.when(F.abs(value) <= _INT_LIMIT, value.cast("int"))

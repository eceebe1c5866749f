"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of the criticality flag.
FLAGS = ("Critical", "Not Critical", "Not Applicable")
UNEXPECTED_FLAG = "Unexpected"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def canonical_flag(c: Column) -> Column:
    """Known flags in canonical case, blank as NULL, the rest as `Unexpected`."""
    cleaned = blank_to_null(c)
    spellings = F.create_map(*[F.lit(text) for name in FLAGS for text in (name.lower(), name)])
    known = F.try_element_at(spellings, F.lower(cleaned))
    return F.when(cleaned.isNotNull(), F.coalesce(known, F.lit(UNEXPECTED_FLAG)))

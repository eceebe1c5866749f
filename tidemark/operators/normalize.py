"""Raw text rows to typed rows, and exact-row deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    blank_to_null,
    canonical_flag,
    fingerprint,
    to_date_safe,
    to_double_safe,
    to_int_safe,
)
from tidemark.sources.raw_log import raw_col

# Target name -> source header, by how the value is typed.
_TEXT = {
    "restaurant_name": "DBA",
    "borough": "BORO",
    "building": "BUILDING",
    "street": "STREET",
    "zipcode": "ZIPCODE",
    "phone": "PHONE",
    "cuisine_description": "CUISINE DESCRIPTION",
    "action": "ACTION",
    "violation_code": "VIOLATION CODE",
    "violation_description": "VIOLATION DESCRIPTION",
    "grade": "GRADE",
    "inspection_type": "INSPECTION TYPE",
    "nta": "NTA",
    "location": "Location",
}
_DATES = {
    "inspection_date": "INSPECTION DATE",
    "grade_date": "GRADE DATE",
    "record_date": "RECORD DATE",
}
_DOUBLES = {"latitude": "Latitude", "longitude": "Longitude"}
_IDENTIFIERS = {
    "camis": "CAMIS",
    "community_board": "Community Board",
    "council_district": "Council District",
    "census_tract": "Census Tract",
    "bin": "BIN",
    "bbl": "BBL",
}

NORMALIZED_COLUMNS = (
    "camis", "restaurant_name", "borough", "building", "street", "zipcode", "phone",
    "cuisine_description", "inspection_date", "action", "violation_code",
    "violation_description", "critical_flag", "score", "grade", "grade_date",
    "record_date", "inspection_type", "latitude", "longitude", "community_board",
    "council_district", "census_tract", "bin", "bbl", "nta", "location", "raw_row_hash",
)

_HASHED = (
    "camis", "restaurant_name", "inspection_date", "inspection_type", "violation_code",
    "violation_description", "_flag_text", "score", "grade", "grade_date", "action",
)


def _typed_columns() -> dict[str, Column]:
    typed = {name: blank_to_null(raw_col(src)) for name, src in _TEXT.items()}
    typed |= {name: to_date_safe(raw_col(src)) for name, src in _DATES.items()}
    typed |= {name: to_double_safe(raw_col(src)) for name, src in _DOUBLES.items()}
    typed |= {name: raw_col(src).cast("string") for name, src in _IDENTIFIERS.items()}
    typed["critical_flag"] = canonical_flag(raw_col("CRITICAL FLAG"))
    typed["score"] = to_int_safe(raw_col("SCORE"))
    return typed


def normalize_rows(raw: DataFrame) -> DataFrame:
    """One typed row per raw row.

    The fingerprint covers eleven values: entity, name, event date and type,
    violation code and text, flag as written, score, grade, grade date, action.
    Dates and the score enter in typed form, so spelling variants agree.
    """
    typed = _typed_columns() | {"_flag_text": F.trim(raw_col("CRITICAL FLAG"))}
    # Two projections: one holding both would outgrow what the JIT compiles.
    values = raw.select(*[c.alias(name) for name, c in typed.items()])
    digest = fingerprint(*[F.col(c) for c in _HASHED]).alias("raw_row_hash")
    return values.select(*[digest if c == "raw_row_hash" else F.col(c) for c in NORMALIZED_COLUMNS])


def deduplicate(rows: DataFrame) -> DataFrame:
    """Drop exact duplicates.

    Copies share their event, so rows are dealt by it: the rows of an event share most values and lie side by side,
    which makes what is moved and stored a fraction of scattered rows, and whatever groups by event or entity
    afterwards finds its rows together.  A hot entity spreads over its events; all rows of one event meet in one task.
    """
    return rows.repartition("camis", "inspection_date", "inspection_type").dropDuplicates()


def row_digest(rows: DataFrame) -> dict[str, Column]:
    """128 bits, as two columns, by which rows with equal values in all columns agree; others differ as the hash tells them apart.

    The hash passes over NULL, so which columns are NULL is hashed before the values.
    """
    names = rows.columns
    nulls = [
        reduce(Column.bitwiseOR, [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(names[at : at + 62])])
        for at in range(0, len(names), 62)
    ]
    # As for grouping, the two zeros of a double are one value.
    values = [F.col(name) + 0.0 if kind == "double" else F.col(name) for name, kind in rows.dtypes]
    return {f"_row{seed}": F.xxhash64(F.lit(seed), *nulls, *values) for seed in (1, 2)}


def dedup_audit(rows: DataFrame) -> DataFrame:
    """Input rows, output rows and their difference from one pass."""
    groups = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("input_row_count"),
        F.count(F.lit(1)).alias("output_row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("exact_duplicates_removed"),
    )

"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.policy import UNKNOWN_TYPE


def fingerprint(*cols: Column) -> Column:
    """md5 of the pipe-joined values, NULL read as the empty string."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def event_key(entity: Column, day: Column, kind: Column) -> Column:
    """The id that events and their detail rows share."""
    return fingerprint(entity, day, F.coalesce(kind, F.lit(UNKNOWN_TYPE)))

"""Builders for small fixtures."""

from __future__ import annotations

import datetime as dt

from tidemark.sources.raw_log import RAW_COLUMNS, RAW_SCHEMA

INITIAL = "Cycle Inspection / Initial Inspection"
AGAIN = "Cycle Inspection / Re-inspection"


def raw_rows(spark, rows):
    """Raw text rows from dicts; absent columns are NULL."""
    return spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW_SCHEMA)


def event_rows(spark, rows):
    """Wide event rows from (id, camis, date, kind, criticals, score)."""
    cells = []
    for eid, camis, day, kind, critical, score in rows:
        first, again = kind == INITIAL, kind == AGAIN
        cells.append(
            (eid, camis, dt.date.fromisoformat(day), kind, first or again, first, again, first, first or again,
             score, None, None, "act", critical + 1, critical + 1, critical, 1, True, critical > 0, critical)
        )
    return spark.createDataFrame(
        cells,
        "inspection_id string, camis string, inspection_date date, inspection_type string, is_cycle_inspection boolean,"
        " is_cycle_initial boolean, is_cycle_reinspection boolean, is_eligible_target_event boolean,"
        " is_eligible_historical_event boolean, score int, grade string, grade_date date, action string,"
        " source_row_count bigint, total_violations bigint, critical_violation_count bigint,"
        " noncritical_violation_count bigint, has_any_violation boolean, has_critical_violation boolean,"
        " coded_critical_count bigint",
    )

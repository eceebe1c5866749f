"""Policies the operators take as parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Category names and sentinels of the inspection feed.
INITIAL_TYPE = "Cycle Inspection / Initial Inspection"
REINSPECTION_TYPE = "Cycle Inspection / Re-inspection"
UNKNOWN_TYPE = "UNKNOWN"
SENTINEL_DATE = dt.date(1900, 1, 1)

CAPACITIES = (50, 100, 250, 500)
ALPHAS = (1.0, 5.0, 10.0, 20.0)
INVERSE_REGULARISATIONS = (0.1, 1.0, 2.0, 5.0, 8.0, 10.0)


@dataclass(frozen=True)
class EventPolicy:
    """Which events may be targets or history, and what counts as severe."""

    target_types: tuple[str, ...] = (INITIAL_TYPE,)
    initial_types: tuple[str, ...] = (INITIAL_TYPE,)
    reinspection_types: tuple[str, ...] = (REINSPECTION_TYPE,)
    severity_threshold: int = 3
    trailing_days: int = 365
    sentinel_date: dt.date = SENTINEL_DATE

    @property
    def history_types(self) -> tuple[str, ...]:
        return self.initial_types + self.reinspection_types


@dataclass(frozen=True)
class SplitBounds:
    """Half-open periods: [start, validation), [validation, test), [test, end)."""

    start: dt.date = dt.date(2022, 1, 1)
    validation: dt.date = dt.date(2024, 1, 1)
    test: dt.date = dt.date(2025, 1, 1)
    end: dt.date = dt.date(2026, 1, 1)


@dataclass(frozen=True)
class QualityThresholds:
    """Largest tolerated rate per check: `hard` ones fail a run, `soft` ones warn."""

    hard: dict[str, float] = field(
        default_factory=lambda: {
            "unexpected_critical_flag_rate": 0.0,
            "duplicate_restaurant_rate": 0.0,
            "duplicate_inspection_event_rate": 0.0,
            "orphan_violation_rate": 0.0,
            "invalid_target_date_rate": 0.0,
            "feature_future_date_rate": 0.0,
            "invalid_label_rate": 0.0,
        }
    )
    soft: dict[str, float] = field(
        default_factory=lambda: {
            "unparseable_inspection_date_rate": 0.01,
            "missing_borough_rate": 0.01,
            "missing_cuisine_rate": 0.05,
            "missing_location_rate": 0.25,
            "event_attribute_conflict_rate": 0.01,
            "source_row_count_change_rate": 0.30,
        }
    )

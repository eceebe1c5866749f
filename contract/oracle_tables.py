"""The stage tables as SQL common table expressions, written in join form.

The library computes histories and next targets with windows; the oracle uses
range joins and lateral lookups, so agreement checks the rewrite as well.
"""

from __future__ import annotations

from contract.expected import (
    DIMENSIONS, DOUBLE_SOURCES, ENTITY_ATTRIBUTES, FEATURE_COLUMNS, HISTORY_FEATURES, IDENTIFIER_SOURCES, LABEL_COLUMNS,
    NORMALIZED_COLUMNS, POPULATION_COLUMNS, TEXT_SOURCES,
)
from contract.raw_view import RAW_SQL
from tidemark.policy import INITIAL_TYPE, REINSPECTION_TYPE


def columns(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


def _text(src: str) -> str:
    return f"nullif(trim(\"{src}\"), '')"


def _date(src: str) -> str:
    return f"coalesce(CAST(try_strptime(\"{src}\", '%m/%d/%Y') AS DATE), try_cast(\"{src}\" AS DATE))"


_TYPED = (
    {name: _text(src) for name, src in TEXT_SOURCES.items()}
    | {name: f'"{src}"' for name, src in IDENTIFIER_SOURCES.items()}
    | {name: f'try_cast("{src}" AS DOUBLE)' for name, src in DOUBLE_SOURCES.items()}
    | {
        "inspection_date": _date("INSPECTION DATE"),
        "grade_date": _date("GRADE DATE"),
        "record_date": _date("RECORD DATE"),
        "score": 'try_cast("SCORE" AS INTEGER)',
        "flag_text": 'trim("CRITICAL FLAG")',
    }
)

_HASHED = (
    "camis", "restaurant_name", "inspection_date", "inspection_type", "violation_code",
    "violation_description", "flag_text", "score", "grade", "grade_date", "action",
)

NORM_SQL = f"""
typed AS (SELECT {", ".join(f"{sql} AS {name}" for name, sql in _TYPED.items())} FROM raw),
norm AS (
  SELECT {columns(NORMALIZED_COLUMNS)} FROM (
    SELECT *,
      CASE lower(flag_text) WHEN '' THEN NULL WHEN 'critical' THEN 'Critical'
        WHEN 'not critical' THEN 'Not Critical' WHEN 'not applicable' THEN 'Not Applicable'
        ELSE CASE WHEN flag_text IS NOT NULL THEN 'Unexpected' END END AS critical_flag,
      md5(concat_ws('|', {", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _HASHED)})) AS raw_row_hash
    FROM typed)
),
dedup AS MATERIALIZED (SELECT DISTINCT * FROM norm)"""

ENTITIES_SQL = f"""
entities AS MATERIALIZED (
  SELECT camis, {columns(ENTITY_ATTRIBUTES)},
    inspection_date AS latest_observed_inspection_date, record_date AS latest_observed_record_date
  FROM dedup WHERE camis IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY camis ORDER BY inspection_date DESC NULLS LAST,
    record_date DESC NULLS LAST, raw_row_hash, {", ".join(f"{c} NULLS LAST" for c in ENTITY_ATTRIBUTES)}) = 1
)"""

_KEY = "md5(concat_ws('|', camis, CAST(inspection_date AS VARCHAR), inspection_type))"
_HISTORY = f"inspection_type IN ('{INITIAL_TYPE}', '{REINSPECTION_TYPE}')"

EVENTS_SQL = f"""
dated AS (
  SELECT * REPLACE (coalesce(inspection_type, 'UNKNOWN') AS inspection_type) FROM dedup
  WHERE camis IS NOT NULL AND inspection_date <> DATE '1900-01-01'
),
ev AS (
  SELECT {_KEY} AS inspection_id, *,
    {_HISTORY} AS is_cycle_inspection, inspection_type = '{INITIAL_TYPE}' AS is_cycle_initial,
    inspection_type = '{REINSPECTION_TYPE}' AS is_cycle_reinspection,
    inspection_type = '{INITIAL_TYPE}' AS is_eligible_target_event, {_HISTORY} AS is_eligible_historical_event,
    total_violations > 0 AS has_any_violation, critical_violation_count > 0 AS has_critical_violation
  FROM (
    SELECT camis, inspection_date, inspection_type,
      max(score) AS score, max(grade) AS grade, max(grade_date) AS grade_date, max(action) AS action,
      count(*) AS source_row_count, count(violation_code) AS total_violations,
      count(*) FILTER (critical_flag = 'Critical') AS critical_violation_count,
      count(*) FILTER (critical_flag = 'Not Critical') AS noncritical_violation_count,
      count(DISTINCT score) AS distinct_score_count, count(DISTINCT grade) AS distinct_grade_count,
      count(DISTINCT action) AS distinct_action_count
    FROM dated GROUP BY ALL)
),
viol AS (
  SELECT {_KEY} AS inspection_id, camis, inspection_date, inspection_type, violation_code,
    violation_description, critical_flag, coalesce(critical_flag = 'Critical', false) AS is_critical_violation
  FROM dated WHERE violation_code IS NOT NULL
)"""

SNAPSHOT_SQL = f"""
pop AS (
  SELECT c.inspection_id AS cutoff_inspection_id, c.camis, c.inspection_date AS cutoff_date,
    c.inspection_type AS cutoff_inspection_type, c.is_cycle_initial AS cutoff_is_cycle_initial,
    c.is_cycle_reinspection AS cutoff_is_cycle_reinspection, n.tid AS target_inspection_id,
    n.tdate AS target_inspection_date, n.ttype AS target_inspection_type,
    datediff('day', c.inspection_date, n.tdate) AS days_to_target
  FROM ev c, LATERAL (
    SELECT t.inspection_id AS tid, t.inspection_date AS tdate, t.inspection_type AS ttype FROM ev t
    WHERE t.is_eligible_target_event AND t.camis = c.camis AND t.inspection_date > c.inspection_date
    ORDER BY t.inspection_date, t.inspection_id LIMIT 1) n
  WHERE c.is_eligible_historical_event
),
lab AS (
  SELECT {columns(LABEL_COLUMNS)} FROM (
    SELECT p.*, t.total_violations AS target_total_violations, t.score AS target_score,
      t.critical_violation_count AS target_critical_violation_count,
      t.noncritical_violation_count AS target_noncritical_violation_count,
      t.grade AS target_grade, t.action AS target_action,
      (t.critical_violation_count >= 1)::INT AS target_any_critical,
      (t.critical_violation_count >= 2)::INT AS target_two_or_more_critical,
      (t.critical_violation_count >= 3)::INT AS target_three_or_more_critical,
      (t.critical_violation_count >= 4)::INT AS target_four_or_more_critical,
      (t.critical_violation_count >= 3)::INT AS target_high_severity,
      if(t.critical_violation_count >= 3, 'high_severity_critical_outcome', 'below_high_severity_threshold') AS target_label
    FROM pop p JOIN ev t ON t.inspection_id = p.target_inspection_id)
)"""


def _history_aggregates() -> str:
    severe = "h.critical_violation_count >= 3"
    counts = {
        "prior_cycle_inspection_count": "true",
        "prior_cycle_initial_count": "h.is_cycle_initial",
        "prior_cycle_reinspection_count": "h.is_cycle_reinspection",
        "prior_critical_inspection_count": "h.has_critical_violation",
        "prior_cycle_initial_critical_count": "h.is_cycle_initial AND h.has_critical_violation",
        "prior_cycle_reinspection_critical_count": "h.is_cycle_reinspection AND h.has_critical_violation",
        "prior_high_severity_inspection_count": severe,
        "prior_cycle_initial_high_severity_count": f"h.is_cycle_initial AND {severe}",
        "prior_cycle_reinspection_high_severity_count": f"h.is_cycle_reinspection AND {severe}",
        "cycle_inspections_last_365d": "fresh",
        "critical_cycle_inspections_last_365d": "fresh AND h.has_critical_violation",
        "high_severity_cycle_inspections_last_365d": f"fresh AND {severe}",
    }
    parts = [f"count(*) FILTER ({met}) AS {name}" for name, met in counts.items()]
    for name, met in {"cycle": "true", "critical": "h.has_critical_violation", "high_severity": severe}.items():
        parts.append(f"max(h.inspection_date) FILTER ({met}) AS last_{name}_inspection_date")
    parts += [
        "max(h.inspection_date) AS feature_source_max_date",
        "CAST(sum(h.critical_violation_count) AS BIGINT) AS prior_critical_violation_count",
        "max(h.score) AS max_historical_score",
        "avg(h.score) AS average_historical_score",
        "avg(h.score) FILTER (fresh) AS average_score_last_365d",
    ]
    return ", ".join(parts)


def _blocks(prefix: str, base: str, key: str) -> str:
    """History features of `base` (key, camis, cutoff_date) as CTE `<prefix>_features`."""
    rates = ", ".join(
        f"CAST(prior_{k}_inspection_count AS DOUBLE) / prior_cycle_inspection_count AS prior_{k}_inspection_rate,"
        f" datediff('day', last_{k}_inspection_date, cutoff_date) AS days_since_last_{k}_inspection"
        for k in ("critical", "high_severity")
    )
    return f"""
{prefix}_hist AS (
  SELECT {key}, camis, cutoff_date, {_history_aggregates()} FROM (
    SELECT b.{key}, b.camis, b.cutoff_date, h, h.inspection_date + 365 >= b.cutoff_date AS fresh
    FROM {base} b JOIN ev h ON h.camis = b.camis AND h.inspection_date <= b.cutoff_date
    WHERE h.is_eligible_historical_event) GROUP BY ALL
),
{prefix}_detail AS (
  SELECT b.{key}, count(*) AS prior_total_violations,
    count(*) FILTER (v.is_critical_violation) AS prior_critical_violation_rows,
    count(*) FILTER (v.inspection_date + 365 >= b.cutoff_date) AS violations_last_365d,
    count(*) FILTER (v.inspection_date + 365 >= b.cutoff_date AND v.is_critical_violation) AS critical_violations_last_365d,
    max(v.inspection_date) AS violation_feature_source_max_date
  FROM {base} b JOIN viol v ON v.camis = b.camis AND v.inspection_date <= b.cutoff_date
  WHERE v.{_HISTORY} GROUP BY ALL
),
{prefix}_features AS (
  SELECT * REPLACE (coalesce(prior_total_violations, 0) AS prior_total_violations,
      coalesce(prior_critical_violation_rows, 0) AS prior_critical_violation_rows,
      coalesce(violations_last_365d, 0) AS violations_last_365d,
      coalesce(critical_violations_last_365d, 0) AS critical_violations_last_365d),
    {rates}, datediff('day', last_cycle_inspection_date, cutoff_date) AS days_since_last_cycle_inspection,
    CASE prior_cycle_initial_count WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2-3' WHEN 3 THEN '2-3'
      ELSE '4+' END AS history_depth_bucket,
    prior_cycle_initial_count = 0 AS has_no_cycle_initial_history
  FROM {prefix}_hist LEFT JOIN {prefix}_detail USING ({key})
)"""


FEATURES_SQL = f"""{_blocks("snap", "pop", "cutoff_inspection_id")},
feat AS (
  SELECT {columns(FEATURE_COLUMNS)} FROM snap_features LEFT JOIN
    (SELECT camis, {columns(DIMENSIONS)} FROM entities) USING (camis)
)"""

SCORING_SQL = f"""
current AS (
  SELECT camis, camis AS entity_key, (SELECT max(inspection_date) FROM ev) AS cutoff_date
  FROM (SELECT DISTINCT camis FROM ev WHERE is_eligible_historical_event)
),{_blocks("now", "current", "entity_key")},
scoring AS (
  SELECT camis, cutoff_date, {columns(HISTORY_FEATURES)}, restaurant_name, {columns(DIMENSIONS)},
    true AS is_eligible_for_scoring,
    if(prior_cycle_initial_count = 0, 'limited_cycle_initial_history', 'eligible') AS scoring_eligibility_reason
  FROM now_features LEFT JOIN (SELECT camis, restaurant_name, {columns(DIMENSIONS)} FROM entities) USING (camis)
)"""

MODELING_SQL = f"""
model AS (
  SELECT f.*, {columns([c for c in LABEL_COLUMNS if c not in ("camis", "cutoff_date", "cutoff_inspection_id")], "l.")}
  FROM feat f JOIN lab l ON l.cutoff_inspection_id = f.cutoff_inspection_id
),
parted AS (
  SELECT * FROM (SELECT *,
    CASE WHEN cutoff_date >= DATE '1995-01-01' AND cutoff_date < DATE '1999-01-01' THEN 'train'
      WHEN cutoff_date >= DATE '1999-01-01' AND cutoff_date < DATE '2000-01-01' THEN 'validation'
      WHEN cutoff_date >= DATE '2000-01-01' AND cutoff_date < DATE '2002-01-01' THEN 'test' END AS split
    FROM model) WHERE split IS NOT NULL
)"""

PRELUDE = ",".join(
    [RAW_SQL, NORM_SQL, ENTITIES_SQL, EVENTS_SQL, SNAPSHOT_SQL, FEATURES_SQL, SCORING_SQL, MODELING_SQL]
)


def over_stages(select: str, *more: str) -> str:
    """A query over the stage CTEs; `more` are extra CTE definitions."""
    return f"WITH {','.join([PRELUDE, *more])}\n{select}"

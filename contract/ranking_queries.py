"""Baselines, ranking policies, metrics and the scored queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.oracle_tables import over_stages
from contract.queries import register
from contract.stages import Stages
from tidemark.functions import percent_text, risk_tier, sigmoid
from tidemark.operators import metrics, profile, ranking
from tidemark.operators.baselines import SMOOTHED, base_rate, smoothed_risk, smoothed_risk_grid
from tidemark.operators.prefix import global_rank
from tidemark.operators.splits import take_split
from tidemark.policy import ALPHAS, CAPACITIES
from tidemark.sources.tables import usable_scores

IDS = ("camis", "cutoff_inspection_id")
FITTED = "fitted_probability"
RATE = "prior_high_severity_inspection_rate"
KS = f"(SELECT unnest([{', '.join(map(str, CAPACITIES))}])::BIGINT AS capacity) ks"

# A fixed margin stands in for the fitted model, so SQL can state the scores.
MARGIN = "(3 * prior_high_severity_inspection_rate + critical_violations_last_365d / CAST(8 AS DOUBLE) - 1.5)"


def margin():
    return 3 * F.col(RATE) + F.col("critical_violations_last_365d") / F.lit(8.0) - 1.5


def fixed_probability(slope: float = 1.0, intercept: float = 0.0):
    """Nine places: the engines' exp() may differ in the last bit, which would reorder ties."""
    return F.round(sigmoid(margin(), slope, intercept), 9)


def fixed_sql(slope: float = 1.0, intercept: float = 0.0) -> str:
    return f"round(1 / (1 + exp(-({MARGIN} * CAST({slope} AS DOUBLE) + CAST({intercept} AS DOUBLE)))), 9)"


def train_of(s: Stages) -> DataFrame:
    return take_split(s.parted, "train")


def scored(s: Stages, split: str = "test") -> DataFrame:
    """A held-out split with the smoothed risk and the fixed-margin probability."""
    data = take_split(s.parted, split)
    return smoothed_risk(train_of(s), data, 5.0).withColumn(FITTED, fixed_probability())


_SCORED = f"""
hist AS (SELECT camis, sum(target_high_severity) AS positives, count(*) AS seen FROM parted WHERE split = 'train' GROUP BY camis),
rate AS (SELECT avg(target_high_severity) AS r FROM parted WHERE split = 'train'),
scored AS (
  SELECT p.*, coalesce((positives + 5 * r) / (seen + CAST(5 AS DOUBLE)), r) AS {SMOOTHED},
    {fixed_sql()} AS {FITTED}
  FROM parted p CROSS JOIN rate LEFT JOIN hist USING (camis)
),
test AS (SELECT * EXCLUDE (split) FROM scored WHERE split = 'test'),
validation AS (SELECT * EXCLUDE (split) FROM scored WHERE split = 'validation')"""


def over_scored(select: str, *more: str) -> str:
    return over_stages(select, _SCORED, *more)


def _place(score: str, name: str, direction: str = "DESC") -> str:
    return f"row_number() OVER (ORDER BY {score} {direction} NULLS LAST, camis, cutoff_inspection_id) AS {name}"


@register("base_rate", over_scored("SELECT round(r, 6) AS base_rate FROM rate"))
def _(s):
    return base_rate(train_of(s))


@register("smoothed_risk", over_scored(f"SELECT camis, cutoff_inspection_id, round({SMOOTHED}, 6) AS {SMOOTHED} FROM test"))
def _(s):
    return scored(s).select(*IDS, SMOOTHED)


@register(
    "random_policy",
    over_scored(
        "SELECT capacity, round(capacity * p, 6) AS expected_high_severity_outcomes, round(p, 6) AS expected_precision_at_k,"
        f" CAST(1 AS DOUBLE) AS lift_vs_random FROM {KS}, (SELECT avg(target_high_severity) AS p FROM test)"
    ),
)
def _(s):
    return ranking.random_policy(take_split(s.parted, "test"))


def _policy_sql(policy: str, score: str, table: str, direction: str = "DESC", outcome_kind: str = "BIGINT") -> str:
    return (
        f"SELECT '{policy}' AS policy, capacity, count(*) AS selected_examples,"
        f" CAST(sum(target_high_severity) AS {outcome_kind}) AS high_severity_outcomes_found,"
        " round(avg(target_high_severity), 6) AS precision_at_k,"
        " round(sum(target_high_severity) / CAST(any_value(total) AS DOUBLE), 6) AS recall_at_k,"
        " round(avg(target_high_severity) / any_value(prevalence), 6) AS lift_vs_random,"
        " round(sum(target_high_severity) - capacity * any_value(prevalence), 6) AS incremental_outcomes_vs_random"
        f" FROM {KS}, (SELECT target_high_severity, {_place(score, 'place', direction)},"
        " sum(target_high_severity) OVER () AS total, avg(target_high_severity) OVER () AS prevalence"
        f" FROM {table}) WHERE place <= capacity GROUP BY capacity"
    )


def _chance_sql(table: str) -> str:
    return (
        "SELECT 'random_expected' AS policy, capacity, capacity AS selected_examples,"
        " round(capacity * p, 6) AS high_severity_outcomes_found, round(p, 6) AS precision_at_k,"
        " CAST(NULL AS DOUBLE) AS recall_at_k, CAST(1 AS DOUBLE) AS lift_vs_random,"
        f" CAST(0 AS DOUBLE) AS incremental_outcomes_vs_random FROM {KS}, (SELECT avg(target_high_severity) AS p FROM {table})"
    )


@register("policy_at_k", over_scored(_policy_sql("smoothed", SMOOTHED, "test")))
def _(s):
    return ranking.policy_at_k(scored(s), SMOOTHED, "smoothed", CAPACITIES, *IDS)


@register(
    "capacity_sweep",
    over_scored(
        _chance_sql("test")
        + " UNION ALL " + _policy_sql("smoothed_historical_risk", SMOOTHED, "test", outcome_kind="DOUBLE")
        + " UNION ALL " + _policy_sql("fitted", FITTED, "test", outcome_kind="DOUBLE")
    ),
)
def _(s):
    return ranking.capacity_sweep(
        scored(s), {"smoothed_historical_risk": SMOOTHED, "fitted": FITTED}, CAPACITIES, *IDS
    )


@register(
    "exploratory_policies",
    over_stages(
        _chance_sql("model")
        + " UNION ALL " + _policy_sql("oldest_inspection_first", "days_since_last_critical_inspection", "model", outcome_kind="DOUBLE")
        + " UNION ALL " + _policy_sql("fewest_visits_first", "prior_cycle_inspection_count", "model", "ASC", "DOUBLE")
        + " UNION ALL " + _policy_sql("unsmoothed_high_severity_history", RATE, "model", outcome_kind="DOUBLE")
    ),
)
def _(s):
    return ranking.capacity_sweep(
        s.modeling,
        {
            "oldest_inspection_first": "days_since_last_critical_inspection",
            "fewest_visits_first": "prior_cycle_inspection_count",
            "unsmoothed_high_severity_history": RATE,
        },
        CAPACITIES,
        *IDS,
        ascending=["fewest_visits_first"],
    )


_GRID = f"""
grid AS (
  SELECT p.*, alpha, coalesce((positives + alpha * r) / (seen + alpha), r) AS score
  FROM parted p CROSS JOIN rate CROSS JOIN (SELECT unnest([{', '.join(f"CAST({a} AS DOUBLE)" for a in ALPHAS)}]) AS alpha)
  LEFT JOIN hist USING (camis) WHERE split = 'validation'
)"""


@register(
    "alpha_grid",
    over_scored(
        "SELECT alpha, capacity, CAST(sum(target_high_severity) AS BIGINT) AS policy_outcomes_found,"
        " round(avg(target_high_severity), 6) AS policy_precision_at_k,"
        " round(sum(target_high_severity) / CAST(any_value(total) AS DOUBLE), 6) AS policy_recall_at_k,"
        " round(avg(target_high_severity) / any_value(prevalence), 6) AS policy_lift_vs_random,"
        " round(capacity * any_value(prevalence), 6) AS random_expected_outcomes,"
        " round(any_value(prevalence), 6) AS random_expected_precision,"
        " round(sum(target_high_severity) - capacity * any_value(prevalence), 6) AS incremental_outcomes_vs_random"
        f" FROM {KS}, (SELECT alpha, target_high_severity, row_number() OVER (PARTITION BY alpha ORDER BY score DESC, camis, cutoff_inspection_id) AS place,"
        " sum(target_high_severity) OVER (PARTITION BY alpha) AS total, avg(target_high_severity) OVER (PARTITION BY alpha) AS prevalence FROM grid)"
        " WHERE place <= capacity GROUP BY alpha, capacity",
        _GRID,
    ),
)
def _(s):
    grid = smoothed_risk_grid(train_of(s), take_split(s.parted, "validation"), ALPHAS, "score")
    return ranking.alpha_grid(grid, "score", CAPACITIES, *IDS)


@register(
    "alpha_spread",
    over_scored(
        "SELECT alpha, round(min(score), 6) AS min_score, round(avg(score), 6) AS mean_score, round(max(score), 6) AS max_score"
        " FROM grid GROUP BY alpha",
        _GRID,
    ),
)
def _(s):
    grid = smoothed_risk_grid(train_of(s), take_split(s.parted, "validation"), ALPHAS, "score")
    return ranking.score_spread(grid, "score")


@register(
    "baseline_by_period",
    over_scored(
        f"SELECT *, 'validation' AS period FROM ({_policy_sql('smoothed', SMOOTHED, 'validation')})"
        f" UNION ALL SELECT *, 'test' FROM ({_policy_sql('smoothed', SMOOTHED, 'test')})"
    ),
)
def _(s):
    periods = [
        ranking.policy_at_k(scored(s, p), SMOOTHED, "smoothed", CAPACITIES, *IDS).withColumn("period", F.lit(p))
        for p in ("validation", "test")
    ]
    return periods[0].unionByName(periods[1])


@register(
    "topk_snapshots",
    over_scored(
        f"SELECT camis, cutoff_inspection_id, round({SMOOTHED}, 6) AS {SMOOTHED}, place AS rank"
        f" FROM (SELECT *, {_place(SMOOTHED, 'place')} FROM test) WHERE place <= 100"
    ),
)
def _(s):
    return ranking.ranked_top(scored(s), SMOOTHED, 100, *IDS).select(*IDS, SMOOTHED, "rank")


@register(
    "queue_overlap",
    over_scored(
        "SELECT capacity, count(*) FILTER (a <= capacity) AS a_queue_size, count(*) FILTER (b <= capacity) AS b_queue_size,"
        " count(*) FILTER (a <= capacity AND b <= capacity) AS overlap,"
        " round(count(*) FILTER (a <= capacity AND b <= capacity) / CAST(capacity AS DOUBLE), 6) AS overlap_rate,"
        " count(*) FILTER (b <= capacity AND a > capacity) AS b_only, count(*) FILTER (a <= capacity AND b > capacity) AS a_only"
        f" FROM {KS}, (SELECT camis, min(a) AS a, min(b) AS b FROM"
        f" (SELECT camis, {_place(SMOOTHED, 'a')}, {_place(FITTED, 'b')} FROM test) GROUP BY camis) GROUP BY capacity"
    ),
)
def _(s):
    return ranking.queue_overlap(scored(s), SMOOTHED, FITTED, CAPACITIES, *IDS)


@register(
    "only_in_b_queue",
    over_scored(
        f"SELECT camis, cutoff_inspection_id, target_high_severity, round({SMOOTHED}, 6) AS {SMOOTHED}, round({FITTED}, 6) AS {FITTED}"
        " FROM test WHERE camis IN (SELECT camis FROM places WHERE b <= 100) AND camis NOT IN (SELECT camis FROM places WHERE a <= 100)",
        f"places AS (SELECT camis, {_place(SMOOTHED, 'a')}, {_place(FITTED, 'b')} FROM test)",
    ),
)
def _(s):
    return ranking.only_in_b(scored(s), SMOOTHED, FITTED, 100, *IDS).select(*IDS, "target_high_severity", SMOOTHED, FITTED)


@register(
    "policy_comparison",
    over_scored(
        "SELECT capacity, round(e, 6) AS random_expected_yield, a AS a_yield, b AS b_yield,"
        " round(a / CAST(capacity AS DOUBLE), 6) AS a_precision, round(b / CAST(capacity AS DOUBLE), 6) AS b_precision,"
        " b - a AS b_incremental_yield, round(a / e, 6) AS a_lift_vs_random, round(b / e, 6) AS b_lift_vs_random,"
        " round(b / CAST(a AS DOUBLE) - 1, 6) AS b_relative_improvement FROM (SELECT capacity,"
        " CAST(sum(y) FILTER (pa <= capacity) AS BIGINT) AS a, CAST(sum(y) FILTER (pb <= capacity) AS BIGINT) AS b,"
        " capacity * sum(y) / CAST(count(*) AS DOUBLE) AS e"
        f" FROM {KS}, (SELECT target_high_severity AS y, {_place(SMOOTHED, 'pa')}, {_place(FITTED, 'pb')} FROM test) GROUP BY capacity)"
    ),
)
def _(s):
    return ranking.policy_comparison(scored(s), SMOOTHED, FITTED, CAPACITIES, *IDS)


# --- metrics -----------------------------------------------------------------


def _metrics_sql(score: str, table: str, by: str = "") -> str:
    """Average precision from running sums, ROC-AUC from mid-ranks of the positives."""
    group, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    keys = f"GROUP BY {by}" if by else ""
    link = f"USING ({by})" if by else "ON true"
    return (
        f"SELECT {group}n, positives, prevalence, round(ap, 6) AS average_precision, round(auc, 6) AS roc_auc, brier_score"
        f" FROM (SELECT {group}count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS prevalence,"
        f" round(avg((s - y) * (s - y)), 6) AS brier_score,"
        " (sum(mid) FILTER (y = 1) - sum(y) * (sum(y) + 1) / CAST(2 AS DOUBLE)) / nullif(sum(y) * (count(*) - sum(y)), 0) AS auc"
        f" FROM (SELECT {group}y, s, rank() OVER ({part} ORDER BY s) + (count(*) OVER (PARTITION BY {group}s) - 1) / CAST(2 AS DOUBLE) AS mid"
        f" FROM (SELECT {group}target_high_severity AS y, CAST({score} AS DOUBLE) AS s FROM {table})) {keys})"
        f" JOIN (SELECT {group}sum(pos * cp / cn) / sum(pos) AS ap FROM (SELECT {group}pos,"
        f" sum(pos) OVER ({part} ORDER BY s DESC) AS cp, CAST(sum(m) OVER ({part} ORDER BY s DESC) AS DOUBLE) AS cn"
        f" FROM (SELECT {group}CAST({score} AS DOUBLE) AS s, CAST(sum(target_high_severity) AS DOUBLE) AS pos, count(*) AS m FROM {table} GROUP BY {group}s))"
        f" {keys}) {link}"
    )


@register("average_precision", over_scored(f"SELECT average_precision FROM ({_metrics_sql(SMOOTHED, 'test')})"))
def _(s):
    return metrics.ranking_metrics(scored(s), SMOOTHED).select("average_precision")


@register("roc_auc", over_scored(f"SELECT roc_auc FROM ({_metrics_sql(FITTED, 'test')})"))
def _(s):
    return metrics.ranking_metrics(scored(s), FITTED).select("roc_auc")


@register("brier", over_scored(f"SELECT round(avg(power({FITTED} - target_high_severity, 2)), 6) AS brier_score FROM test"))
def _(s):
    return metrics.brier_scores(scored(s), FITTED).select("brier_score")


@register("segment_metrics", over_scored(_metrics_sql(FITTED, "test", "history_depth_bucket")))
def _(s):
    return metrics.ranking_metrics(scored(s), FITTED, ["history_depth_bucket"])


@register(
    "segment_deltas",
    over_scored(
        "SELECT * , round(m_ap - b_ap, 6) AS average_precision_improvement FROM (SELECT a.history_depth_bucket, a.n, a.positives,"
        " a.average_precision AS b_ap, b.average_precision AS m_ap FROM"
        f" ({_metrics_sql(SMOOTHED, 'test', 'history_depth_bucket')}) a JOIN ({_metrics_sql(FITTED, 'test', 'history_depth_bucket')}) b"
        " USING (history_depth_bucket))"
    ),
)
def _(s):
    found = metrics.metric_deltas(scored(s), SMOOTHED, FITTED, ["history_depth_bucket"])
    b, m = F.round("baseline_average_precision", 6), F.round("model_average_precision", 6)
    return found.select(
        "history_depth_bucket", "n", "positives", b.alias("b_ap"), m.alias("m_ap"),
        (m - b).alias("average_precision_improvement"),
    )


_EDGES = ", ".join(f"CAST('{i * 0.1!r}' AS DOUBLE)" for i in range(1, 10))


@register(
    "calibration_curve",
    over_scored(
        f"SELECT CAST(len(list_filter([{_EDGES}], lambda e: e < {FITTED})) AS BIGINT) AS bin, count(*) AS n,"
        f" round(avg({FITTED}), 6) AS predicted_risk_bin_mean, round(avg(target_high_severity), 6) AS observed_high_severity_rate"
        " FROM test GROUP BY 1"
    ),
)
def _(s):
    return metrics.calibration_curve(scored(s), FITTED)


_KIND = (
    f"CASE WHEN {FITTED} >= 0.5 THEN if(target_high_severity = 1, 'True Positive', 'False Positive')"
    " ELSE if(target_high_severity = 1, 'False Negative', 'True Negative') END"
)


@register("confusion_counts", over_scored(f"SELECT {_KIND} AS error_type, count(*) AS n FROM test GROUP BY 1"))
def _(s):
    return metrics.confusion_counts(scored(s), FITTED)


def _worst(name: str, kind: str, broken: str, direction: str, threshold: float | None = None) -> None:
    @register(
        name,
        over_scored(
            f"SELECT camis, cutoff_inspection_id, cutoff_date, round({FITTED}, 6) AS {FITTED} FROM test WHERE {broken}"
            f" ORDER BY test.{FITTED} {direction}, camis, cutoff_inspection_id LIMIT 20"
        ),
    )
    def _(s):
        return metrics.worst_errors(scored(s), FITTED, kind, 20, threshold, *IDS).select(*IDS, "cutoff_date", FITTED)


_worst("false_positives", "false_positive", f"test.{FITTED} >= 0.5 AND target_high_severity = 0", "DESC")
_worst("false_negatives", "false_negative", f"test.{FITTED} < 0.5 AND target_high_severity = 1", "ASC")
_worst("confident_false_positives", "false_positive", f"test.{FITTED} >= 0.8 AND target_high_severity = 0", "DESC", 0.8)
_worst("confident_false_negatives", "false_negative", f"test.{FITTED} <= 0.2 AND target_high_severity = 1", "ASC", 0.2)


@register(
    "high_confidence_errors",
    over_scored(
        f"SELECT count(*) FILTER ({FITTED} >= 0.8 AND target_high_severity = 0) AS high_confidence_false_positives,"
        f" count(*) FILTER ({FITTED} <= 0.2 AND target_high_severity = 1) AS high_confidence_false_negatives FROM test"
    ),
)
def _(s):
    return metrics.high_confidence_errors(scored(s), FITTED)


@register(
    "score_sanity",
    over_scored(
        f"SELECT count(*) AS row_count, count({SMOOTHED}) AS score_count,"
        f" count(*) FILTER ({SMOOTHED} IS NULL OR {SMOOTHED} < 0 OR {SMOOTHED} > 1) AS bad_score_count FROM test"
    ),
)
def _(s):
    return metrics.score_sanity(scored(s), SMOOTHED)


_POINTS = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


@register(
    "describe_scores",
    over_scored(
        f"SELECT '{FITTED}' AS column_name, CAST(p AS DOUBLE) AS probability, round(v, 6) AS value FROM (SELECT"
        f" unnest([{', '.join(map(str, _POINTS))}]) AS p, unnest(quantile_cont({FITTED}, [{', '.join(map(str, _POINTS))}])) AS v FROM test)"
    ),
)
def _(s):
    from tidemark.operators.selection import exact_quantiles

    return exact_quantiles(scored(s), [FITTED], _POINTS)


# --- the current queue ---------------------------------------------------------

RAW_P, CAL_P = "raw_logistic_probability", "calibrated_high_severity_probability"
CONTEXT = ("camis", "restaurant_name", "borough", "cuisine_description", "cutoff_date", "history_depth_bucket")


def unranked_batch(s: Stages) -> DataFrame:
    population = s.scoring
    return population.select(
        *[c for c in CONTEXT if c in population.columns],
        fixed_probability().alias(RAW_P),
        fixed_probability(0.75, -0.25).alias(CAL_P),
    )


def batch(s: Stages) -> DataFrame:
    return global_rank(unranked_batch(s), F.desc_nulls_last(CAL_P), F.asc_nulls_last("camis"))


_BATCH = f"""
batch AS (
  SELECT *, row_number() OVER (ORDER BY {CAL_P} DESC, camis) AS priority_rank FROM (
    SELECT {', '.join(CONTEXT)},
      {fixed_sql()} AS {RAW_P}, {fixed_sql(0.75, -0.25)} AS {CAL_P}
    FROM scoring)
)"""


def over_batch(select: str) -> str:
    return over_stages(select, _BATCH)


_BATCH_OUT = f"* REPLACE (round({RAW_P}, 6) AS {RAW_P}, round({CAL_P}, 6) AS {CAL_P})"


@register("scored_population", over_batch(f"SELECT {_BATCH_OUT} FROM batch"))
def _(s):
    return batch(s)


@register("topk_queue", over_batch(f"SELECT {_BATCH_OUT} FROM batch WHERE priority_rank <= 100"))
def _(s):
    return ranking.priority_queue(unranked_batch(s), 100)


@register(
    "filtered_queue",
    over_batch(
        f"SELECT {_BATCH_OUT} FROM batch WHERE borough IN ('ASIA', 'AFRICA') AND cuisine_description = 'MACHINERY'"
        " ORDER BY priority_rank LIMIT 25"
    ),
)
def _(s):
    return ranking.filtered_queue(batch(s), 25, ["ASIA", "AFRICA"], ["MACHINERY"])


@register(
    "search_entities",
    over_batch(
        f"SELECT {_BATCH_OUT} FROM batch WHERE contains(lower(coalesce(restaurant_name, '')), '77')"
        " OR contains(camis, '77') ORDER BY priority_rank LIMIT 25"
    ),
)
def _(s):
    return ranking.search_entities(batch(s), " 77 ", 25)


@register(
    "display_scores",
    over_batch(
        f"SELECT camis, CASE WHEN {CAL_P} >= 0.7 THEN 'risk-high' WHEN {CAL_P} >= 0.4 THEN 'risk-medium' ELSE 'risk-low' END AS tier,"
        f" printf('%.1f%%', {CAL_P} * 100) AS shown FROM batch"
    ),
)
def _(s):
    return unranked_batch(s).select("camis", risk_tier(F.col(CAL_P)).alias("tier"), percent_text(F.col(CAL_P)).alias("shown"))


@register(
    "monitoring_metrics",
    over_batch(
        f"SELECT count(*) AS prediction_count, round(avg({CAL_P}), 6) AS prediction_mean, round(min({CAL_P}), 6) AS prediction_min,"
        f" round(max({CAL_P}), 6) AS prediction_max, round(median({CAL_P}), 6) AS prediction_median,"
        f" round(avg(({CAL_P} >= 0.5)::INT), 6) AS high_risk_rate_0_50, round(avg(({CAL_P} >= 0.75)::INT), 6) AS high_risk_rate_0_75,"
        f" count(DISTINCT camis) AS unique_restaurants, round(any_value({CAL_P}) FILTER (priority_rank = 1), 6) AS top_rank_probability FROM batch"
    ),
)
def _(s):
    return profile.monitoring_metrics(batch(s))


@register(
    "category_shares",
    over_batch(
        "SELECT coalesce(history_depth_bucket, 'missing') AS category,"
        " round(count(*) / CAST((SELECT count(*) FROM batch) AS DOUBLE), 6) AS share FROM batch GROUP BY 1"
    ),
)
def _(s):
    return profile.category_shares(unranked_batch(s))


for _c in ("borough", "cuisine_description"):

    def _values(column: str) -> None:
        @register(f"distinct_{column}", over_stages(f"SELECT DISTINCT {column} FROM scoring WHERE {column} IS NOT NULL"))
        def _(s):
            return ranking.distinct_values(s.scoring, column)

    _values(_c)


@register(
    "usable_scores",
    over_batch(
        f"SELECT camis, priority_rank, round({CAL_P}, 6) AS {CAL_P} FROM batch"
        " WHERE priority_rank % 7 <> 0 AND borough IS NOT NULL"
    ),
)
def _(s):
    """Scores as text with unreadable ranks and missing probabilities."""
    text = batch(s).select(
        "camis",
        F.when(F.col("priority_rank") % 7 == 0, "n/a").otherwise(F.col("priority_rank").cast("string")).alias("priority_rank"),
        F.when(F.col("borough").isNotNull(), F.col(CAL_P).cast("string")).alias(CAL_P),
    )
    return usable_scores(text)


@register(
    "raw_vs_calibrated_topn",
    over_stages(
        "SELECT capacity, CAST(sum(y) FILTER (a <= capacity) AS BIGINT) AS raw_yield,"
        " CAST(sum(y) FILTER (b <= capacity) AS BIGINT) AS calibrated_yield,"
        " round(sum(y) FILTER (a <= capacity) / CAST(capacity AS DOUBLE), 6) AS raw_precision,"
        " round(sum(y) FILTER (b <= capacity) / CAST(capacity AS DOUBLE), 6) AS calibrated_precision"
        f" FROM {KS}, (SELECT target_high_severity AS y, {_place('raw_p', 'a')}, {_place('cal_p', 'b')} FROM (SELECT *,"
        f" {fixed_sql()} AS raw_p, {fixed_sql(0.75, -0.25)} AS cal_p FROM test))"
        " GROUP BY capacity",
        _SCORED,
    ),
)
def _(s):
    both = scored(s).withColumn("cal_p", fixed_probability(0.75, -0.25))
    found = ranking.policy_comparison(both, FITTED, "cal_p", CAPACITIES, *IDS)
    return found.select(
        "capacity", F.col("a_yield").alias("raw_yield"), F.col("b_yield").alias("calibrated_yield"),
        F.col("a_precision").alias("raw_precision"), F.col("b_precision").alias("calibrated_precision"),
    )


@register(
    "flagship_queue",
    over_scored(
        "SELECT camis, cutoff_inspection_id, cutoff_date, target_high_severity, history_depth_bucket, borough,"
        f" round({SMOOTHED}, 6) AS {SMOOTHED}, place AS rank FROM (SELECT *, {_place(SMOOTHED, 'place')} FROM test) WHERE place <= 100"
    ),
    from_raw=True,
)
def _(s):
    """Raw rows to snapshots to smoothed risk to the 100 best of the test period."""
    top = ranking.ranked_top(scored(s), SMOOTHED, 100, *IDS)
    return top.select(*IDS, "cutoff_date", "target_high_severity", "history_depth_bucket", "borough", SMOOTHED, "rank")

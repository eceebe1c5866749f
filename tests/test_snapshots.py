import datetime as dt
import random

from helpers import AGAIN, INITIAL, event_rows
from pyspark.sql import functions as F

from tidemark.operators import snapshots as sn

DAY = dt.timedelta(days=1)


def by_cutoff(df):
    return {r["cutoff_inspection_id"]: r for r in df.collect()}


def test_same_day_peers_are_history_but_never_targets(spark):
    events = event_rows(
        spark,
        [("a", "1", "2024-01-01", INITIAL, 3, 10), ("b", "1", "2024-01-01", AGAIN, 0, 20), ("c", "1", "2024-02-01", INITIAL, 1, 5)],
    )
    found = by_cutoff(sn.decision_snapshots(events))
    assert set(found) == {"a", "b"}
    for row in found.values():
        assert row["target_inspection_id"] == "c"
        assert row["prior_cycle_inspection_count"] == 2
        assert row["average_historical_score"] == 15.0


def test_last_event_has_no_snapshot_yet_stays_in_history(spark):
    events = event_rows(
        spark,
        [("a", "1", "2024-01-01", INITIAL, 0, 1), ("b", "1", "2024-01-05", INITIAL, 0, 1), ("c", "1", "2024-01-09", AGAIN, 4, 1)],
    )
    assert set(by_cutoff(sn.prediction_population(events))) == {"a"}
    entities = spark.createDataFrame([("1",)], "camis string").select(
        "camis", *[F.lit(None).cast("string").alias(c) for c in ("restaurant_name", *sn.DIMENSIONS)]
    )
    current = sn.current_population(events, entities).first()
    assert current["prior_cycle_inspection_count"] == 3 and current["prior_high_severity_inspection_count"] == 1


def test_trailing_window_is_inclusive(spark):
    events = event_rows(
        spark,
        [("out", "1", "2023-01-01", INITIAL, 0, 1), ("edge", "1", "2023-01-02", INITIAL, 0, 1),
         ("cut", "1", "2024-01-02", INITIAL, 0, 1), ("next", "1", "2024-03-01", INITIAL, 0, 1)],
    )
    assert by_cutoff(sn.decision_snapshots(events))["cut"]["cycle_inspections_last_365d"] == 2


def test_reinspection_only_entity_is_limited(spark):
    events = event_rows(spark, [("a", "1", "2024-01-01", AGAIN, 0, 1)])
    entities = spark.createDataFrame([("1",)], "camis string").select(
        "camis", *[F.lit(None).cast("string").alias(c) for c in ("restaurant_name", *sn.DIMENSIONS)]
    )
    row = sn.current_population(events, entities).first()
    assert row["history_depth_bucket"] == "0"
    assert row["scoring_eligibility_reason"] == "limited_cycle_initial_history"


def test_label_ladder(spark):
    events = event_rows(
        spark, [("a", "1", "2024-01-01", INITIAL, 0, 1), ("b", "1", "2024-02-01", INITIAL, 2, 1), ("c", "1", "2024-03-01", INITIAL, 3, 1)]
    )
    found = by_cutoff(sn.labels_of(sn.decision_snapshots(events)))
    assert (found["a"]["target_two_or_more_critical"], found["a"]["target_high_severity"]) == (1, 0)
    assert (found["b"]["target_high_severity"], found["b"]["target_four_or_more_critical"]) == (1, 0)
    assert found["b"]["target_label"] == "high_severity_critical_outcome"


def random_events(seed, entities=6, hot=80):
    rng = random.Random(seed)
    rows, seen = [], set()
    for e in range(entities):
        for i in range(hot if e == 0 else 12):
            day = dt.date(2020, 1, 1) + DAY * rng.randrange(1500)
            kind = rng.choice([INITIAL, INITIAL, AGAIN, "Other"])
            if (e, day, kind) not in seen:
                seen.add((e, day, kind))
                rows.append((f"{e}-{i}", str(e), day.isoformat(), kind, rng.randrange(6), rng.choice([None, 5, 9, 20])))
    return rows


def test_windows_equal_brute_force(spark):
    rows = random_events(7)
    found = by_cutoff(sn.decision_snapshots(event_rows(spark, rows)))
    parsed = [(i, c, dt.date.fromisoformat(d), k, n, s) for i, c, d, k, n, s in rows]
    eligible = [r for r in parsed if r[3] != "Other"]
    expected = {}
    for i, c, d, *_ in eligible:
        later = sorted((r[2], r[0]) for r in parsed if r[1] == c and r[2] > d and r[3] == INITIAL)
        if not later:
            continue
        past = [r for r in eligible if r[1] == c and r[2] <= d]
        fresh = [r for r in past if r[2] >= d - 365 * DAY]
        scores = [r[5] for r in fresh if r[5] is not None]
        severe = [r[2] for r in past if r[4] >= 3]
        expected[i] = (
            later[0][1], len(past), sum(r[4] for r in past), sum(r[4] + 1 for r in past), len(fresh),
            sum(r[4] for r in fresh), sum(scores) / len(scores) if scores else None,
            (d - max(severe)).days if severe else None,
        )
    got = {
        i: (r["target_inspection_id"], r["prior_cycle_inspection_count"], r["prior_critical_violation_count"],
            r["prior_total_violations"], r["cycle_inspections_last_365d"], r["critical_violations_last_365d"],
            r["average_score_last_365d"], r["days_since_last_high_severity_inspection"])
        for i, r in found.items()
    }
    assert got == expected


def test_join_form_agrees(spark):
    events = event_rows(spark, random_events(11))
    population = sn.prediction_population(events)
    joined = sn.attach_labels(population, events)
    windowed = sn.labels_of(sn.decision_snapshots(events))
    assert joined.exceptAll(windowed).count() == 0 and windowed.exceptAll(joined).count() == 0


def test_one_shuffle_on_the_entity(spark):
    plan = sn.decision_snapshots(event_rows(spark, random_events(3)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(camis") == 1
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan

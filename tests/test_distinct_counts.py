"""Distinct counts of several columns: values, NULLs, empty tables, and plans that copy no row."""

import datetime as dt
import random

from tidemark.operators import profile
from tidemark.operators.profile import TARGET

SCHEMA = (
    "camis string, cutoff_inspection_id string, target_inspection_id string, cutoff_date date,"
    f" target_inspection_date date, {TARGET} int, days_to_target int"
)


def examples(spark, n, seed=5):
    draw = random.Random(seed)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(draw.randrange(900))
    some = lambda k: draw.choice([None, *(str(v) for v in range(k))])
    rows = [(some(7), some(90), some(40), day(), day(), draw.randrange(2), draw.randrange(1, 500)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cardinality_counts_null_once(spark):
    rows, df = examples(spark, 300)
    names = ["camis", "cutoff_inspection_id", "target_inspection_id"]
    found = {r.column_name: r.unique_values for r in profile.cardinality(df, names).collect()}
    assert found == {c: len({r[k] for r in rows}) for k, c in enumerate(names)}
    empty = profile.cardinality(df.limit(0), names).collect()
    assert [r.unique_values for r in empty] == [0, 0, 0]


def test_dataset_card_counts_ids(spark):
    rows, df = examples(spark, 300)
    found = {r.metric: r.value for r in profile.dataset_card(df).collect()}
    for k, name in enumerate(("unique_restaurants", "unique_cutoff_inspections", "unique_target_inspections")):
        assert found[name] == str(len({r[k] for r in rows} - {None}))
    assert found["prediction_examples"] == "300" and found["high_severity_positives"] == str(sum(r[5] for r in rows))


def test_no_row_is_copied_per_column(spark):
    _, df = examples(spark, 30)
    for counted in (profile.cardinality(df, ["camis", "cutoff_inspection_id"]), profile.dataset_card(df)):
        assert "Expand" not in plan(counted)

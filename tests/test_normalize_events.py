import os
import datetime as dt

import pytest
from helpers import AGAIN, INITIAL, raw_rows
from pyspark.sql import functions as F

from tidemark.operators.events import distinct_violations, latest_entities, roll_up_events, roll_up_feed, violation_rows
from tidemark.operators.normalize import dedup_audit, deduplicate, normalize_rows, row_digest
from tidemark.sources.raw_log import read_raw_csv
from tidemark.sources.stage_store import StageStore


def one(spark, **cells):
    return normalize_rows(raw_rows(spark, [{"CAMIS": "1", **cells}])).first()


def test_blank_text_is_null(spark):
    row = one(spark, DBA="  ", BORO=" Queens ")
    assert row["restaurant_name"] is None and row["borough"] == "Queens"


@pytest.mark.parametrize(
    ("text", "flag"),
    [(" CRITICAL ", "Critical"), ("not critical", "Not Critical"), ("Not Applicable", "Not Applicable"),
     ("", None), (None, None), ("weird", "Unexpected")],
)
def test_flag_variants(spark, text, flag):
    assert one(spark, **{"CRITICAL FLAG": text})["critical_flag"] == flag


@pytest.mark.parametrize(
    ("text", "day"),
    [("06/27/2024", dt.date(2024, 6, 27)), ("6/7/2024", dt.date(2024, 6, 7)), ("2024-06-27", dt.date(2024, 6, 27)),
     ("junk", None), ("13/45/2024", None), ("", None)],
)
def test_date_spellings(spark, text, day):
    assert one(spark, **{"INSPECTION DATE": text})["inspection_date"] == day


@pytest.mark.parametrize(
    ("text", "score"),
    [("12", 12), ("12.5", 13), ("-12.5", -13), (" 12 ", 12), ("1e2", 100), ("12d", None), ("abc", None),
     ("99999999999", None), ("", None)],
)
def test_score_cast(spark, text, score):
    assert one(spark, SCORE=text)["score"] == score


def test_exact_duplicates_collapse_and_audit(spark):
    rows = normalize_rows(raw_rows(spark, [{"CAMIS": "1", "DBA": "A"}, {"CAMIS": "1", "DBA": "A "}]))
    assert deduplicate(rows).count() == 1
    assert dedup_audit(rows).first().asDict() == {
        "input_row_count": 2, "output_row_count": 1, "exact_duplicates_removed": 1,
    }


def test_sentinel_rows_stay_out_of_events(spark):
    rows = normalize_rows(
        raw_rows(spark, [{"CAMIS": "1", "INSPECTION DATE": "01/01/1900", "VIOLATION CODE": "04L"}])
    )
    assert rows.first()["inspection_date"] == dt.date(1900, 1, 1)
    assert roll_up_events(rows).count() == 0 and violation_rows(rows).count() == 0


def test_event_without_codes(spark):
    rows = normalize_rows(raw_rows(spark, [{"CAMIS": "1", "INSPECTION DATE": "1/2/2024"}]))
    event = roll_up_events(rows).first()
    assert (event["inspection_type"], event["total_violations"], event["has_any_violation"]) == ("UNKNOWN", 0, False)
    assert violation_rows(rows).count() == 0


def test_roll_up_counts(spark):
    base = {"CAMIS": "1", "INSPECTION DATE": "1/2/2024", "INSPECTION TYPE": INITIAL}
    rows = normalize_rows(
        raw_rows(
            spark,
            [
                base | {"VIOLATION CODE": "a", "CRITICAL FLAG": "Critical", "SCORE": "10", "GRADE": "A"},
                base | {"VIOLATION CODE": "b", "CRITICAL FLAG": "Critical", "SCORE": "12", "GRADE": "A"},
                base | {"CRITICAL FLAG": "Critical", "SCORE": "12"},
                base | {"VIOLATION CODE": "c", "CRITICAL FLAG": "Not Critical"},
            ],
        )
    )
    e = roll_up_events(rows).first()
    assert (e["source_row_count"], e["total_violations"], e["critical_violation_count"]) == (4, 3, 3)
    assert (e["coded_critical_count"], e["noncritical_violation_count"]) == (2, 1)
    assert (e["score"], e["grade"], e["distinct_score_count"], e["distinct_grade_count"]) == (12, "A", 2, 1)
    assert e["is_cycle_initial"] and e["is_eligible_target_event"] and not e["is_cycle_reinspection"]
    ids = {r["inspection_id"] for r in violation_rows(rows).collect()}
    assert ids == {e["inspection_id"]}


def test_latest_row_is_deterministic_on_hash_ties(spark):
    same = {"CAMIS": "1", "INSPECTION DATE": "1/2/2024", "RECORD DATE": "1/3/2024", "DBA": "X"}
    rows = [same | {"STREET": street} for street in ("Z st", "A st", "M st")]
    older = same | {"INSPECTION DATE": "1/1/2024", "STREET": "0 st"}
    for order in (rows, rows[::-1]):
        found = latest_entities(normalize_rows(raw_rows(spark, [older, *order]))).collect()
        assert [(r["camis"], r["street"]) for r in found] == [("1", "A st")]


def test_hot_event_is_pruned_before_the_shuffle(spark):
    rows = normalize_rows(raw_rows(spark, [{"CAMIS": "1", "INSPECTION DATE": "1/2/2024"}]))
    plan = latest_entities(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_csv_scan_keeps_text(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = [{"CAMIS": "007", "DBA": 'Joe "The" Grill, Inc', "ZIPCODE": "01234", "SCORE": "9"}]
    raw_rows(spark, rows).write.option("header", True).option("escape", '"').csv(path)
    back = read_raw_csv(spark, path).first()
    assert (back["CAMIS"], back["DBA"], back["ZIPCODE"]) == ("007", 'Joe "The" Grill, Inc', "01234")
    raw_rows(spark, rows).drop("BORO").write.option("header", True).csv(path + "2")
    with pytest.raises(ValueError, match="BORO"):
        read_raw_csv(spark, path + "2")


def test_types(spark):
    kinds = dict(normalize_rows(raw_rows(spark, [{"CAMIS": "1"}])).dtypes)
    assert kinds["score"] == "int" and kinds["inspection_date"] == "date" and kinds["latitude"] == "double"
    assert dict(raw_rows(spark, []).select(F.col("`CUISINE DESCRIPTION`")).dtypes) == {"CUISINE DESCRIPTION": "string"}


def test_files_of_a_feed_share_one_header(spark, tmp_path):
    from tidemark.sources.raw_log import RAW_COLUMNS

    for name, columns in (("a", RAW_COLUMNS), ("b", RAW_COLUMNS), ("c", RAW_COLUMNS[::-1])):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.csv").write_text(",".join(columns) + "\n" + ",".join(f"{name}-{c}" for c in columns) + "\n")
    same = read_raw_csv(spark, f"{tmp_path}/[ab]")
    assert sorted(r["CAMIS"] for r in same.collect()) == ["a-CAMIS", "b-CAMIS"]
    assert read_raw_csv(spark, f"{tmp_path}/c").first()["Location"] == "c-Location"
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"{tmp_path}/[ac]").collect()


def test_a_quoted_line_break_goes_through_the_job(spark, tmp_path):
    from tidemark.plans import jobs
    from tidemark.policy import EventPolicy
    from tidemark.sources.raw_log import RAW_COLUMNS

    for column in ("DBA", "Location"):
        folder = tmp_path / column
        folder.mkdir()
        cell = lambda name: f'"{name}\n2"' if name == column else f'"5"" {name}"'  # noqa: E731, B023
        lines = [",".join(RAW_COLUMNS), ",".join(map(cell, RAW_COLUMNS)), ",".join(RAW_COLUMNS[:5])]
        (folder / "feed.csv").write_text("\n".join(lines) + "\n")
        root = str(tmp_path / f"root-{column}")
        ingest = lambda multi_line: jobs._ingest(spark, str(folder), root, "i", EventPolicy(), False, None, multi_line)  # noqa: E731, B023
        with pytest.raises(ValueError, match="open quote"):
            ingest(False)
        assert not os.path.exists(f"{root}/stages/current.json")
        whole = ingest(True)["raw_inspection"].collect()
        assert len(whole) == 2 and f"{column}\n2" in [r[column] for r in whole]
        (folder / "feed.csv").write_text("\n".join([lines[0], lines[2], lines[0]]) + "\n")
        assert ingest(False)["raw_inspection"].count() == 2


def shuffled(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_events_and_details_of_rows_with_copies_need_no_wide_shuffle(spark):
    """Copies count once, NULLs and blanks stay apart, and the rows move once, without the columns no event needs."""
    base = {"CAMIS": "1", "INSPECTION DATE": "6/7/2024", "INSPECTION TYPE": INITIAL, "VIOLATION CODE": "10F", "CRITICAL FLAG": "Critical", "SCORE": "12"}
    rows = [base, base, dict(base, DBA="a"), dict(base, PHONE="a"), dict(base, Latitude="0"), dict(base, Latitude="-0.0"), dict(base, NTA="a|1:b")]
    rows += [dict(base, NTA="a", Location="b"), dict(base, GRADE="A", SCORE="7"), dict(base, **{"VIOLATION CODE": ""}), dict(base, **{"INSPECTION TYPE": None})]
    rows += [dict(base, **{"INSPECTION DATE": "01/01/1900"}), dict(base, CAMIS=None), {"CAMIS": "2", "INSPECTION DATE": "2024-06-07"}] * 2
    typed = normalize_rows(raw_rows(spark, rows))
    unique = deduplicate(typed)
    events = roll_up_feed(typed)
    assert sorted(map(str, events.collect())) == sorted(map(str, roll_up_events(unique).collect()))
    details = violation_rows(distinct_violations(typed))
    assert sorted(map(str, details.collect())) == sorted(map(str, violation_rows(unique).collect()))
    events = roll_up_feed(typed)
    assert shuffled(events) == 1
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert "_row" in plan and "restaurant_name" not in plan.split("RepartitionByExpression")[0]


def test_a_digest_tells_nulls_columns_and_long_rows_apart(spark):
    names = [f"c{k}" for k in range(70)]
    rows = [[None] * 70 for _ in range(6)]
    rows[1][0], rows[2][1], rows[3][65], rows[4][66] = "a", "a", "a", "a"
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    digest = row_digest(df)
    assert df.select(*digest.values()).distinct().count() == 5
    zeros = spark.createDataFrame([(0.0, None), (-0.0, None), (None, 0.0)], "a double, b double")
    assert zeros.select(*row_digest(zeros).values()).distinct().count() == 2


def test_dates_are_typed_once_and_filtered_after(spark):
    """The filter on the date is not put below the typing, where it would read the text of every row again."""
    typed = normalize_rows(raw_rows(spark, [{"CAMIS": "1", "INSPECTION DATE": "6/7/2024"}]))
    for df in (roll_up_feed(typed), distinct_violations(typed)):
        filters = [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
        assert any("isnotnull(inspection_date" in line for line in filters)
        assert not any("INSPECTION DATE" in line for line in filters)


def test_unique_rows_lie_by_event(spark):
    """Copies go in one exchange on the event, and the roll-up of what is stored finds an event's rows together."""
    days = [f"{m}/{d}/2024" for m in range(1, 13) for d in range(1, 21)]
    rows = [{"CAMIS": str(k % 7), "INSPECTION DATE": day, "SCORE": str(k)} for k, day in enumerate(days) for _ in range(2)]
    unique = deduplicate(normalize_rows(raw_rows(spark, rows * 2)).repartition(5))
    assert shuffled(unique) == 1 and unique.count() == len(days)
    text = unique._jdf.queryExecution().executedPlan().toString()
    exchange = next(line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert all(c in exchange for c in ("camis", "inspection_date", "inspection_type")) and "location" not in exchange


def test_flags_in_any_case(spark):
    from tidemark.functions import canonical_flag

    cells = [" CRITICAL ", "critical", "not Critical", "NOT APPLICABLE", "", "  ", None, "weird", "critical flag"]
    df = spark.createDataFrame([(c,) for c in cells], "f string").select(canonical_flag(F.col("f")).alias("f"))
    assert [r["f"] for r in df.collect()] == ["Critical", "Critical", "Not Critical", "Not Applicable", None, None, None, "Unexpected", "Unexpected"]


def test_stages_are_written_in_small_tasks(spark, tmp_path):
    """Exchange partitions no longer follow the session's few; afterwards its settings are as before."""
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n, None) for n in names]
    store = StageStore(spark, str(tmp_path))
    store.write("wide", spark.range(200_000).select("id", F.concat(*[F.sha2(F.concat(F.lit(str(k)), F.col("id")), 256) for k in range(16)]).alias("text")).repartition("id"))
    assert len(list((tmp_path / "versions" / store.version / "wide").glob("*.parquet"))) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [spark.conf.get(n, None) for n in names] == before

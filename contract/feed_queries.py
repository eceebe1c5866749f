"""The feed with quoted line breaks, written as files and read split among tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.job_queries import _place
from contract.model_queries import LANDED_ROWS
from contract.oracle_tables import over_stages
from contract.queries import register
from tidemark.sources.raw_log import RAW_COLUMNS, read_raw_csv

_BROKEN = "CASE WHEN DBA LIKE '%7%' THEN DBA || chr(10) || '\"second\", line' ELSE DBA END"


@register(
    "csv_quoted_breaks",
    over_stages(f'SELECT CAMIS AS camis, {_BROKEN} AS dba, "INSPECTION DATE" AS day, count(*) AS n FROM raw GROUP BY ALL'),
)
def _(s):
    path = _place(s, "quoted")
    changed = s.raw.withColumn("DBA", F.expr(_BROKEN.replace('"second"', '\\"second\\"')))
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "header": True, "escape": '"'}
    keep |= {"compression": "gzip", "maxRecordsPerFile": LANDED_ROWS}
    changed.write.options(**keep).csv(path)
    rows = read_raw_csv(s.spark, path, multi_line=True)
    assert rows.columns == list(RAW_COLUMNS)
    return rows.groupBy(F.col("CAMIS").alias("camis"), F.col("DBA").alias("dba"), F.col("`INSPECTION DATE`").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )

"""The driver's order tables read as a violation-grain feed.

An order is an event of its customer, a line item a cited violation.  The tables
are clean, so fixed expressions on their columns add what real feeds contain:
blank and padded text, mixed date spellings, junk, sentinel dates, flag variants,
exact copies.  `RAW_SQL` states the same view for the oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.policy import SplitBounds
from tidemark.sources.raw_log import RAW_COLUMNS

BOUNDS = SplitBounds(
    start=dt.date(1995, 1, 1), validation=dt.date(1999, 1, 1), test=dt.date(2000, 1, 1), end=dt.date(2002, 1, 1)
)

# Header -> expression that Spark SQL and the oracle's SQL read alike.
# `day_iso`, `day_padded`, `day_bare` are the three spellings of the order date.
_FEED = {
    "CAMIS": "CAST(o_custkey AS {text})",
    "DBA": "CASE WHEN o_orderkey % 83 = 0 THEN '  ' WHEN o_orderkey % 5 = 0 THEN ' ' || c_name || ' ' ELSE c_name END",
    "BORO": "CASE WHEN o_custkey % 41 = 0 THEN '' ELSE r_name END",
    "BUILDING": "CAST(o_custkey % 1000 AS {text})",
    "STREET": "n_name || ' AVE ' || CAST(coalesce(l_suppkey, 0) % 7 AS {text})",
    "ZIPCODE": "lpad(CAST(o_custkey % 90000 + 10000 AS {text}), 5, '0')",
    "PHONE": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE '555' || lpad(CAST(o_custkey % 10000000 AS {text}), 7, '0') END",
    "CUISINE DESCRIPTION": "CASE WHEN o_custkey % 37 = 0 THEN ' ' ELSE c_mktsegment END",
    "INSPECTION DATE": (
        "CASE WHEN o_orderkey % 97 = 0 THEN '01/01/1900' WHEN o_orderkey % 101 = 0 THEN 'junk'"
        " WHEN o_orderkey % 3 = 0 THEN day_iso WHEN o_orderkey % 3 = 1 THEN day_padded ELSE day_bare END"
    ),
    "ACTION": "CASE WHEN o_orderkey % 59 = 0 THEN '' ELSE o_orderstatus END",
    "VIOLATION CODE": "CASE WHEN l_partkey % 53 = 0 THEN '' ELSE CAST(l_partkey AS {text}) END",
    "VIOLATION DESCRIPTION": "'line status ' || l_linestatus",
    "CRITICAL FLAG": (
        "CASE WHEN l_partkey % 61 = 0 THEN '' WHEN l_partkey % 211 = 0 THEN 'weird'"
        " WHEN l_returnflag = 'R' THEN ' CRITICAL ' WHEN l_returnflag = 'A' THEN 'not critical'"
        " WHEN l_returnflag = 'N' THEN 'Not Applicable' END"
    ),
    "SCORE": (
        "CASE WHEN l_suppkey % 19 = 0 THEN 'abc' WHEN l_suppkey % 17 = 0 THEN CAST(CAST(l_quantity AS INT) AS {text}) || '.5'"
        " WHEN l_suppkey % 5 = 0 THEN ' ' || CAST(CAST(l_quantity AS INT) AS {text}) || ' '"
        " ELSE CAST(CAST(l_quantity AS INT) AS {text}) END"
    ),
    "GRADE": "CASE WHEN l_partkey % 7 = 0 THEN '' ELSE l_linestatus END",
    "GRADE DATE": "CASE WHEN l_returnflag = 'A' THEN ship_iso END",
    "RECORD DATE": "CASE WHEN l_partkey % 2 = 0 THEN ship_iso ELSE ship_bare END",
    "INSPECTION TYPE": (
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL"
        " WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Cycle Inspection / Initial Inspection'"
        " WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'Cycle Inspection / Re-inspection'"
        " ELSE 'Pre-permit (Operational) / Initial Inspection' END"
    ),
    "Latitude": "CASE WHEN o_custkey % 71 = 0 THEN 'n/a' ELSE CAST(CAST(40 AS DOUBLE) + (o_custkey % 64) / CAST(64 AS DOUBLE) AS {text}) END",
    "Longitude": "CAST(CAST(-74 AS DOUBLE) - (o_custkey % 32) / CAST(32 AS DOUBLE) AS {text})",
    "Community Board": "CAST(n_nationkey + 100 AS {text})",
    "Council District": "CASE WHEN o_custkey % 29 <> 0 THEN CAST(r_regionkey + 1 AS {text}) END",
    "Census Tract": "CAST(n_nationkey * 100 AS {text})",
    "BIN": "CAST(o_custkey + 1000000 AS {text})",
    "BBL": "CAST(o_custkey + 3000000000 AS {text})",
    "NTA": "n_name",
    "Location": "CASE WHEN o_custkey % 23 = 0 THEN ' ' ELSE 'POINT (' || n_name || ')' END",
}

assert tuple(_FEED) == RAW_COLUMNS


def _columns(text: str) -> str:
    return ",\n  ".join(f'{expr.format(text=text)} AS "{name}"' for name, expr in _FEED.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Columns of the joined order tables that the feed is made of.
_JOINED = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment", "n_nationkey", "n_name",
    "r_regionkey", "r_name", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate",
)


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customers and lines, one row per line; an order without lines has one row.

    Orders meet their customers before their lines, so only orders move for it.  Orders and lines
    are both large at scale, so they meet in a sort-merge join; as an inner join AQE may split a
    hot order.  Orders without lines follow from an anti join against the distinct keys.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("c_custkey = o_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("n_nationkey = c_nationkey"))
        .join(table(spark, sf_dir, "region"), F.expr("r_regionkey = n_regionkey"))
    )
    with_lines = orders.hint("merge").join(lines, F.expr("l_orderkey = o_orderkey"))
    without = orders.join(
        lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_anti"
    )
    return with_lines.unionByName(without, allowMissingColumns=True).select(*_JOINED)


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows of the feed."""
    return as_feed(joined_orders(spark, sf_dir))


def as_feed(joined: DataFrame) -> DataFrame:
    """Text rows of the feed.  Lines of parts divisible by 13 come twice."""
    day, ship = F.col("o_orderdate"), F.col("l_shipdate")
    dated = joined.withColumns(
        {
            "day_iso": F.date_format(day, "yyyy-MM-dd"),
            "day_padded": F.date_format(day, "MM/dd/yyyy"),
            "day_bare": F.date_format(day, "M/d/yyyy"),
            "ship_iso": F.date_format(ship, "yyyy-MM-dd"),
            "ship_bare": F.date_format(ship, "M/d/yyyy"),
        }
    )
    feed = dated.select(
        *[F.expr(expr.format(text="STRING")).alias(name) for name, expr in _FEED.items()],
        F.when(F.col("l_partkey") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("_copies"),
    )
    return feed.withColumn("_copy", F.explode("_copies")).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


RAW_SQL = f"""
joined AS (
  SELECT *,
    strftime(o_orderdate, '%Y-%m-%d') AS day_iso,
    strftime(o_orderdate, '%m/%d/%Y') AS day_padded,
    strftime(o_orderdate, '%-m/%-d/%Y') AS day_bare,
    strftime(l_shipdate, '%Y-%m-%d') AS ship_iso,
    strftime(l_shipdate, '%-m/%-d/%Y') AS ship_bare
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
twofold AS (
  SELECT * FROM joined UNION ALL SELECT * FROM joined WHERE l_partkey % 13 = 0
),
raw AS MATERIALIZED (
  SELECT {_columns("VARCHAR")}
  FROM twofold
)"""

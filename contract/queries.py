"""The registry: name -> (query over the driver tables, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.stages import Stages, StoredStages

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Query, str | None]] = {}


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so sums taken in another order still compare equal."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def register(name: str, sql: str | None = None, from_raw: bool = False):
    """Add a function of the stages under `name`; its doubles are rounded to six places.

    `from_raw` computes every stage within the query; otherwise it reads stored ones.
    """
    stages = Stages if from_raw else StoredStages

    def add(build: Callable[[Stages], DataFrame]):
        REGISTRY[name] = (lambda spark, sf_dir: rounded(build(stages(spark, sf_dir))), sql)
        return build

    return add


def sql_rounded(select: str, doubles: list[str]) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in doubles)}) FROM ({select})"

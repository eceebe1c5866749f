"""Stage DataFrames over the driver tables, for the registered queries."""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.raw_view import BOUNDS, as_feed, joined_orders, raw_view
from tidemark.operators import events, normalize, snapshots
from tidemark.operators.splits import assign_split
from tidemark.sources.tables import shared_folder, write_stage


class Stages:
    """Lazy stage tables; each is a plan, nothing is held or collected."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return raw_view(self.spark, self.sf_dir)

    @cached_property
    def rows(self) -> DataFrame:
        return normalize.normalize_rows(self.raw)

    @cached_property
    def unique(self) -> DataFrame:
        return normalize.deduplicate(self.rows)

    @cached_property
    def entities(self) -> DataFrame:
        """Exact copies cannot change the latest row, so this skips the dedup shuffle."""
        return events.latest_entities(self.rows)

    @cached_property
    def wide_events(self) -> DataFrame:
        """Copies go where the rows of an event meet, so only the columns events need are moved."""
        return events.roll_up_feed(self.rows)

    @cached_property
    def events(self) -> DataFrame:
        return self.wide_events.select(*events.EVENT_COLUMNS)

    @cached_property
    def violations(self) -> DataFrame:
        return events.violation_rows(events.distinct_violations(self.rows))

    @cached_property
    def snapshots(self) -> DataFrame:
        return snapshots.decision_snapshots(self.wide_events)

    @cached_property
    def population(self) -> DataFrame:
        return snapshots.prediction_population(self.wide_events)

    @cached_property
    def labels(self) -> DataFrame:
        return snapshots.labels_of(self.snapshots)

    @cached_property
    def features(self) -> DataFrame:
        return snapshots.features_of(self.snapshots, self.entities)

    @cached_property
    def scoring(self) -> DataFrame:
        latest = events.usable_rows(self.rows).agg(F.max("inspection_date"))
        return snapshots.current_population(self.wide_events, self.entities, as_of=latest)

    @cached_property
    def modeling(self) -> DataFrame:
        """Features and labels come out of the same window pass; no join is needed."""
        return snapshots.with_dimensions(self.snapshots, self.entities)

    @cached_property
    def parted(self) -> DataFrame:
        return assign_split(self.modeling, BOUNDS).where(F.col("split").isNotNull())


_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


class StoredStages(Stages):
    """Stage tables written once per Spark application and read back.

    This is how the jobs run: reports and checks read stored stages with their
    columns pruned, instead of repeating the work from the raw rows.  Tables go to
    the cluster's shared folder.
    """

    def _stored(self, name: str, df_of, key: str | None = None, placed: bool = True) -> DataFrame:
        application = self.spark.sparkContext.applicationId
        place = (application, self.sf_dir, name)
        if place not in _WRITTEN:
            tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:8]
            root = f"{shared_folder(self.spark)}/tidemark-{application}-{tag}"
            _WRITTEN[place] = write_stage(df_of(), root, name, key, placed)
        return _WRITTEN[place]

    @cached_property
    def rows(self) -> DataFrame:
        """The order tables meet once; their joined columns are stored, as the text rows made of them are far larger."""
        joined = self._stored("joined", lambda: joined_orders(self.spark, self.sf_dir))
        return normalize.normalize_rows(as_feed(joined))

    @cached_property
    def violations(self) -> DataFrame:
        return events.violation_rows(self._stored("coded_rows", lambda: events.distinct_violations(self.rows)))

    @cached_property
    def unique(self) -> DataFrame:
        return self._stored("unique", lambda: normalize.deduplicate(self.rows))

    @cached_property
    def entities(self) -> DataFrame:
        return self._stored("entities", lambda: events.latest_entities(self.rows), "camis", placed=False)

    @cached_property
    def wide_events(self) -> DataFrame:
        return self._stored("events", lambda: events.roll_up_feed(self.rows), "camis", placed=False)

    @cached_property
    def snapshots(self) -> DataFrame:
        return self._stored("snapshots", lambda: snapshots.decision_snapshots(self.wide_events), "camis")

    @cached_property
    def population(self) -> DataFrame:
        return snapshots.population_of(self.snapshots)

    @cached_property
    def scoring(self) -> DataFrame:
        return self._stored("scoring", lambda: snapshots.current_population(self.wide_events, self.entities), "camis")

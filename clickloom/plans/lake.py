"""The views on one folder of tables, with the costly ones built once per session."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from clickloom.operators.candidates import Lookups, catalog_of, lookups_of
from clickloom.operators.encode import is_train, target_mean, train_mean
from clickloom.operators.history import LOOK_BACKS
from clickloom.operators.models import Inputs
from clickloom.operators.prefix import ROWS_PER_CHAIN, Timeline, by_chunk
from clickloom.plans.gold import gold_table
from clickloom.plans.training import FITS, Model, fit_all
from clickloom.session import materialize, prepare
from clickloom.sources import bindings

_OPEN: dict[tuple[str, str], Lake] = {}


class Lake:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._models: dict[str, Model] = {}

    @classmethod
    def at(cls, spark: SparkSession, folder: str) -> Lake:
        prepare(spark)
        key = (spark.sparkContext.applicationId, folder)
        if key not in _OPEN:
            _OPEN[key] = cls(spark, folder)
        return _OPEN[key]

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.folder, name)

    @property
    def imp(self) -> DataFrame:
        return bindings.impressions(self.spark, self.folder)

    @property
    def ads(self) -> DataFrame:
        return bindings.ads(self.spark, self.folder)

    @property
    def users(self) -> DataFrame:
        return bindings.users(self.spark, self.folder)

    @property
    def star(self) -> DataFrame:
        return bindings.star(self.spark, self.folder)

    @property
    def dirty(self) -> DataFrame:
        return bindings.dirty_impressions(self.spark, self.folder)

    @cached_property
    def timeline(self) -> Timeline:
        return Timeline.of(self.imp, look_backs=list(LOOK_BACKS.values()), partition_rows=ROWS_PER_CHAIN)

    @cached_property
    def prior(self) -> Column:
        return target_mean(self.imp)

    @cached_property
    def mean_price(self) -> Column:
        return train_mean(self.star, "price")

    def chunked(self, *columns: str) -> DataFrame:
        """The log on its timeline, joined only with the dimensions that ``columns`` come from."""
        log = self.imp
        for dim, key in ((self.ads, "adgroup_id"), (self.users, "userid")):
            wanted = [c for c in columns if c in dim.columns and c not in self.imp.columns]
            if wanted:
                log = log.join(dim.select(key, *wanted), key, "left")
        return self.timeline.chunked(log.select("event_id", "_us", "userid", "adgroup_id", "click", "_split", *columns))

    def arranged(self, *columns: str) -> DataFrame:
        """The same, hashed on the chunk, for the history operators."""
        return by_chunk(self.chunked(*columns))

    def build_gold(self, timeline: Timeline | None = None) -> DataFrame:
        return gold_table(self.imp, self.ads, self.users, timeline or self.timeline)

    @cached_property
    def gold(self) -> DataFrame:
        """The Gold table, written once: statistics, training and ranking all read it."""
        return materialize(self.build_gold(), "gold")

    @cached_property
    def catalog(self) -> DataFrame:
        return materialize(catalog_of(self.gold), "catalog")

    @cached_property
    def lookups(self) -> Lookups:
        """What candidates are built from: derived once, read by every ranking query."""
        return lookups_of(self.gold, self.catalog)

    @cached_property
    def small_blocks(self) -> Lookups:
        """The same in blocks of about 16 ads."""
        return lookups_of(self.gold, self.catalog, 16)

    @property
    def train(self) -> DataFrame:
        return self.gold.where(is_train())

    @cached_property
    def inputs(self) -> Inputs:
        """What all tree models are fitted on."""
        return Inputs(self.train)

    def models(self, names: Sequence[str] = tuple(FITS)) -> dict[str, Model]:
        """Models of the comparison at their published size, fitted once."""
        self._models |= fit_all(self.train, names=[n for n in names if n not in self._models], inputs=self.inputs)
        return {n: self._models[n] for n in names}

    def model(self, name: str) -> Model:
        return self.models([name])[name]

    def forget_models(self) -> None:
        self._models.clear()

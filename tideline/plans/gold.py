"""The tables of a run out of listings, lazily: a table's plan is built when it is asked for; writing is the caller's."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame

from ..operators import daily as d
from ..operators import marts


class Run:
    """All tables of one set of captures. They share prefixes; write `daily` or `snapshots` first where several are
    wanted."""

    NAMES = ("flagged", "daily", "snapshots", "current_listings", "removed_listings", "market_by_district", "market_by_type", "data_quality", "summary")

    def __init__(self, listings: DataFrame, tiebreak: str | Column | None = None) -> None:
        self.listings, self.tiebreak = listings, tiebreak

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        return getattr(self, name)

    @cached_property
    def keyed(self) -> DataFrame:
        return d.keyed(self.listings)

    @cached_property
    def flagged(self) -> DataFrame:
        return d.duplicate_flags(self.keyed)

    @cached_property
    def daily(self) -> DataFrame:
        return d.best_of_day(self.flagged, self.tiebreak)

    @cached_property
    def snapshots(self) -> DataFrame:
        return d.info_changes(d.price_changes(d.snapshots(self.daily)))

    @cached_property
    def current_listings(self) -> DataFrame:
        return marts.current(self.snapshots)

    @cached_property
    def removed_listings(self) -> DataFrame:
        return d.removed(self.daily, captures=self.keyed)

    @cached_property
    def market_by_district(self) -> DataFrame:
        return marts.market_by_district(self.snapshots)

    @cached_property
    def market_by_type(self) -> DataFrame:
        return marts.market_by_type(self.snapshots)

    @cached_property
    def data_quality(self) -> DataFrame:
        return marts.data_quality(self.flagged)

    @cached_property
    def summary(self) -> DataFrame:
        return marts.summary(self.data_quality, self.current_listings, self.snapshots, self.removed_listings)


def tables(listings: DataFrame, tiebreak: str | Column | None = None) -> dict[str, DataFrame]:
    """All tables by name."""
    run = Run(listings, tiebreak)
    return {name: run[name] for name in Run.NAMES}

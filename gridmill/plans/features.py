"""Feature tables from the standard tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridmill.operators.base import region_daily_base
from gridmill.operators.features import region_daily_features
from gridmill.schemas import CHL, SST, WAVES
from gridmill.sources.store import Store


def build_base(store: Store, regions: Sequence[str] | None = None) -> DataFrame:
    """(Re)create ``region_daily_base``; no regions given means all."""
    base = region_daily_base(store.scan(SST), store.scan(WAVES), store.scan(CHL), regions)
    return store.spark.table(store.create_or_replace("region_daily_base", base))


def build_features(store: Store) -> DataFrame:
    """(Re)create ``region_daily_features`` from the base table."""
    base = store.spark.table(store.name("features", "region_daily_base"))
    return store.spark.table(store.create_or_replace("region_daily_features", region_daily_features(base)))

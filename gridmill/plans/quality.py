"""Quality and load reports over the standard tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridmill.operators import reports
from gridmill.schemas import CHL, SST, WAVES, Source
from gridmill.sources.store import Store


def quality(store: Store, regions: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The three QA reports, one row per region each."""
    return {
        "sst": reports.qa_sst(store.scan(SST), regions),
        "waves": reports.qa_waves(store.scan(WAVES), regions),
        "chl": reports.qa_chl(store.scan(CHL), regions),
    }


def loaded(
    store: Store, source: Source, d0: dt.date, d1: dt.date, regions: Sequence[str] | None = None
) -> DataFrame:
    """What a load left in the table for [d0, d1], per region."""
    rows = store.scan(source, regions, d0, d1)
    if source.composite:
        return reports.load_check(rows, d0, d1, "period_start_date", "period_end_date")
    return reports.load_check(rows, d0, d1)

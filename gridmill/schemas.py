"""Fixed table layouts, source descriptions and regions.

Everything here must equal what existing tables and loads hold, so names, types, value
ranges and source labels are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# (column, type, required) in table order -- fixed values
SST_DAILY = (
    ("date", "DATE", True),
    ("region_id", "STRING", True),
    ("lat", "FLOAT64", True),
    ("lon", "FLOAT64", True),
    ("sst_c", "FLOAT64", False),
    ("source", "STRING", True),
    ("ingested_at", "TIMESTAMP", True),
)
CHL_8DAY = (
    ("period_start_date", "DATE", True),
    ("period_end_date", "DATE", True),
    ("region_id", "STRING", True),
    ("lat", "FLOAT64", True),
    ("lon", "FLOAT64", True),
    ("chl_mg_m3", "FLOAT64", False),
    ("source", "STRING", True),
    ("ingested_at", "TIMESTAMP", True),
)
WAVES_DAILY = (
    ("date", "DATE", True),
    ("region_id", "STRING", True),
    ("lat", "FLOAT64", True),
    ("lon", "FLOAT64", True),
    ("swh_m", "FLOAT64", False),
    ("peak_period_s", "FLOAT64", False),
    ("source", "STRING", True),
    ("ingested_at", "TIMESTAMP", True),
)
PIPELINE_RUNS = (
    ("run_id", "STRING", False),
    ("job_name", "STRING", False),
    ("start_ts", "TIMESTAMP", False),
    ("end_ts", "TIMESTAMP", False),
    ("status", "STRING", False),
    ("rows_written", "INT64", False),
    ("notes", "STRING", False),
)

# Warehouse type name -> Spark type name. Types not listed are left alone by the coercion.
SPARK_TYPES = {
    "DATE": "date",
    "TIMESTAMP": "timestamp",
    "STRING": "string",
    "FLOAT64": "double",
    "NUMERIC": "double",
    "BIGNUMERIC": "double",
    "INT64": "bigint",
}


@dataclass(frozen=True)
class Source:
    """One measured data set: what its raw rows look like and what they become."""

    name: str
    job_name: str
    table: str
    schema: tuple
    measures: dict          # raw column -> standard column
    level: str              # singleton vertical axis, selected at 0.0 if present
    label: str              # text of the source column
    dataset_id: str
    lon_domain: str         # "360" = 0..360, "pm180" = -180..180
    first_year: int
    years_ahead: int        # last accepted year = this year + years_ahead
    ranges: dict = field(default_factory=dict)   # standard column -> inclusive bounds
    composite: bool = False  # rows are 8-day composites around a centre time
    sub_daily: bool = False  # rows are hourly and become daily means

    @property
    def columns(self) -> list[str]:
        return [name for name, _, _ in self.schema]

    @property
    def required(self) -> list[str]:
        return [name for name, _, required in self.schema if required]

    @property
    def outputs(self) -> list[str]:
        return list(self.measures.values())

    @property
    def day_column(self) -> str:
        return "period_start_date" if self.composite else "date"


# Source descriptions -- fixed values
SST = Source(
    name="sst", job_name="ingest_sst", table="sst_daily", schema=SST_DAILY,
    measures={"sst": "sst_c"}, level="zlev",
    label="NOAA_OISST_v2_1_via_ERDDAP", dataset_id="ncdcOisst21Agg", lon_domain="360",
    first_year=1980, years_ahead=0,
)
CHL = Source(
    name="chl", job_name="ingest_chl", table="chl_8day", schema=CHL_8DAY,
    measures={"chlorophyll": "chl_mg_m3"}, level="altitude",
    label="NOAA_ERDDAP_erdMBchla8day_LonPM180", dataset_id="erdMBchla8day_LonPM180", lon_domain="pm180",
    first_year=1997, years_ahead=1, composite=True,
)
WAVES = Source(
    name="waves", job_name="ingest_waves", table="waves_daily", schema=WAVES_DAILY,
    measures={"Thgt": "swh_m", "Tper": "peak_period_s"}, level="depth",
    label="PacIOOS_WW3_Global_via_ERDDAP_NWW3_Global_Best", dataset_id="NWW3_Global_Best", lon_domain="360",
    first_year=2016, years_ahead=1,
    ranges={"swh_m": (0.0, 40.0), "peak_period_s": (0.0, 60.0)}, sub_daily=True,
)
SOURCES = {source.name: source for source in (SST, CHL, WAVES)}

# Region boxes: id, name, lat_min, lat_max, lon_min, lon_max -- fixed values
REGIONS = (
    ("NTT", "East Nusa Tenggara (NTT - Flores/Alor) box", -10.0, -7.0, 120.0, 125.0),
    ("HAWAII", "Hawaii box", 18.0, 23.0, -161.0, -154.0),
)
REGION_SCHEMA = "region_id string, name string, lat_min double, lat_max double, lon_min double, lon_max double"

# Limits -- fixed values
FILL_FALLBACK = 9e35        # at and above: a fill value, when the data declares none
MIN_FILE_BYTES = 1024       # smaller landing files are broken downloads
NOTES_CHARS = 1000          # ledger notes are cut here
ERROR_CHARS = 500           # error text inside the notes is cut here
BAD_ROWS_SHOWN = 10         # offending rows listed in an error
DAYS_BEFORE_CENTRE = 3      # composite window around its centre day
DAYS_AFTER_CENTRE = 4
SST_RANGE = (0.0, 40.0)     # QA: plausible sea-surface temperature in degrees C

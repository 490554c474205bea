"""Sources and sinks: the raw visit file, the driver tables mapped onto it, the
parquet warehouse and the CSV export."""

from careflow.sources.fixtures import visits_from_events, visits_from_lineitem
from careflow.sources.raw_csv import read_csv_for_profile, read_raw_visits
from careflow.sources.sinks import export_csv, read_marts, write_marts

__all__ = [
    "visits_from_events", "visits_from_lineitem", "read_csv_for_profile", "read_raw_visits",
    "export_csv", "read_marts", "write_marts",
]

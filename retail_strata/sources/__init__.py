from retail_strata.sources.csv import read_csv, read_entity
from retail_strata.sources.latest import latest_entry, latest_snapshot, list_entries, read_latest
from retail_strata.sources.tables import (
    MissingInputError,
    read_entities,
    read_layer,
    read_partition,
    read_published,
)

__all__ = [
    "MissingInputError",
    "latest_entry",
    "latest_snapshot",
    "list_entries",
    "read_csv",
    "read_entities",
    "read_entity",
    "read_latest",
    "read_layer",
    "read_partition",
    "read_published",
]

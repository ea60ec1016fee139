"""Readers, writers and stage tables."""

from hearthline.sources import lookups
from hearthline.sources.listings import (
    RAW_TEXT_KEPT,
    raw_types,
    read_listings_csv,
    read_table,
    with_row_order,
    write_table,
)
from hearthline.sources.lookups import (
    first_per_key,
    read_commune_stats,
    read_postal_map,
    tidy_commune_stats,
    tidy_postal_map,
)
from hearthline.sources.stages import new_path, remove, scratch, shared_folder, stage

__all__ = [
    "RAW_TEXT_KEPT", "first_per_key", "lookups", "new_path", "raw_types", "read_commune_stats", "read_listings_csv",
    "read_postal_map", "read_table", "remove", "scratch", "shared_folder", "stage", "tidy_commune_stats",
    "tidy_postal_map", "with_row_order", "write_table",
]

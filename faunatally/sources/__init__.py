"""Tables in and out."""

from faunatally.sources.folder import Scan, header_index, scan_columnar, scan_csv
from faunatally.sources.keys import PHYLOGENETIC_KEYS, taxon_keys
from faunatally.sources.readers import (
    optional,
    read_annotations,
    read_banner_csv,
    read_clean,
    read_csv,
    read_field_log,
    read_freq_exclusions,
    read_manual_exclusions,
    scan_annotations,
    scan_field_log,
    scan_freq_exclusions,
    scan_manual_exclusions,
)
from faunatally.sources.versions import drop_superseded, read_marked, version_counts
from faunatally.sources.writers import write_clean, write_results

__all__ = [
    "PHYLOGENETIC_KEYS",
    "Scan",
    "drop_superseded",
    "header_index",
    "optional",
    "read_annotations",
    "read_banner_csv",
    "read_clean",
    "read_csv",
    "read_field_log",
    "read_freq_exclusions",
    "read_manual_exclusions",
    "read_marked",
    "scan_annotations",
    "scan_columnar",
    "scan_csv",
    "scan_field_log",
    "scan_freq_exclusions",
    "scan_manual_exclusions",
    "taxon_keys",
    "version_counts",
    "write_clean",
    "write_results",
]

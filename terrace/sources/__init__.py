"""Landing-file readers and table I/O by path (S1-S9)."""

from terrace.sources.files import read_csv, read_json_envelope, write_csv, write_json_envelope
from terrace.sources.landing import land_csv
from terrace.sources.tables import LoadSpec, load_many, read_table, write_table

__all__ = [
    "land_csv", "read_csv", "read_json_envelope", "write_csv", "write_json_envelope",
    "LoadSpec", "load_many", "read_table", "write_table",
]

"""Sources and sinks."""

from tessera.sources.lines import first_lines, row_cap, text_lines, with_line_numbers
from tessera.sources.readers import (
    choose_delimiter,
    detect_format,
    drop_corrupt,
    load_products,
    nested_schema,
    quarantine_json,
    read_delimited,
    read_json,
    read_parquet,
)
from tessera.sources.sinks import load_kmeans, materialize, path_exists, save_model, write_parquet, write_report

__all__ = [
    "choose_delimiter", "first_lines", "quarantine_json", "row_cap", "text_lines", "with_line_numbers", "detect_format", "drop_corrupt", "load_products", "nested_schema", "read_delimited",
    "read_json", "read_parquet", "load_kmeans", "materialize", "path_exists", "save_model", "write_parquet",
    "write_report",
]

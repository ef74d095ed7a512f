from tablework.sources.files import (
    read_csv,
    read_json_array_lines,
    read_json_arrays,
    read_json_lines,
    read_parquet,
    read_partitions,
    read_text,
    read_tsv,
)
from tablework.sources.json_ranges import read_split_json_arrays
from tablework.sources.tables import file_view, generated_rows, label_for, rows_to_table

__all__ = [
    "file_view",
    "generated_rows",
    "label_for",
    "read_csv",
    "read_json_array_lines",
    "read_json_arrays",
    "read_json_lines",
    "read_parquet",
    "read_partitions",
    "read_split_json_arrays",
    "read_text",
    "read_tsv",
    "rows_to_table",
]

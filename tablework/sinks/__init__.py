from tablework.sinks.catalog import write_external_table, write_managed_table
from tablework.sinks.files import (
    write_json_arrays,
    write_parquet,
    write_partitioned,
    write_tsv,
)

__all__ = [
    "write_external_table",
    "write_json_arrays",
    "write_managed_table",
    "write_parquet",
    "write_partitioned",
    "write_tsv",
]

"""Reading landed tables and writing datasets."""

from tallyloom.sources.datasets import (
    dataset_path,
    read_csv,
    read_dataset,
    read_landing,
    recover,
    remove,
    replace,
    sql_over_tables,
    write_csv,
    write_csv_sample,
    write_parquet,
)
from tallyloom.sources.drifting import landed_files, read_drifting
from tallyloom.sources.partitioned import land_partitioned, merge_partitioned, read_partitioned
from tallyloom.sources.scratch import scratch_path

__all__ = [
    "dataset_path",
    "land_partitioned",
    "landed_files",
    "merge_partitioned",
    "read_csv",
    "read_dataset",
    "read_drifting",
    "read_landing",
    "read_partitioned",
    "recover",
    "remove",
    "replace",
    "scratch_path",
    "sql_over_tables",
    "write_csv",
    "write_csv_sample",
    "write_parquet",
]

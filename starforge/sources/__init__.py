from .readers import (
    file_manifest,
    scan_csv,
    scan_json,
    scan_parquet,
    scan_text,
)
from .staging import dated_paths, ingest_slices, missing_paths, parse_json_path, stage_csv, stage_dates, stage_json
from .tables import (
    Layout,
    described,
    drop_table,
    ensure_table,
    register,
    save_table,
    table_constraints,
    truncate_table,
)
from .writers import write_csv, write_json, write_parquet, write_text

__all__ = [
    "Layout",
    "dated_paths",
    "described",
    "drop_table",
    "ensure_table",
    "file_manifest",
    "ingest_slices",
    "missing_paths",
    "parse_json_path",
    "register",
    "save_table",
    "scan_csv",
    "scan_json",
    "scan_parquet",
    "scan_text",
    "stage_csv",
    "stage_dates",
    "stage_json",
    "table_constraints",
    "truncate_table",
    "write_csv",
    "write_json",
    "write_parquet",
    "write_text",
]

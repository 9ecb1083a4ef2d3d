"""Reading landed files and writing layer tables."""

from lodestrata.sources.landing import (
    RATE_SCHEMA,
    rate_records,
    read_landing_csv,
    read_rate_json,
    records_to_df,
    stamp_ingestion,
    wide_lines,
)
from lodestrata.sources.staging import (
    drop_folder,
    drop_staged,
    drop_unread,
    shuffles_dropped,
    stage,
    staged_run,
    staging_folder,
    staging_into,
)
from lodestrata.sources.tables import (
    BATCH,
    LAYERS,
    append_batch,
    append_table,
    batch_name,
    batches_of,
    drop_table,
    ensure_layers,
    ingest_files,
    overwrite_table,
)
from lodestrata.sources.together import side_by_side, spread

__all__ = [
    "BATCH",
    "LAYERS",
    "RATE_SCHEMA",
    "append_batch",
    "append_table",
    "batch_name",
    "batches_of",
    "drop_folder",
    "drop_staged",
    "drop_table",
    "drop_unread",
    "ensure_layers",
    "ingest_files",
    "overwrite_table",
    "rate_records",
    "read_landing_csv",
    "read_rate_json",
    "records_to_df",
    "shuffles_dropped",
    "side_by_side",
    "spread",
    "stage",
    "staged_run",
    "staging_folder",
    "staging_into",
    "stamp_ingestion",
    "wide_lines",
]

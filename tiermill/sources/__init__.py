from .feeds import (
    FeedSpec,
    cast_columns,
    clean_names,
    column_or_null,
    empty_frame,
    first_lines,
    header_at,
    is_empty_feed,
    literal_table,
    merged_cells,
    merged_header,
    read_csv,
    read_report,
    read_reports,
    text_schema,
    tidy,
    with_file_date,
    with_run_date,
)
from .files import (
    accepted_paths,
    file_headers,
    file_heads,
    file_inventory,
    folder_exists,
    header_cells,
    layer_path,
    list_files,
    path_key,
    route_files,
    validate_files,
)
from .buckets import (
    BucketedTable,
)
from .manifest import (
    Manifest,
)
from .snapshots import (
    Snapshots,
)
from .sinks import (
    deliver,
    read_delivery,
    register_tables,
    write_csv,
)

__all__ = [n for n in dir() if not n.startswith("_")]

from pulsework.sources.files import (
    discover_new_files,
    file_time_bounds,
    files_of_windows,
    list_files,
    file_chunks,
    prune_files,
    read_pruned_chunks,
    read_pruned_files,
)
from pulsework.sources.landing import accepted, line_counts, parse_lines, parse_variants, quarantined, read_jsonl, read_variants
from pulsework.sources.tables import (
    read_csv_dim,
    read_jdbc_query,
    read_parquet_files,
    read_table,
    table_or_none,
    with_lineage,
)

from pulsework.streaming.jobs import (
    append_new_files,
    daily_sums,
    dedupe_events,
    read_state,
    run_available,
    stream_files,
    sums_to_days,
    upsert_latest,
)

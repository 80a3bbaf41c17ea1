"""Sources, sinks and table adapters."""

from burstwatch.sources.adapters import (  # noqa: F401
    comment_pages, comments_from_events, labels_as_predictions, land_comment_pages,
    load_comments, load_table, with_document_text,
)
from burstwatch.sources.pages import (  # noqa: F401
    pages_from_json, parse_comments, quarantined_items, read_comment_pages,
    stream_comment_pages,
)
from burstwatch.sources.tables import (  # noqa: F401
    append_ignore_duplicates, dedupe_batch, delta_since, high_water_marks,
    insert_ignore_duplicates, read_alerts, read_comments, read_quarantine,
    read_window_metrics, store_comments, store_quarantine, table_exists,
    upsert_window_metrics, write_alerts, write_comments, write_window_metrics,
)

from tillflow.sources.tables import (  # noqa: F401
    read_table, retail_events, RETAIL_ORDER_COLS,
)
from tillflow.sources.files import (  # noqa: F401
    read_event_csv, to_messages, write_messages, read_messages,
    read_messages_stream, write_backup_csv, write_event_csv,
)

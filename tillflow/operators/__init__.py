from tillflow.operators.validate import (  # noqa: F401
    validate_messages, validate_events, split_valid,
)
from tillflow.operators.clean import (  # noqa: F401
    mark_missing_ids, first_per_key, clean_events,
)
from tillflow.operators.store import (  # noqa: F401
    mark_present, insert_if_absent, upsert_latest,
)
from tillflow.operators.dlq import dlq_rows, envelope_json  # noqa: F401
from tillflow.operators.aggregates import (  # noqa: F401
    dashboard_frame, kpi, top_products, hourly_revenue, country_sales,
    country_share, category_sales, row_count, top_k,
)
from tillflow.operators.metrics import ingest_metrics  # noqa: F401
from tillflow.operators.window import time_window, coerce_timestamp  # noqa: F401

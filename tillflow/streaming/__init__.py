from tillflow.streaming.ingest import start_ingest, batch_writer, stable_query_id  # noqa: F401
from tillflow.streaming.dashboard import start_dashboard, dashboard_streams  # noqa: F401
from tillflow.streaming.dedupe import distinct_within_watermark, distinct_unbounded  # noqa: F401

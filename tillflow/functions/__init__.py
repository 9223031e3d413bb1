from tillflow.functions.scalar import (  # noqa: F401
    add_month, customer_id_text, first_word, hour_of_day, iso_timestamp_text,
    money_text, month_label, parse_invoice_ts, percent_text, count_text,
    row_to_json, anchor_now, window_bounds,
)
from tillflow.functions.validation import (  # noqa: F401
    parse_message, message_is_object, field_check, field_probe, message_fields, wire_error_expr,
    typed_error_expr, typed_invalid_expr,
)

"""Schema validation and the valid / invalid split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow import schema as S
from tillflow.functions.validation import (
    field_check, field_probe, message_fields, message_is_object, parse_message,
    typed_error_expr, typed_invalid_expr, wire_error_expr,
)

VALIDATION_COLUMNS = ["error", "reason", "raw"]


def fence(df: DataFrame) -> DataFrame:
    """``df`` behind inline() over a one-element array, which parts one step from the next.

    The optimizer pushes no filter below it, and generated code goes on in a method of its own: HotSpot
    never compiles a method of more than 8,000 bytes of bytecode, so steps that make one together run
    interpreted, at twice the time."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def validate_messages(df: DataFrame, value_col: str = "value", fields: list[str] | None = None) -> DataFrame:
    """JSON messages -> typed wire fields + ``error``/``reason``/``raw``.

    ``reason`` is NULL for a valid record, ``malformed_json`` when the text is
    not a JSON object, ``schema`` when a field is absent, null or of the
    wrong type.  Other input columns (arrival order, offsets) pass through.

    The work is laid out in projection layers so every expensive step runs
    once per message: parse, then extract each field, then probe each
    field's type tag and candidate value, then derive values and codes.

    Every field is checked; only the values of ``fields`` (default: all) are in the result.
    """
    wanted = [n for n in S.WIRE_NAMES if fields is None or n in fields]
    keep = [c for c in df.columns if c != value_col and c not in S.WIRE_NAMES]
    text = fence(df.select(*keep, F.col(value_col).cast("string").alias("raw")))
    parsed = text.select(*keep, "raw", parse_message(F.col("raw")).alias("_msg"))
    parts = fence(parsed.select(
        *keep, "raw", message_is_object(F.col("_msg"), F.col("raw")).alias("_obj"),
        message_fields(F.col("_msg")).alias("_f")))
    probe_cols, probes = [], {}
    for name, kind in S.WIRE_FIELDS:
        probes[name] = {}
        for fact, expr in field_probe(F.col(f"_f.{name}"), kind, name in wanted).items():
            col_name = f"_{fact}_{name}"
            probe_cols.append(expr.alias(col_name))
            probes[name][fact] = F.col(col_name)
    probed = fence(parts.select(*keep, "raw", "_obj", *probe_cols))
    values, codes = [], []
    for name, kind in S.WIRE_FIELDS:
        value, code = field_check(probes[name], kind)
        if name in wanted:
            values.append(value.cast(S.WIRE_SCHEMA[name].dataType).alias(name))
        codes.append((name, code.alias(f"_c_{name}")))
    checked = probed.select(*keep, "raw", "_obj", *values, *[c for _, c in codes])
    code_cols = [(n, F.col(f"_c_{n}")) for n in S.WIRE_NAMES]
    is_obj = F.col("_obj")
    any_bad = None
    for _, code in code_cols:
        any_bad = code.isNotNull() if any_bad is None else (any_bad | code.isNotNull())
    reason = (F.when(~is_obj, F.lit(S.REASON_MALFORMED))
              .when(any_bad, F.lit(S.REASON_SCHEMA)))
    error = (F.when(~is_obj, F.lit(S.REASON_MALFORMED))
             .when(any_bad, wire_error_expr(code_cols)).otherwise(F.lit("")))
    # Filters on the result (the valid/invalid split, the null drop) stay above the fence,
    # so the layers above are not re-inlined into a filter.
    return fence(checked.select(*keep, *wanted, error.alias("error"), reason.alias("reason"), "raw"))


def decode_permissive(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The older stream's decode: ``from_json`` with the wire schema, CustomerID
    as text.  Nothing is rejected; what doesn't fit its type is NULL."""
    kinds = ", ".join(f"{n} {'string' if n == 'CustomerID' else S.EVENT_SCHEMA[n].dataType.simpleString()}"
                      for n in S.WIRE_NAMES)
    rest = [c for c in df.columns if c != value_col]
    return df.select(*rest, F.from_json(F.col(value_col).cast("string"), kinds).alias("_e")).select(*rest, "_e.*")


def validate_events(df: DataFrame) -> DataFrame:
    """Typed events (CSV with a schema, tables) -> same shape as
    :func:`validate_messages`; every field must be present and non-null."""
    keep = [c for c in df.columns if c not in S.WIRE_NAMES]
    bad = typed_invalid_expr()
    cols = [F.col(n).cast(S.WIRE_SCHEMA[n].dataType).alias(n) for n in S.WIRE_NAMES]
    return df.select(*keep, *cols,
                     F.when(bad, typed_error_expr()).otherwise(F.lit("")).alias("error"),
                     F.when(bad, F.lit(S.REASON_SCHEMA)).alias("reason"),
                     F.lit(None).cast("string").alias("raw"))


def split_valid(validated: DataFrame):
    """(valid, invalid) by the reason column."""
    return (validated.where(F.col("reason").isNull()),
            validated.where(F.col("reason").isNotNull()))


def raw_record_json() -> F.Column:
    """The record as received: the message text, else the typed fields."""
    from tillflow.functions.scalar import row_to_json
    return F.coalesce(F.col("raw"), row_to_json(*S.WIRE_NAMES))

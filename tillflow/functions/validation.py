"""Lax-number / strict-string validation of event messages.

A message is parsed once into a VARIANT, each field is extracted once, and
every field is then tested on its variant type tag, which separates "absent" (NULL tag), "JSON null" (VOID)
and "wrong type".  Numbers follow the validator's lax rules: an int field
takes integers, integral decimals/doubles, booleans and numeric text such as
"6", " 6 " or "6.0"; a float field takes any number, boolean or numeric text
(including "nan").  Strings must be JSON strings.  Everything is a built-in
expression, so validation runs inside whole-stage codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow import schema as S

_INT_TAGS = ["BIGINT", "INT", "SMALLINT", "TINYINT"]
# Largest float the validator turns into an int (it goes through int64).
_INT_FROM_FLOAT_LIMIT = 9.223372036854776e18


# The blanks JSON allows around a value, and the end marker
# appended after the message text (see parse_message).
JSON_BLANKS = " \t\n\r"
END_MARK = "\u0001end-of-message"
_END_MARK_JSON = '"\\u0001end-of-message"'


def parse_message(value: Column) -> Column:
    """bytes/text -> VARIANT, NULL when the text is not JSON.

    The text is parsed as ``[<text>, "<END_MARK>"]``: Spark's parser stops
    after the first value and ignores what follows, while a strict reader
    rejects trailing text (``{} {}``, ``{"a": 1} x``).  Inside the array any
    trailing text either breaks the parse or changes the element count, so
    :func:`message_is_object` can tell one whole value from a value plus
    extra text in the same single parse.  The message is element 0.
    """
    text = value.cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("," + _END_MARK_JSON + "]")))


def message_is_object(v: Column, text: Column) -> Column:
    """The whole text is one JSON object.  A JSON value that opens with
    ``{`` after blanks is an object (far cheaper than deriving the whole
    message's schema); the end mark must be element 1 and the last one."""
    whole = ((F.try_variant_get(v, "$[1]", "string") == F.lit(END_MARK))
             & F.try_variant_get(v, "$[2]", "variant").isNull())
    starts = F.ltrim(text.cast("string"), F.lit(JSON_BLANKS)).startswith("{")
    return F.coalesce(v.isNotNull() & whole & starts, F.lit(False))


def message_fields(v: Column) -> Column:
    """The fields' own VARIANTs (NULL when absent) as one struct, NULL for no object: the
    object is gone through once, not searched for each field."""
    return F.try_variant_get(v, "$[0]", f"struct<{', '.join(f'{n}: variant' for n in S.WIRE_NAMES)}>")


# Numeric text the validator takes: digits may be grouped by single underscores;
# an int may have a fraction of zeros only and no exponent.
_DIGITS = r"\d+(_\d+)*"
INT_TEXT = rf"^[+-]?{_DIGITS}(\.0+)?$"
INT_OR_FRACTION_TEXT = rf"^[+-]?{_DIGITS}(\.{_DIGITS})?$"
FLOAT_TEXT = (rf"^[+-]?({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?$"
              r"|^[+-]?([nN][aA][nN]|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$")
TEXT_BLANKS = " \t\n\r\f\x0b"


def _number_text(text: Column, pattern: str) -> Column:
    """Trimmed text without underscores, NULL unless the validator would read it as a number."""
    bare = F.btrim(text, F.lit(TEXT_BLANKS))
    return F.when(bare.rlike(pattern), F.replace(bare, F.lit("_"), F.lit("")))


def field_probe(fv: Column, kind: str, wanted: bool = True) -> dict[str, Column]:
    """Per-field facts, each computed once in its own projection column:
    the type tag and the candidate values the kind needs.  A string's check
    takes its tag alone, so its text is left out unless it is ``wanted``."""
    tag = F.schema_of_variant(fv)
    out = {"tag": tag}
    text = F.try_variant_get(fv, "$", "string")
    is_text = tag == "STRING"
    if kind == "str":
        if wanted:
            out["s"] = F.when(is_text, text)
    elif kind == "int":
        whole = F.regexp_replace(_number_text(text, INT_TEXT), r"\.0+$", "")
        out["i"] = (F.when(tag.isin(_INT_TAGS), F.try_variant_get(fv, "$", "bigint"))
                    .when(is_text, whole.try_cast("bigint")))
        out["d"] = (F.when(is_text, _number_text(text, INT_OR_FRACTION_TEXT).try_cast("double"))
                    .when(~tag.isin(_INT_TAGS) & (tag != "VOID"), F.try_variant_get(fv, "$", "double")))
    else:
        out["d"] = (F.when(is_text, _number_text(text, FLOAT_TEXT).try_cast("double"))
                    .when(tag != "VOID", F.try_variant_get(fv, "$", "double")))
    return out


def field_check(probe: dict[str, Column], kind: str):
    """(value, code) from the probe columns; code is NULL when valid, and
    there is no value of a string whose text wasn't probed."""
    tag = probe["tag"]
    missing = tag.isNull()
    is_null = tag == "VOID"
    if kind == "str":
        ok = tag == "STRING"
        code = F.when(missing, "missing").when(is_null, "null").when(~ok, "type")
        return probe.get("s"), code
    d = probe["d"]
    if kind == "float":
        code = F.when(missing, "missing").when(is_null, "null").when(d.isNull(), "type")
        return d, code
    # int: exact integers pass as they are; other numbers and numeric text
    # pass when integral and within int64.
    i = probe["i"]
    integral = (~F.isnan(d)) & (d % 1 == 0)
    in_range = F.abs(d) < F.lit(_INT_FROM_FLOAT_LIMIT)
    value = F.when(i.isNotNull(), i).when(d.isNotNull() & integral & in_range, d.cast("bigint"))
    code = (F.when(missing, "missing").when(is_null, "null")
            .when(i.isNotNull(), F.lit(None))
            .when(d.isNull(), "type")
            .when(~integral, "fraction")
            .when(~in_range, "range"))
    return value, code


def wire_error_expr(codes: list[tuple[str, Column]]) -> Column:
    """``Field:code;Field:code`` in field order, '' when every field passed."""
    return F.concat_ws(";", *[F.when(c.isNotNull(), F.concat(F.lit(n + ":"), c))
                              for n, c in codes])


def _typed_bad(name: str, kind: str) -> Column:
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if kind == "float" else c.isNull()


def typed_invalid_expr() -> Column:
    """True when a field of an already typed frame is null (a NaN float
    counts as null, as it serialises to JSON null)."""
    cond = None
    for name, kind in S.WIRE_FIELDS:
        bad = _typed_bad(name, kind)
        cond = bad if cond is None else (cond | bad)
    return cond


def typed_error_expr() -> Column:
    """Error text for an already typed frame (``''`` when valid)."""
    return F.concat_ws(";", *[F.when(_typed_bad(n, k), F.lit(n + ":null"))
                              for n, k in S.WIRE_FIELDS])

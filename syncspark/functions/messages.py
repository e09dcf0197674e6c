"""JSON messages: text to columns with a reason for every refusal, and back.

Every function is a narrow projection, so the same code serves a batch and a
stream and adds no shuffle to either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.functions.scalars import clean_text
from syncspark.schemas import CURSOR_FORMAT, MESSAGE, MESSAGE_REQUIRED

_CORRUPT = "_corrupt_record"
# Times travel as text with six fraction digits.
TIMES = {"timestampFormat": CURSOR_FORMAT, "timestampNTZFormat": CURSOR_FORMAT}

# Reasons, in the order in which they are tested.
EMPTY = "empty"
NOT_JSON = "not one json value"
NOT_OBJECT = "not a json object"
WRONG_TYPE = "wrong field type"
MISSING_KEY = "missing required key"


def elements(text: Column) -> Column:
    """The JSON values in ``text`` followed by an end marker.

    Wrapped in an array, trailing text either breaks the array or moves the
    marker, both of which the plain parser would accept silently. The marker is
    the hash of the text, which no text can hold itself.
    """
    whole = F.concat(F.lit("["), text, F.lit(', "'), _marker(text), F.lit('"]'))
    return F.from_json(whole, T.ArrayType(T.StringType()))


def _marker(text: Column) -> Column:
    return F.sha2(text, 256)


def ends_at_first_brace(text: Column) -> Column:
    """The only closing brace ends the text: if it parses, nothing follows the object."""
    return F.instr(text, "}") == F.char_length(F.rtrim(text))


def is_one(parts: Column, text: Column) -> Column:
    """The parts of the text are one value and its end marker."""
    return F.coalesce((F.size(parts) == 2) & (parts[1] == _marker(text)), F.lit(False))


def with_unwrapped(df: DataFrame, value: str, name: str) -> DataFrame:
    """Undo double encoding: a value that is itself a JSON string is decoded.

    Escapes inside a plain object are left to the JSON parser.
    """
    outer = F.when(F.col(value).rlike(r'^\s*"'), elements(F.col(value)))
    inner = F.when(is_one(F.col("_outer"), F.col(value)), F.col("_outer")[0]).otherwise(F.col(value))
    return df.withColumn("_outer", outer).withColumn(name, inner).drop("_outer")


def decode(
    df: DataFrame,
    schema: T.StructType = MESSAGE,
    required: Sequence[str] = MESSAGE_REQUIRED,
    value: str = "value",
    lenient: bool = False,
) -> DataFrame:
    """Add ``data`` (parsed struct) and ``reason`` (null when accepted).

    ``value`` may be binary, as a message queue delivers it. With ``lenient``
    text is cleaned by dropping every backslash and only null or empty messages
    are refused; malformed ones then become rows of nulls.
    """
    others = [c for c in df.columns if c != value]
    texts = df.select(*others, F.col(value).cast("string").alias(value))
    if lenient:
        parsed = texts.withColumn("_parsed", F.from_json(clean_text(F.col(value)), schema, TIMES))
        reason = F.when(F.col("_parsed").isNull(), EMPTY)
        return _fixed(parsed, [*others, value], F.col("_parsed"), reason)
    with_corrupt = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType(), True)])
    parsed = (
        with_unwrapped(texts, value, "_text")
        .withColumn("_parsed", F.from_json("_text", with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT, **TIMES}))
        .withColumn("_closed", ends_at_first_brace(F.col("_text")) & F.col(f"_parsed.{_CORRUPT}").isNull())
        .withColumn("_parts", F.when(~F.col("_closed"), elements(F.col("_text"))))
    )
    one_value = F.col("_closed") | is_one(F.col("_parts"), F.col("_text"))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"_parsed.`{name}`").isNull()
    reason = (
        F.when(F.col(value).isNull() | (F.trim(F.col(value)) == ""), EMPTY)
        .when(~one_value, NOT_JSON)
        .when(~F.coalesce(F.col("_text").rlike(r"^\s*\{"), F.lit(False)), NOT_OBJECT)
        .when(F.col(f"_parsed.{_CORRUPT}").isNotNull(), WRONG_TYPE)
        .when(missing, MISSING_KEY)
    )
    fields = F.struct(*(F.col(f"_parsed.`{n}`").alias(n) for n in schema.names))
    return _fixed(parsed, [*others, value], fields, reason)


def _fixed(parsed: DataFrame, names: Sequence[str], data: Column, reason: Column) -> DataFrame:
    """Add the outcome of a parse as a generated row.

    Later filters and selections stay above a generator, whereas they would be
    merged with a projection and parse each text once per use.
    """
    outcome = F.struct(data.alias("data"), reason.alias("reason"))
    return parsed.select(*names, F.inline(F.array(outcome)))


def accepted(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns of the accepted messages, after the ``keep`` columns."""
    return decoded.filter(F.col("reason").isNull()).select(*keep, "data.*")


def quarantined(decoded: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Whole text and reason of the refused messages."""
    return decoded.filter(F.col("reason").isNotNull()).select(*keep, value, "reason")


def encode(df: DataFrame, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON ``value`` per row; null fields are written, times keep all six digits."""
    chosen = list(columns or df.columns)
    body = F.to_json(F.struct(*chosen), {"ignoreNullFields": "false", **TIMES})
    return df.select(*keep, body.alias("value"))


def open_map(text: Column) -> Column:
    """Any JSON object as a map of texts; null where the text is not one."""
    return F.from_json(text, T.MapType(T.StringType(), T.StringType()))

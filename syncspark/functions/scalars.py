"""Column expressions on text, time and keys. All run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from syncspark.schemas import CURSOR_FORMAT, ENTITY_PREFIX

# What lenient cleaning removes.
BACKSLASH = "\\"
OUTER_QUOTE_PATTERN = '^"|"$'


def strip_backslashes(text: Column) -> Column:
    """Drop every backslash; a plain search is enough for one character."""
    return F.replace(text, F.lit(BACKSLASH), F.lit(""))


def strip_outer_quotes(text: Column) -> Column:
    """Drop one leading and one trailing double quote."""
    return F.regexp_replace(text, OUTER_QUOTE_PATTERN, "")


def clean_text(text: Column) -> Column:
    """Lenient cleaning: every backslash goes, escapes included."""
    return strip_outer_quotes(strip_backslashes(text))


def format_micros(ts: Column) -> Column:
    """Sortable text form of a timestamp with six fraction digits."""
    return F.date_format(ts, CURSOR_FORMAT)


def to_millis(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def now_millis() -> Column:
    """Default of a change-log timestamp; fixed once per query."""
    return to_millis(F.current_timestamp())


def is_blank(value: Column | str | None) -> Column | bool:
    """True for null or whitespace; plain Python values are tested at once."""
    if isinstance(value, Column):
        return value.isNull() | (F.trim(value) == "")
    return value is None or not str(value).strip()


def entity_key(key: Column, prefix: str = ENTITY_PREFIX) -> Column:
    """Key of a key-value record, such as ``user:1``."""
    return F.concat(F.lit(f"{prefix}:"), key.cast("string"))


def field_map(fields: Sequence[str]) -> Column:
    """Map from field name to its text value; a null field has a null value."""
    entries: list[Column] = []
    for name in fields:
        entries += [F.lit(name), F.col(name).cast("string")]
    return F.create_map(*entries)

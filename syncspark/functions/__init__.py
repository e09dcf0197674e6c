from syncspark.functions.messages import decode, encode, accepted, quarantined
from syncspark.functions.scalars import (
    clean_text,
    entity_key,
    field_map,
    format_micros,
    is_blank,
    now_millis,
    strip_backslashes,
    strip_outer_quotes,
    to_millis,
)

__all__ = [
    "accepted",
    "clean_text",
    "decode",
    "encode",
    "entity_key",
    "field_map",
    "format_micros",
    "is_blank",
    "now_millis",
    "quarantined",
    "strip_backslashes",
    "strip_outer_quotes",
    "to_millis",
]

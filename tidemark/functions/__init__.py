"""Column expressions; nothing here touches rows in Python."""

from tidemark.functions.rowtext import (
    iso_timestamps,
    row_cells,
    row_json_array,
    row_json_object,
)
from tidemark.functions.values import (
    append_suffix,
    decode_text,
    named,
    text_bytes,
    wrap_document,
)

__all__ = [
    "append_suffix",
    "decode_text",
    "iso_timestamps",
    "named",
    "row_cells",
    "row_json_array",
    "row_json_object",
    "text_bytes",
    "wrap_document",
]

from tidemark.functions.codec import decode_events, encode_events
from tidemark.functions.columns import (
    date_parts,
    named,
    percent,
    status_label,
    whole_seconds_between,
    with_date_parts,
)

__all__ = [
    "date_parts",
    "decode_events",
    "encode_events",
    "named",
    "percent",
    "status_label",
    "whole_seconds_between",
    "with_date_parts",
]

"""DataFrame-to-DataFrame operators."""

from .dedup import (
    dedup_envelope,
    dedup_rare_copies,
    first_per_key,
    latest_per_key,
    latest_per_key_agg,
    sum_columns,
)
from .keyjoin import filter_by_keys, fits_broadcast, join_right
from .merge import merge_insert, merge_refresh, merge_upsert, new_rows
from .offsets import (
    EARLIEST,
    LATEST,
    bound_batch,
    decode_offsets,
    encode_offsets,
    next_offsets,
    offset_gaps,
    parse_offsets,
    prorate,
    select_range,
    start_offsets,
    start_offsets_text,
)
from .presence import drop_present, merge_words, presence_words
from .rows import counted, mark_malformed, preview, row_count, split_malformed

__all__ = [
    "EARLIEST",
    "LATEST",
    "bound_batch",
    "counted",
    "decode_offsets",
    "dedup_envelope",
    "dedup_rare_copies",
    "drop_present",
    "encode_offsets",
    "filter_by_keys",
    "first_per_key",
    "fits_broadcast",
    "join_right",
    "latest_per_key",
    "latest_per_key_agg",
    "mark_malformed",
    "merge_insert",
    "merge_refresh",
    "merge_upsert",
    "merge_words",
    "new_rows",
    "next_offsets",
    "offset_gaps",
    "parse_offsets",
    "presence_words",
    "preview",
    "prorate",
    "row_count",
    "select_range",
    "split_malformed",
    "start_offsets",
    "start_offsets_text",
    "sum_columns",
]

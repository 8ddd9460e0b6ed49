"""DataFrame operators: joins, windows, key checks, ids, nested data."""

from tramflow.operators.bandjoin import band_join
from tramflow.operators.broadcast import broadcast_if_small
from tramflow.operators.ids import with_dense_ids
from tramflow.operators.nearest import nearest_match
from tramflow.operators.nested import assemble, drop_nested, unwind
from tramflow.operators.quality import (
    Split,
    dedupe_keep_first,
    load_counts,
    mark_keep_first,
    max_id,
    split_foreign_key,
    split_marked,
    split_not_null,
)
from tramflow.operators.windows import (
    LastChange,
    LastValue,
    Number,
    Previous,
    change_marker,
    forward_fill,
    previous_distinct,
    segmented_scan,
    sequence_number,
)

__all__ = [
    "LastChange",
    "LastValue",
    "Number",
    "Previous",
    "Split",
    "assemble",
    "band_join",
    "broadcast_if_small",
    "change_marker",
    "dedupe_keep_first",
    "drop_nested",
    "forward_fill",
    "load_counts",
    "mark_keep_first",
    "max_id",
    "nearest_match",
    "previous_distinct",
    "segmented_scan",
    "sequence_number",
    "split_foreign_key",
    "split_marked",
    "split_not_null",
    "unwind",
    "with_dense_ids",
]

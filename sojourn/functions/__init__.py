from .scalar import (
    csv_index,
    day_of_epoch,
    epoch_to_day,
    is_epoch_seconds,
    is_valid_id,
    is_valid_site,
    same_site,
    segment_line,
    strip_quotes,
    tsv_line,
)

__all__ = [
    "csv_index",
    "day_of_epoch",
    "epoch_to_day",
    "is_epoch_seconds",
    "is_valid_id",
    "is_valid_site",
    "same_site",
    "segment_line",
    "strip_quotes",
    "tsv_line",
]

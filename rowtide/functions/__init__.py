"""Column helpers: epochs, commit instants and bucketed ordering."""

from rowtide.functions.epoch import normalize_epoch, ntz_epoch_seconds, to_millis
from rowtide.functions.instants import instant_from_millis, pad_instant, validate_instant
from rowtide.functions.ordered import dense_index, previous_row

__all__ = [
    "dense_index",
    "instant_from_millis",
    "normalize_epoch",
    "ntz_epoch_seconds",
    "pad_instant",
    "previous_row",
    "to_millis",
    "validate_instant",
]

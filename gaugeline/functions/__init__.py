"""Column expressions shared by the operators."""

from gaugeline.functions.numbers import (
    bind,
    floor_zero,
    guarded,
    nan_to_null,
    rounded,
    softmax_weight,
)
from gaugeline.functions.text import code_label, compact_time, hash_suffix, iso_time, numbered
from gaugeline.functions.times import (
    add_hours,
    age_days,
    as_moment,
    clock_time,
    epoch,
    interval_seconds,
    parse_iso,
    time_bin,
)

__all__ = [
    "add_hours", "age_days", "as_moment", "bind", "clock_time", "code_label", "compact_time", "epoch",
    "floor_zero", "guarded", "hash_suffix", "interval_seconds", "iso_time", "nan_to_null",
    "numbered", "parse_iso", "rounded", "softmax_weight", "time_bin",
]

"""Text column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMddHHmmss")


def iso_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def numbered(number: Column, digits: int = 3) -> Column:
    """Whole number, zero-padded to ``digits``."""
    return F.lpad(number.cast("string"), digits, "0")


def hash_suffix(text: Column, modulus: int = 1000) -> Column:
    """Stable text hash below ``modulus``: equal on every run and every executor."""
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(modulus))


def code_label(code: Column, labels: Sequence[tuple[int, str]], other: str) -> Column:
    """Label of a code from a fixed list, ``other`` for an unknown code."""
    result = F.lit(other)
    for key, label in labels:
        result = F.when(code == key, F.lit(label)).otherwise(result)
    return result

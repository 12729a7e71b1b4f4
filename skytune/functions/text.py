"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points with the Unicode White_Space property, as (first, last).
# Spark's plain trim() strips only U+0020.
WHITESPACE_RANGES = (
    (0x0009, 0x000D),
    (0x0020, 0x0020),
    (0x0085, 0x0085),
    (0x00A0, 0x00A0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
WHITESPACE = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))


def match_key(text: Column) -> Column:
    """Case- and padding-insensitive join key."""
    return F.lower(F.btrim(text, F.lit(WHITESPACE)))

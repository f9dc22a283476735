"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def increment_suffix(name, pad: int = 3) -> Column:
    """take the text after the last '-', add 1, zero-pad to ``pad`` (never truncates), and
    replace *every* occurrence of the old suffix in the name. Non-numeric suffix -> null."""
    n = _c(name)
    suffix = F.element_at(F.split(n, "-"), -1)
    nxt = F.format_string(f"%0{pad}d", suffix.try_cast("bigint") + F.lit(1))
    return F.when(suffix.try_cast("bigint").isNotNull(), F.replace(n, suffix, nxt))


def zero_pad(c, width: int) -> Column:
    """zero-padded number text (e.g. month=03)."""
    return F.format_string(f"%0{width}d", _c(c).cast("int"))

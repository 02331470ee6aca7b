"""Engine-independent rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(c: Column | str, digits: int) -> Column:
    """Round to ``digits`` places as ``round(c * 10^d) / 10^d``.

    The scaled double is rounded half away from zero, which is the same
    arithmetic in Spark and in SQL engines.  ``round(c, d)`` on a double
    rounds its shortest decimal form instead, so a value printed as ...5 in
    the 7th place can round differently from an engine that scales first.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale)) / F.lit(scale)

"""Sample standard deviation, null below two observations.

Spark's ``stddev_samp`` keeps a running mean and the squared deviations from it,
so large values elsewhere in a series cost a small window no digits; sums of
squares would.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def std_samp(col: str | Column, frame: WindowSpec | None = None) -> Column:
    """Sample std as a window expression over ``frame`` or as an aggregate."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.stddev_samp(x) if frame is None else F.stddev_samp(x).over(frame)

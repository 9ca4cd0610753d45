"""Gap filling of keyed daily series without a grid join.

Each fact row is expanded into itself plus the empty days up to the next
fact row of its series (``lead`` over the series window); the first row of
a series also covers the days from the global start. The only exchange is
the one of the series window, so the dense output comes out clustered by
the series key and later series windows over it need no further shuffle.
Rows grow only with the output (no series × dates cross join).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def densify(fact: DataFrame, keys: Sequence[str], date_col: str,
            start: Column, end: Column, fill: dict) -> DataFrame:
    """Return one row per key and day in [start, end].

    ``fill`` maps value columns to the value used on generated days; on days
    with a fact row the fact's values are kept. ``start`` must not be after the
    first fact date of any series (e.g. the global minimum).
    """
    w = Window.partitionBy(*keys).orderBy(date_col)
    d = F.col(date_col)
    nxt = F.lead(d).over(w)
    is_first = F.lag(d).over(w).isNull()
    gen_from = F.when(is_first, F.least(start, d)).otherwise(d)
    last_gap_day = F.coalesce(F.date_sub(nxt, 1), end)
    gen_to = F.greatest(F.least(last_gap_day, end), d)
    values = [c for c in fact.columns if c not in keys and c != date_col]
    bounds = fact.select(*keys, d.alias("_fact_date"), *values,
                         gen_from.alias("_from"), gen_to.alias("_to"))
    staged = bounds.select(*keys, "_fact_date", *values,
                           F.explode(F.sequence("_from", "_to")).alias(date_col))
    on_fact_day = F.col(date_col) == F.col("_fact_date")
    out = [F.when(on_fact_day, F.col(c)).otherwise(F.lit(fill[c])).alias(c)
           if c in fill else F.when(on_fact_day, F.col(c)).alias(c) for c in values]
    return (staged.filter((F.col(date_col) >= start) & (F.col(date_col) <= end))
                  .select(*keys, date_col, *out))

"""Calendar, payday and season functions (pure column expressions).

They are evaluated on the calendar table (one row per day) and joined to the
panel by date, so each is computed once per day, not once per row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_PI = 2.0 * math.pi
FOURIER_ORDERS = [1, 2, 3]
WEEK_PERIOD = 7.0
YEAR_PERIOD = 365.25
# Fixed values of the original payday rules.
PAYDAY_MID_MONTH = 15
DECAY_STEP = 0.25
QUINCENA_DAYS = [15, 16, 17]
POST_MONTH_END_DAYS = [1, 2, 3]
STORE_TYPE_ORDINAL = {"A": 5, "B": 4, "C": 3, "D": 2, "E": 1}
STORE_TYPE_DEFAULT = 3
# Event window flagged in the features (a parameter of the original run,
# moved into the span of the test data).
EVENT_START, EVENT_END = "1998-04-16", "1998-05-15"


def _d(date_col: str | Column) -> Column:
    return F.col(date_col) if isinstance(date_col, str) else date_col


def day_of_week(date_col="date") -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_d(date_col))


def is_month_end(date_col="date") -> Column:
    d = _d(date_col)
    return (d == F.last_day(d)).cast("int")


def calendar_columns(date_col="date") -> list[Column]:
    d = _d(date_col)
    dow = day_of_week(d)
    month = F.month(d)
    return [
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        month.alias("month"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("week_of_year"),
        F.quarter(d).alias("quarter"),
        F.dayofyear(d).alias("day_of_year"),
        (dow >= 5).cast("int").alias("is_weekend"),
        (F.dayofmonth(d) == 1).cast("int").alias("is_month_start"),
        is_month_end(d).alias("is_month_end"),
        F.sin(TWO_PI * dow / WEEK_PERIOD).alias("dow_sin"),
        F.cos(TWO_PI * dow / WEEK_PERIOD).alias("dow_cos"),
        F.sin(TWO_PI * (month - 1) / 12.0).alias("month_sin"),
        F.cos(TWO_PI * (month - 1) / 12.0).alias("month_cos"),
        (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int").alias("week_of_month"),
    ]


def fourier_columns(date_col="date") -> list[Column]:
    d = _d(date_col)
    dow, doy = day_of_week(d), F.dayofyear(d)
    cols = []
    for k in FOURIER_ORDERS:
        cols += [F.sin(TWO_PI * k * dow / WEEK_PERIOD).alias(f"fourier_week_sin_{k}"),
                 F.cos(TWO_PI * k * dow / WEEK_PERIOD).alias(f"fourier_week_cos_{k}"),
                 F.sin(TWO_PI * k * doy / YEAR_PERIOD).alias(f"fourier_year_sin_{k}"),
                 F.cos(TWO_PI * k * doy / YEAR_PERIOD).alias(f"fourier_year_cos_{k}")]
    return cols


def payday_decay(day: Column) -> Column:
    """max(0, 1 - 0.25 * distance to the nearest payday) with the original
    distance rules (values as coded, e.g. 1.25 on the 31st)."""
    dist_15 = F.abs(day - PAYDAY_MID_MONTH)
    dist_end = (F.when(day <= 3, F.least(F.abs(day - 30), day))
                .when(day >= 28, 30 - day)
                .otherwise(F.lit(15)))
    dist = F.least(dist_15, dist_end)
    return F.greatest(F.lit(0.0), 1.0 - DECAY_STEP * dist.cast("double"))


def payday_columns(date_col="date") -> list[Column]:
    d = _d(date_col)
    day = F.dayofmonth(d)
    month_end = d == F.last_day(d)
    since = F.when(day <= PAYDAY_MID_MONTH, day - 1).otherwise(day - PAYDAY_MID_MONTH)
    return [
        ((day == PAYDAY_MID_MONTH) | month_end).cast("int").alias("is_payday"),
        F.least(F.greatest(since, F.lit(0)), F.lit(16)).alias("days_since_payday"),
        (day.isin(QUINCENA_DAYS) | day.isin(POST_MONTH_END_DAYS) | month_end)
        .cast("int").alias("is_post_payday_window"),
        day.isin(QUINCENA_DAYS).cast("int").alias("is_quincena"),
        ((day >= 28) | (day <= 2)).cast("int").alias("is_fin_de_mes"),
        payday_decay(day).alias("payday_decay"),
        d.between(F.to_date(F.lit(EVENT_START)), F.to_date(F.lit(EVENT_END)))
        .cast("int").alias("is_earthquake_period"),
        ((F.month(d) == 8) & (day >= 15)).cast("int").alias("is_back_to_school"),
    ]


def season_columns(date_col="date") -> list[Column]:
    """Days to Christmas (this year's, or next year's once past) and to the
    next New Year's day."""
    d = _d(date_col)
    y = F.year(d)
    xmas = F.make_date(y, F.lit(12), F.lit(25))
    to_xmas = F.when(F.datediff(xmas, d) >= 0, F.datediff(xmas, d)).otherwise(
        F.datediff(F.make_date(y + 1, F.lit(12), F.lit(25)), d))
    to_new_year = F.datediff(F.make_date(y + 1, F.lit(1), F.lit(1)), d)
    return [F.least(F.greatest(to_xmas, F.lit(0)), F.lit(365)).alias("days_to_christmas"),
            F.least(F.greatest(to_new_year, F.lit(0)), F.lit(365)).alias("days_to_new_year")]


def store_type_ordinal(col: str = "store_type") -> Column:
    m = F.create_map(*[x for k, v in STORE_TYPE_ORDINAL.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.col(col)], F.lit(STORE_TYPE_DEFAULT)).cast("double")


def cross_columns(family="family", store_type="store_type", cluster="cluster",
                  date_col="date") -> list[Column]:
    return [
        F.concat_ws("_", F.col(family), F.col(store_type)).alias("family_x_store_type"),
        F.concat_ws("_", F.col(family), F.col(cluster).cast("string")).alias("family_x_cluster"),
        F.concat_ws("_", day_of_week(date_col).cast("string"), F.col(family)).alias("dow_x_family"),
    ]


def calendar_table(calendar: DataFrame, date_col: str = "date") -> DataFrame:
    """All date-grain calendar features in one projection."""
    return calendar.select(date_col, *calendar_columns(date_col), *fourier_columns(date_col),
                           *payday_columns(date_col), *season_columns(date_col))

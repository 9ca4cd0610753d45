"""Shared plan pieces built on ``PanelSources`` (merged panel, filled series)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import clean
from shelfcast.sources.panel import PanelSources


def oil_file_filled(src: PanelSources) -> DataFrame:
    """Oil rows in date order, forward- then back-filled (one row per oil date;
    a date-grain table, so its single-partition window is bounded)."""
    return clean.forward_back_fill(src.oil, "dcoilwtico", "date")


def oil_dense(src: PanelSources) -> DataFrame:
    """Oil on every calendar day of the panel, filled (weekends, horizon)."""
    cal = src.calendar.join(src.oil, "date", "left")
    return clean.forward_back_fill(cal, "dcoilwtico", "date")


def oil_interpolated(src: PanelSources) -> DataFrame:
    cal = src.calendar.join(src.oil, "date", "left")
    return clean.interpolate_linear(cal, "dcoilwtico", "date")


def merged_panel(src: PanelSources) -> DataFrame:
    """Panel ⟕ stores ⟕ oil ⟕ transactions.

    Stores and oil are dimension / date-grain tables; their join strategy is
    left to AQE's measured-size broadcast. Transactions are store-day grain
    and join on (store_nbr, date).
    """
    p = src.panel
    return (p.join(src.stores, "store_nbr", "left")
             .join(oil_file_filled(src), "date", "left")
             .join(src.transactions, ["store_nbr", "date"], "left")
             .select("store_nbr", "family", "date", "sales", "onpromotion", "city", "state",
                     "store_type", "cluster", "dcoilwtico", "transactions"))

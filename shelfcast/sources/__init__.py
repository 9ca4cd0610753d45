"""Sources and sinks: parquet/CSV scans, the store x family x date panel view, writers."""

from shelfcast.sources.panel import PanelSources, HORIZON

__all__ = ["PanelSources", "HORIZON"]

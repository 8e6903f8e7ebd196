"""Scans and sinks: the driver's parquet tables, the views that map them
onto the device/app-event data model, the reference's CSV layout, and
artefact/result writers."""

from .tables import read_table
from .views import app_events, devices, retail_events, document_tokens_source
from .files import read_device_csv, read_event_csv, write_artefact, read_artefact, write_result

__all__ = [
    "read_table", "app_events", "devices", "retail_events", "document_tokens_source",
    "read_device_csv", "read_event_csv", "write_artefact", "read_artefact", "write_result",
]

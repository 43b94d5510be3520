"""Sources and sinks."""

from scholarspark.sources.tables import read_table  # noqa: F401

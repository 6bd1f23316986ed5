"""Sources and sinks: parquet tables, fixture views, day lists, run-versioned writes."""

"""Sources and sinks: parquet tables, CSV drops, empty and literal frames, writers."""

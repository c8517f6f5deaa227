"""Sources and sinks: catalogue, tables, text, checkpoint files, Parquet."""

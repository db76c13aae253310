"""Sources and sinks: Parquet tables, CSV files, landing zone, file checks."""

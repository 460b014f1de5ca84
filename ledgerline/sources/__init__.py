"""Sources and sinks: driver tables, derived lending relations, CSV/Parquet
files and catalog tables."""

"""Sources and sinks: JSON lines with their order, release files, feeds, lists, TSV and Parquet."""

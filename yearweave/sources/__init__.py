"""Sources and sinks: file manifest, CSV scans, code sets, Parquet."""

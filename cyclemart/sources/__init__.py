"""Sources and sinks: table readers, landed files, encrypted CSV, staged Parquet."""

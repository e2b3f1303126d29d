"""Sources and sinks: landed trip files, covariate payloads, Parquet data products."""

"""Sources: tolerant CSV ingestion of the monthly files and the adapter that
projects the driver's parquet tables into the same shapes."""

"""Sources and sinks: raw log folders (CSV, XLSX), Parquet stages, JSON
feature lists, metric/parameter tables, and the stand-in adapters for the
driver's test tables."""

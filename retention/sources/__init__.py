"""Sources and sinks: declared schemas, fixture views, dated scans, CSV, the feature store."""

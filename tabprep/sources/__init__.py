"""Sources and sinks: the driver's Parquet tables, derived views, CSV scan
with pandas NA semantics, and prediction / table export."""

"""Sources and sinks: catalog tables, parquet, JDBC extracts, and the catalog lifecycle."""

"""Sources and sinks: driver tables, files, catalog tables, JDBC."""

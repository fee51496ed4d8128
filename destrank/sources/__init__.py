"""Sources and sinks: files, JDBC, literal seeds, landed API responses."""

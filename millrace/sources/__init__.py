"""Sources: files, workbooks, JDBC, listings, memory, catalog."""

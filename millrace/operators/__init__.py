"""DataFrame operators: refresh, schema, changes, calendar, relational."""

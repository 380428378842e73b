"""Jobs, views over the test tables and the query catalogue."""

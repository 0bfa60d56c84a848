"""The queries checked against DuckDB, over incident and version tables made from the test tables."""

"""Where tables come from: declared schemas, CSV files, queries, the test tables."""

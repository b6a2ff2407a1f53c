"""Readers: newest bronze snapshot, bronze CSV, silver parquet, JDBC extract,
and the adapter from the driver's test tables to the lake's subjects."""

"""Composed jobs (bronze extract, silver load, gold book) and the query registry."""

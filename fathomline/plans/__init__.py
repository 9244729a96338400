"""Composite jobs, the query catalogue and the SQL each query is checked against."""

"""Operators put together: the pipeline and the queries."""

"""Queries over the test tables, and the SQL each of them must agree with."""

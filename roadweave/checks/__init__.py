"""Runnable queries over the test tables, and independent SQL statements of their results."""

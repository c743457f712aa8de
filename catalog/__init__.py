"""Registered queries: each a Spark job over the test tables and the same relation in SQL."""

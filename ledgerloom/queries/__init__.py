"""Queries on the given tables, each with the SQL that another engine must agree with."""

"""Queries over the test tables, each with the SQL that must give the same rows."""

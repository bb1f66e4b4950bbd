"""Layered (bronze, silver, gold) analytics written as PySpark DataFrame jobs."""

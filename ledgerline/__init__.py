"""Relational reports, table jobs and integrity checks as Spark DataFrame plans."""

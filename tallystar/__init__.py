"""Relational analytics and star-schema ETL, written as plain Spark jobs."""

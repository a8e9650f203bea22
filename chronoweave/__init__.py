"""Declarative event extraction and corpus preparation on PySpark."""

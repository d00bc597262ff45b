"""Genomics operators as Spark DataFrame transformations."""

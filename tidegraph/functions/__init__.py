"""SPARQL's built-in functions as Spark columns."""

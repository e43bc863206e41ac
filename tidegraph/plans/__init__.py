"""Structured requests, and the catalogue of queries."""

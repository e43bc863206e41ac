"""Readers and writers: star-schema tables as a graph, NDJSON, N-Triples and N-Quads."""

"""Graph operators over DataFrames of edges, entities and events."""

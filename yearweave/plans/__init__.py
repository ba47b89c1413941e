"""Composed plans: the end-to-end workflow and the queries over the driver tables."""

"""Modules whose QUERIES and SQL make up the core query set."""

from pagewright.plans import chunk_queries, export_queries, fidelity_queries, interval_queries, model_queries, outline_queries, text_queries

MODULES = [chunk_queries, export_queries, fidelity_queries, interval_queries, model_queries, outline_queries, text_queries]
